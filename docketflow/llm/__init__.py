"""Training-data operators and their queries.

The functions of this package that run inside tasks are pickled by value, so that a
cluster's workers need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
