"""Property check: the Spark rule expressions agree with the plain statement of each rule."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docketflow.functions.rules import (
    VALID_DOC_ACTIONS,
    VALID_EVENT_TYPES,
    is_valid_doc_action,
    is_valid_event_type,
    rate_tier,
)


def tier(rate):
    if rate is None:
        return "unknown"
    if isinstance(rate, float) and math.isnan(rate):
        return "partner"  # every comparison with NaN is false
    for bound, label in ((300, "junior"), (600, "associate"), (900, "senior")):
        if rate < bound:
            return label
    return "partner"


words = st.one_of(st.none(), st.sampled_from(VALID_DOC_ACTIONS + VALID_EVENT_TYPES), st.text(max_size=12))
rates = st.one_of(st.none(), st.floats(allow_infinity=True, allow_nan=True, width=64),
                  st.integers(-10_000, 10_000).map(float))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(rates, words), min_size=1, max_size=300))
def test_rules_match_plain_statement(spark, rows):
    df = spark.createDataFrame(rows, "rate double, word string")
    got = df.select(rate_tier("rate").alias("t"), is_valid_doc_action("word").alias("a"),
                    is_valid_event_type("word").alias("e")).collect()
    for (rate, word), row in zip(rows, got):
        assert row.t == tier(rate), (rate, row.t)
        assert row.a is (word in VALID_DOC_ACTIONS)
        assert row.e is (word in VALID_EVENT_TYPES)
