from docketflow.functions.rules import (  # noqa: F401
    KNOWN_PRACTICE_AREAS,
    VALID_DOC_ACTIONS,
    VALID_EVENT_TYPES,
    is_valid_doc_action,
    is_valid_event_type,
    rate_tier,
)
from docketflow.functions.casting import as_date, as_timestamp, to_decimal  # noqa: F401
