"""Schemas: raw landing sources (frozen) and the column contracts of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw JSON-lines sources, one landing sub-folder each.  Every field is nullable.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "matters_master": _struct(
        ("matter_id", S), ("client_name", S), ("practice_area", S), ("region", S),
        ("opened_at", S), ("partner_lead_user_id", S), ("billing_arrangement", S),
    ),
    "matters": _struct(
        ("event_id", S), ("matter_id", S), ("event_type", S), ("timestamp", S),
        ("user_id", S), ("office", S),
    ),
    "time_entries": _struct(
        ("entry_id", S), ("matter_id", S), ("user_id", S), ("hours", D), ("billable_flag", B),
        ("rate_usd", L), ("date", S), ("narrative", S),
    ),
    "doc_audit": _struct(
        ("audit_id", S), ("doc_id", S), ("matter_id", S), ("action", S), ("user_id", S),
        ("timestamp", S), ("client_ip", S),
    ),
}

# landing sub-folder -> dataset names of the bronze / silver layer
SOURCES = {
    "matters_master": ("bronze_matters_master", "silver_matters_master"),
    "matters": ("bronze_matter_events", "silver_matter_events"),
    "time_entries": ("bronze_time_entries", "silver_time_entries"),
    "doc_audit": ("bronze_doc_audit", "silver_doc_audit"),
}

LINEAGE_COLUMNS = ("_source_file", "_ingested_at")
RESCUE_COLUMN = "_rescued_data"


def bronze_schema(source: str) -> T.StructType:
    """Raw fields + rescue column + ingestion columns."""
    fields = list(RAW_SCHEMAS[source].fields) + [
        T.StructField(RESCUE_COLUMN, S, True),
        T.StructField("_ingested_at", T.TimestampType(), True),
        T.StructField("_source_file", S, True),
    ]
    return T.StructType(fields)


SILVER_COLUMNS = {
    "silver_matter_events": ("event_id", "matter_id", "event_type", "event_ts", "event_date", "user_id",
                             "office", "_source_file", "_ingested_at"),
    "silver_time_entries": ("entry_id", "matter_id", "user_id", "hours", "billable_flag", "rate_usd",
                            "billable_amount_usd", "rate_tier", "entry_date", "narrative", "_source_file",
                            "_ingested_at"),
    "silver_doc_audit": ("audit_id", "doc_id", "matter_id", "action", "user_id", "audit_ts", "audit_date",
                         "client_ip", "_source_file", "_ingested_at"),
    "silver_matters_master": ("matter_id", "client_name", "practice_area", "region", "opened_ts",
                              "opened_date", "partner_lead_user_id", "billing_arrangement", "_source_file",
                              "_ingested_at"),
}

GOLD_COLUMNS = {
    "gold_billable_hours_by_matter_month": ("matter_id", "entry_month", "total_hours", "total_revenue_usd",
                                            "distinct_users", "entry_count"),
    "gold_doc_activity_by_matter": ("matter_id", "action", "event_count", "distinct_docs", "distinct_users",
                                    "first_seen", "last_seen"),
    "gold_matter_lifecycle": ("matter_id", "first_event_ts", "last_event_ts", "total_events", "opened_events",
                              "closed_events", "offices_touched"),
    "gold_matter_summary": ("matter_id", "client_name", "practice_area", "region", "billing_arrangement",
                            "partner_lead_user_id", "opened_ts", "first_event_ts", "last_event_ts", "is_closed",
                            "total_billable_hours", "total_revenue_usd", "distinct_timekeepers",
                            "last_billed_date", "total_doc_events", "distinct_docs", "total_lifecycle_events"),
}

# Decimal widths: SUM widens (p,s) to (p+10,s), so the zero-fill literals use the widened types.
HOURS_TYPE = "decimal(5,2)"
RATE_TYPE = "decimal(10,2)"
AMOUNT_TYPE = "decimal(12,2)"
HOURS_SUM_TYPE = "decimal(15,2)"
AMOUNT_SUM_TYPE = "decimal(22,2)"
