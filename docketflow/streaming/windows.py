"""Windowed streaming aggregate: document activity per day and action, while rows still arrive.

Rows of the silver audit table are grouped by event-time day.  A day is written once, when
the watermark (the greatest time seen, less ``delay``) has passed its end; rows that come
for a day already closed are dropped by the watermark, and ``late_rows`` counts them.  The
state holds one row per open (day, action): a count and a HyperLogLog sketch of the
documents, so it follows neither the rows nor the documents.  Partial aggregation per task
comes before the shuffle, so that a day or an action with most of the rows is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.operators.silver import SILVER
from docketflow.schemas import RAW_SCHEMAS

NAME = "daily_doc_activity"
DELAY = "2 days"
#: log2 of the sketch's buckets: a relative standard error of 0.83 * 2**-6 = 1.3 %.
SKETCH_LG = 12


def daily_doc_activity(audit: DataFrame, delay: str = DELAY) -> DataFrame:
    """(day, action, n_events, docs_sketch) of a stream (or table) of silver audit rows."""
    if audit.isStreaming:
        audit = audit.withWatermark("audit_ts", delay)
    return audit.groupBy(F.window("audit_ts", "1 day").alias("w"), "action").agg(
        F.count(F.lit(1)).alias("n_events"), F.hll_sketch_agg("doc_id", F.lit(SKETCH_LG)).alias("docs_sketch"),
    ).select(F.to_date("w.start").alias("day"), "action", "n_events", "docs_sketch")


def run_daily_doc_activity(spark: SparkSession, layout, delay: str = DELAY, max_files_per_trigger: int | None = None) -> list:
    """Takes up the silver audit rows since the last run and writes the days that the watermark has closed."""
    from docketflow.streaming.pipeline import LANDING_RETENTION_DAYS, _bounded, _finished, _sink

    spec = SILVER["silver_doc_audit"]
    schema = spec.typed(spark.createDataFrame([], RAW_SCHEMAS[spec.source])).schema
    rows = _bounded(spark.readStream.schema(schema), max_files_per_trigger, LANDING_RETENTION_DAYS).parquet(layout.table("silver", spec.dataset))
    return _finished(_sink(daily_doc_activity(rows, delay), layout.table("stream", NAME), layout.checkpoint("stream", NAME), f"{NAME}_{layout.generation}"))


def read_daily_doc_activity(spark: SparkSession, layout) -> DataFrame:
    """(day, action, n_events, approx_docs) of all closed days."""
    rows = spark.read.schema("day date, action string, n_events long, docs_sketch binary").parquet(layout.table("stream", NAME))
    return rows.select("day", "action", "n_events", F.hll_sketch_estimate("docs_sketch").alias("approx_docs"))


def late_rows(audit: DataFrame, closed: DataFrame) -> DataFrame:
    """(day, action, n_events, n_late) of closed days: the rows of the table that came after their day was closed."""
    landed = audit.groupBy(F.to_date("audit_ts").alias("day"), "action").agg(F.count(F.lit(1)).alias("n_rows"))
    days = closed.select("day").distinct()  # a closed day's action may have come late only
    counted = closed.select("day", "action", "n_events")
    return landed.join(days, "day").join(counted, ["day", "action"], "left").select(
        "day", "action", F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events"),
        (F.col("n_rows") - F.coalesce("n_events", F.lit(0))).cast("long").alias("n_late"))
