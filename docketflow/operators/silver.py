"""Silver layer: typed, validated, enriched rows.

Each dataset is ``shape`` (typing + projection to the output contract) followed by
its expectations, which see the *output* columns (e.g. ``hours`` after the
decimal(5,2) cast).  Everything is a narrow, map-only transform: the same function
runs in batch over any raw-shaped DataFrame and inside a Structured Streaming query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.functions.casting import as_date, as_timestamp, to_decimal
from docketflow.functions.rules import (
    KNOWN_PRACTICE_AREAS,
    VALID_DOC_ACTIONS,
    VALID_EVENT_TYPES,
    in_list_sql,
    rate_tier,
)
from docketflow.operators.expectations import DROP, WARN, Expectation, enforce, observe_and_enforce, rejected
from docketflow.schemas import AMOUNT_TYPE, HOURS_TYPE, RATE_TYPE, SILVER_COLUMNS


def _lineage(df: DataFrame) -> list:
    cols = []
    for c in ("_source_file", "_ingested_at"):
        if c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("string" if c == "_source_file" else "timestamp").alias(c))
    return cols


def shape_matter_events(df: DataFrame) -> DataFrame:
    ts = as_timestamp(df, "timestamp")
    return df.select(
        "event_id", "matter_id", "event_type",
        ts.alias("event_ts"), F.to_date(ts).alias("event_date"),
        "user_id", "office", *_lineage(df),
    )


def shape_time_entries(df: DataFrame) -> DataFrame:
    hours = to_decimal(F.col("hours"), HOURS_TYPE)
    rate = to_decimal(F.col("rate_usd"), RATE_TYPE)
    return df.select(
        "entry_id", "matter_id", "user_id",
        hours.alias("hours"),
        "billable_flag",
        rate.alias("rate_usd"),
        to_decimal(hours * rate, AMOUNT_TYPE).alias("billable_amount_usd"),
        # tier uses the raw rate, not the rounded decimal
        rate_tier(F.col("rate_usd")).alias("rate_tier"),
        as_date(df, "date").alias("entry_date"),
        "narrative", *_lineage(df),
    )


def shape_doc_audit(df: DataFrame) -> DataFrame:
    ts = as_timestamp(df, "timestamp")
    return df.select(
        "audit_id", "doc_id", "matter_id", "action", "user_id",
        ts.alias("audit_ts"), F.to_date(ts).alias("audit_date"),
        "client_ip", *_lineage(df),
    )


def shape_matters_master(df: DataFrame) -> DataFrame:
    ts = as_timestamp(df, "opened_at")
    return df.select(
        "matter_id", "client_name", "practice_area", "region",
        ts.alias("opened_ts"), F.to_date(ts).alias("opened_date"),
        "partner_lead_user_id", "billing_arrangement", *_lineage(df),
    )


@dataclass(frozen=True)
class SilverSpec:
    dataset: str
    source: str
    shape: Callable[[DataFrame], DataFrame]
    rules: tuple[Expectation, ...]

    def typed(self, raw: DataFrame) -> DataFrame:
        return self.shape(raw).select(*SILVER_COLUMNS[self.dataset])

    def build(self, raw: DataFrame) -> DataFrame:
        """Batch or stream: typed rows that pass every drop rule."""
        return enforce(self.typed(raw), self.rules)

    def rejected(self, raw: DataFrame) -> DataFrame:
        """Typed rows that some drop rule refuses, with the names of the rules."""
        return rejected(self.typed(raw), self.rules)

    def build_observed(self, raw: DataFrame, observation=None) -> DataFrame:
        return observe_and_enforce(self.typed(raw), self.dataset, self.rules, observation)


SILVER: dict[str, SilverSpec] = {
    spec.dataset: spec
    for spec in (
        SilverSpec(
            "silver_matter_events", "matters", shape_matter_events,
            (
                Expectation("valid_event_type", in_list_sql("event_type", VALID_EVENT_TYPES), DROP),
                Expectation("has_matter_id", "matter_id IS NOT NULL AND matter_id != ''", DROP),
                Expectation("has_event_id", "event_id IS NOT NULL", DROP),
            ),
        ),
        SilverSpec(
            "silver_time_entries", "time_entries", shape_time_entries,
            (
                Expectation("positive_hours", "hours > 0 AND hours <= 24", DROP),
                Expectation("has_user", "user_id IS NOT NULL", DROP),
                Expectation("has_matter", "matter_id IS NOT NULL", DROP),
            ),
        ),
        SilverSpec(
            "silver_doc_audit", "doc_audit", shape_doc_audit,
            (
                Expectation("valid_action", in_list_sql("action", VALID_DOC_ACTIONS), DROP),
                Expectation("has_doc", "doc_id IS NOT NULL", DROP),
            ),
        ),
        SilverSpec(
            "silver_matters_master", "matters_master", shape_matters_master,
            (
                Expectation("has_matter_id", "matter_id IS NOT NULL", DROP),
                Expectation("known_practice_area", in_list_sql("practice_area", KNOWN_PRACTICE_AREAS), WARN),
            ),
        ),
    )
}

SILVER_BY_SOURCE = {spec.source: spec for spec in SILVER.values()}


def silver_matter_events(raw: DataFrame) -> DataFrame:
    return SILVER["silver_matter_events"].build(raw)


def silver_time_entries(raw: DataFrame) -> DataFrame:
    return SILVER["silver_time_entries"].build(raw)


def silver_doc_audit(raw: DataFrame) -> DataFrame:
    return SILVER["silver_doc_audit"].build(raw)


def silver_matters_master(raw: DataFrame) -> DataFrame:
    return SILVER["silver_matters_master"].build(raw)
