"""Analytic questions over silver and gold, as fixed parameterised operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow import AS_OF


def top_matters_by_revenue(summary: DataFrame, k: int = 10) -> DataFrame:
    return (
        summary.select(
            "matter_id", "client_name", "practice_area",
            F.col("total_revenue_usd").cast("double").alias("revenue_usd"),
        )
        .orderBy(F.desc_nulls_last("revenue_usd"), F.asc("matter_id"))
        .limit(k)
    )


def revenue_share_by_practice(summary: DataFrame) -> DataFrame:
    """Revenue per practice area and its share of the total.

    The total is summed over the per-area rows (one per practice area), so the revenue
    chain runs once; the window sees those few rows only.
    """
    per_area = summary.groupBy("practice_area").agg(
        F.sum("total_revenue_usd").alias("revenue"),
        F.count(F.lit(1)).alias("matter_count"),
    )
    total = F.sum("revenue").over(W.partitionBy()).cast("double")
    revenue = F.col("revenue").cast("double")
    return per_area.select(
        "practice_area", revenue.alias("revenue_usd"), "matter_count",
        F.try_divide(revenue, total).alias("revenue_share"),
    ).orderBy(F.desc("revenue_usd"), F.asc_nulls_last("practice_area"))


def last_week_bounds(as_of: str = AS_OF) -> tuple[dt.date, dt.date]:
    """ISO week (Monday..Sunday) before the week containing ``as_of``: [start, end)."""
    d = dt.date.fromisoformat(as_of)
    this_monday = d - dt.timedelta(days=d.weekday())
    return this_monday - dt.timedelta(days=7), this_monday


def doc_events_last_week(doc_audit: DataFrame, as_of: str = AS_OF) -> DataFrame:
    start, end = last_week_bounds(as_of)
    return (
        doc_audit.filter((F.col("audit_date") >= F.lit(start)) & (F.col("audit_date") < F.lit(end)))
        .agg(F.count(F.lit(1)).alias("doc_events"))
        .select(F.lit(start).alias("week_start"), F.lit(end - dt.timedelta(days=1)).alias("week_end"), "doc_events")
    )


def opened_never_closed(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.filter((F.col("opened_events") > 0) & (F.col("closed_events") == 0)).select(
        "matter_id", "first_event_ts", "last_event_ts", "total_events", "opened_events",
    )


def opened_never_closed_anti(matter_events: DataFrame) -> DataFrame:
    """Same matters as :func:`opened_never_closed`, via an anti join on de-duplicated keys.

    Each side is reduced to distinct matter ids first (map-side combine), so a hot
    matter contributes one row per map task to the shuffle, not all its events.
    """
    opened = matter_events.filter(F.col("event_type") == "opened").select("matter_id").distinct()
    closed = matter_events.filter(F.col("event_type") == "closed").select("matter_id").distinct()
    return opened.join(closed, "matter_id", "left_anti")


def avg_hours_by_practice(summary: DataFrame, areas: tuple[str, ...] = ("M&A", "Litigation")) -> DataFrame:
    """Average billable hours per matter (zero-hour matters included) for the given areas."""
    return (
        summary.filter(F.col("practice_area").isin(*areas))
        .groupBy("practice_area")
        .agg(
            F.count(F.lit(1)).alias("matter_count"),
            F.sum("total_billable_hours").alias("total_billable_hours"),
            F.try_divide(F.sum("total_billable_hours").cast("double"), F.count(F.lit(1)).cast("double"))
            .alias("avg_billable_hours"),
        )
        .orderBy("practice_area")
    )


def top_timekeepers(time_entries: DataFrame, k: int = 10) -> DataFrame:
    return (
        time_entries.filter(F.col("billable_flag"))
        .groupBy("user_id")
        .agg(
            F.sum("billable_amount_usd").cast("double").alias("revenue_usd"),
            F.sum("hours").alias("total_hours"),
            F.count(F.lit(1)).alias("entries"),
        )
        .orderBy(F.desc_nulls_last("revenue_usd"), F.asc("user_id"))
        .limit(k)
    )


def clients_by_doc_activity(summary: DataFrame, k: int = 10) -> DataFrame:
    return (
        summary.groupBy("client_name")
        .agg(F.sum("total_doc_events").alias("total_doc_events"), F.count(F.lit(1)).alias("matter_count"))
        .orderBy(F.desc("total_doc_events"), F.asc_nulls_last("client_name"))
        .limit(k)
    )


def monthly_revenue_by_region(monthly: DataFrame, matters: DataFrame) -> DataFrame:
    """Monthly gold joined to the dimension (inner: matters without a dimension row drop out)."""
    dim = matters.select("matter_id", "region")
    return (
        monthly.join(dim, "matter_id", "inner")
        .groupBy("region", "entry_month")
        .agg(F.sum("total_revenue_usd").cast("double").alias("revenue_usd"), F.sum("total_hours").alias("hours"))
        .orderBy("region", "entry_month")
    )
