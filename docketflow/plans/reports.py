"""Dashboard datasets over the gold tables.

Money is summed as exact decimals and converted to DOUBLE once at the end, so the
result does not depend on summation order (a per-row DOUBLE sum would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _money(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.sum(col).cast("double")


def kpis(summary: DataFrame) -> DataFrame:
    """KPI tiles: one row, global aggregate (partial per task, one tiny final merge)."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_matters"),
        _money("total_revenue_usd").alias("total_revenue_usd"),
        F.sum("total_lifecycle_events").alias("total_events"),
        F.sum("total_doc_events").alias("total_doc_events"),
    )


def kpis_extended(summary: DataFrame) -> DataFrame:
    """Total matters, billable hours, revenue and average revenue per matter."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_matters"),
        F.sum("total_billable_hours").alias("total_billable_hours"),
        _money("total_revenue_usd").alias("total_revenue_usd"),
        F.try_divide(_money("total_revenue_usd"), F.count(F.lit(1)).cast("double")).alias("avg_revenue_per_matter"),
    )


def monthly_revenue(monthly: DataFrame) -> DataFrame:
    return (
        monthly.groupBy("entry_month")
        .agg(_money("total_revenue_usd").alias("revenue_usd"), F.sum("total_hours").alias("hours"))
        .orderBy("entry_month")
    )


def revenue_by_practice(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("practice_area")
        .agg(_money("total_revenue_usd").alias("revenue_usd"), F.count(F.lit(1)).alias("matter_count"))
        .orderBy(F.desc("revenue_usd"), F.asc_nulls_last("practice_area"))
    )


def top_matters(summary: DataFrame, k: int = 25) -> DataFrame:
    """Top-k by revenue; matter_id breaks ties so the cut is deterministic (TakeOrderedAndProject)."""
    return (
        summary.select(
            "matter_id", "client_name", "practice_area", "region",
            F.col("total_revenue_usd").cast("double").alias("revenue_usd"),
            "total_billable_hours", "total_doc_events", "is_closed",
        )
        .orderBy(F.desc_nulls_last("revenue_usd"), F.asc("matter_id"))
        .limit(k)
    )


def doc_actions(doc_activity: DataFrame) -> DataFrame:
    return (
        doc_activity.groupBy("action")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.desc("event_count"), F.asc_nulls_last("action"))
    )


# Widget feeds project dataset columns without further aggregation.
WIDGETS = {
    "counter_total_matters": ("kpis", ("total_matters",)),
    "counter_total_revenue": ("kpis", ("total_revenue_usd",)),
    "counter_total_events": ("kpis", ("total_events",)),
    "counter_total_doc_events": ("kpis", ("total_doc_events",)),
    "line_monthly_revenue": ("monthly_revenue", ("entry_month", "revenue_usd")),
    "bar_revenue_by_practice": ("by_practice", ("practice_area", "revenue_usd")),
    "pie_doc_actions": ("doc_actions", ("action", "event_count")),
    "table_top_matters": ("top_matters", ("matter_id", "client_name", "practice_area", "region", "revenue_usd",
                                          "total_billable_hours", "total_doc_events", "is_closed")),
}


def widget(datasets: dict[str, DataFrame], name: str) -> DataFrame:
    dataset, cols = WIDGETS[name]
    return datasets[dataset].select(*cols)
