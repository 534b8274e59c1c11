"""Registered batch queries: (spark, sf_dir) -> DataFrame, all over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions.casting import as_timestamp
from docketflow.functions.rules import is_valid_doc_action, is_valid_event_type
from docketflow.operators import gold as G
from docketflow.operators.expectations import metrics_frame
from docketflow.operators.silver import SILVER
from docketflow.plans import questions as Q
from docketflow.plans import reports as R
from docketflow.plans.layers import StandinLayers
from docketflow.schemas import GOLD_COLUMNS
from docketflow.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _silver(name: str) -> Query:
    return lambda spark, sf: StandinLayers(spark, sf).silver(name)


def _gold(name: str) -> Query:
    return lambda spark, sf: G.contract(StandinLayers(spark, sf).gold(name), name)


def expectation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lay = StandinLayers(spark, sf)
    frames = [metrics_frame(lay.typed(name), name, spec.rules) for name, spec in SILVER.items()]
    return reduce(DataFrame.unionByName, frames)


def warn_practice_area(spark: SparkSession, sf: str) -> DataFrame:
    rule = next(r for r in SILVER["silver_matters_master"].rules if r.name == "known_practice_area")
    return (
        StandinLayers(spark, sf).silver("silver_matters_master")
        .filter(rule.failed())
        .groupBy("practice_area").agg(F.count(F.lit(1)).alias("n_rows"))
    )


# offsets (hours) used to render ISO-8601 strings with a zone; parsing must restore the instant
_OFFSETS = ("-02:00", "-01:00", "+00:00", "+01:00", "+02:00")


def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """ISO-8601 text with a zone offset -> TIMESTAMP (UTC instant) and DATE, as silver parses it."""
    ev = read_table(spark, sf, "events")
    off = (F.col("event_id") % 5) - 2
    local = F.col("ts") + F.make_interval(hours=off.cast("int"))
    text = F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.element_at(F.array(*[F.lit(o) for o in _OFFSETS]), (off + 3).cast("int")),
    )
    rendered = ev.select("event_id", text.alias("timestamp_text"))
    ts = as_timestamp(rendered, "timestamp_text")
    return rendered.select("event_id", "timestamp_text", ts.alias("parsed_ts"), F.to_date(ts).alias("parsed_date"))


def billable_amount(spark: SparkSession, sf: str) -> DataFrame:
    return StandinLayers(spark, sf).typed("silver_time_entries").select(
        "entry_id", "hours", "rate_usd", "billable_amount_usd", "rate_tier",
    )


def rate_tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return (
        StandinLayers(spark, sf).silver("silver_time_entries")
        .groupBy("rate_tier")
        .agg(F.count(F.lit(1)).alias("entries"), F.min("rate_usd").alias("min_rate"),
             F.max("rate_usd").alias("max_rate"))
    )


def doc_action_validity(spark: SparkSession, sf: str) -> DataFrame:
    return (
        StandinLayers(spark, sf).raw("doc_audit")
        .groupBy("action", is_valid_doc_action("action").alias("is_valid"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def event_type_validity(spark: SparkSession, sf: str) -> DataFrame:
    return (
        StandinLayers(spark, sf).raw("matters")
        .groupBy("event_type", is_valid_event_type("event_type").alias("is_valid"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _lay(fn):
    return lambda spark, sf: fn(StandinLayers(spark, sf))


_DATASETS = {
    "kpis": ("gold_matter_summary", R.kpis),
    "monthly_revenue": ("gold_billable_hours_by_matter_month", R.monthly_revenue),
    "by_practice": ("gold_matter_summary", R.revenue_by_practice),
    "doc_actions": ("gold_doc_activity_by_matter", R.doc_actions),
    "top_matters": ("gold_matter_summary", R.top_matters),
}


def _widget(name: str) -> Query:
    dataset = R.WIDGETS[name][0]
    gold, report = _DATASETS[dataset]
    return lambda spark, sf: R.widget({dataset: report(StandinLayers(spark, sf).gold(gold))}, name)


BATCH_QUERIES: dict[str, Query] = {
    # silver (P1-P4, E1-E9)
    **{name: _silver(name) for name in SILVER},
    # gold (G1-G4)
    **{name: _gold(name) for name in GOLD_COLUMNS},
    # summary branches (G4a-c)
    "summary_revenue": _lay(lambda l: G.summary_revenue(l.silver("silver_time_entries"))),
    "summary_lifecycle": _lay(lambda l: G.summary_lifecycle(l.silver("silver_matter_events"))),
    "summary_doc_activity": _lay(lambda l: G.summary_doc_activity(l.silver("silver_doc_audit"))),
    # expectations (E0, E0w, E10)
    "expectation_metrics": expectation_metrics,
    "warn_practice_area": warn_practice_area,
    # scalar expressions (P5-P11)
    "parse_timestamps": parse_timestamps,
    "billable_amount": billable_amount,
    "rate_tier_distribution": rate_tier_distribution,
    "doc_action_validity": doc_action_validity,
    "event_type_validity": event_type_validity,
    # dashboard datasets (D1-D6)
    "dash_kpis": _lay(lambda l: R.kpis(l.gold("gold_matter_summary"))),
    "dash_monthly_revenue": _lay(lambda l: R.monthly_revenue(l.gold("gold_billable_hours_by_matter_month"))),
    "dash_by_practice": _lay(lambda l: R.revenue_by_practice(l.gold("gold_matter_summary"))),
    "dash_top_matters": _lay(lambda l: R.top_matters(l.gold("gold_matter_summary"))),
    "dash_doc_actions": _lay(lambda l: R.doc_actions(l.gold("gold_doc_activity_by_matter"))),
    "dash_kpis_extended": _lay(lambda l: R.kpis_extended(l.gold("gold_matter_summary"))),
    # widget feeds (D7): columns of the datasets above
    **{f"widget_{name}": _widget(name) for name in R.WIDGETS},
    # questions (Q1-Q8, J2, J3)
    "q_top10_matters": _lay(lambda l: Q.top_matters_by_revenue(l.gold("gold_matter_summary"))),
    "q_revenue_share_by_practice": _lay(lambda l: Q.revenue_share_by_practice(l.gold("gold_matter_summary"))),
    "q_doc_events_last_week": _lay(lambda l: Q.doc_events_last_week(l.silver("silver_doc_audit"))),
    "q_opened_never_closed": _lay(lambda l: Q.opened_never_closed(l.gold("gold_matter_lifecycle"))),
    "q_opened_never_closed_anti": _lay(lambda l: Q.opened_never_closed_anti(l.silver("silver_matter_events"))),
    "q_avg_hours_by_practice": _lay(lambda l: Q.avg_hours_by_practice(l.gold("gold_matter_summary"))),
    "q_top_timekeepers": _lay(lambda l: Q.top_timekeepers(l.silver("silver_time_entries"))),
    "q_clients_by_doc_activity": _lay(lambda l: Q.clients_by_doc_activity(l.gold("gold_matter_summary"))),
    "q_monthly_revenue_by_region": _lay(lambda l: Q.monthly_revenue_by_region(
        l.gold("gold_billable_hours_by_matter_month"), l.silver("silver_matters_master"))),
}


def all_queries() -> dict[str, Query]:
    from docketflow.streaming.registry import STREAM_QUERIES

    return {**BATCH_QUERIES, **STREAM_QUERIES}
