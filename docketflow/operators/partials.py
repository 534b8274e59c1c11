"""Mergeable partial aggregates of the facts: every gold row follows from them.

A partial holds one row per finest key of a fact -- with the identifiers that are counted
distinct as part of the key -- so the partials of two sets of rows merge by one aggregate
over their union, and distinct counts stay exact however the rows arrive.  Identifiers are
kept as rows, not as bitmaps: a Spark bitmap takes 4 KB for each key and range of numbers,
and most (matter, month) keys hold a few identifiers only.

A ``bucket`` of the matter is the unit in which partials are kept and gold is recomputed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators.gold import _billable, _group_key, _join_branches
from docketflow.schemas import AMOUNT_SUM_TYPE, GOLD_COLUMNS, HOURS_SUM_TYPE

#: Parts of a bucket that tasks merge side by side.
BUCKET_PARTS = 8

SUM, MIN, MAX, SET = "sum", "min", "max", "set"


@dataclass(frozen=True)
class Partial:
    name: str
    silver: str
    keys: tuple[str, ...]
    values: tuple[tuple[str, str, str | None], ...]  # column, how it merges, type of a sum
    rows: Callable[[DataFrame], DataFrame]           # silver rows as partials of one row each
    counted: str | None = None                       # identifier that makes the keys of most rows differ

    def merge(self, parts: list[DataFrame]) -> DataFrame:
        """One row per key of all ``parts`` (partials, or rows shaped like them)."""
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys).agg(*[_merged(*v) for v in self.values])

    def merge_by_bucket(self, parts: list[DataFrame], buckets: int) -> DataFrame:
        """``merge``, with a column ``bucket`` and the rows dealt out by it, as they are written.

        Rows that hardly shrink are shuffled once, by bucket and a part of it -- keys of the
        aggregate, so that it needs no shuffle of its own; a hot matter spreads over the parts.
        Others shrink in the tasks first and are dealt out when there are few of them.
        """
        bucket = bucket_of(buckets)
        if self.counted is None:
            return self.merge(parts).withColumn("bucket", bucket).hint("rebalance", "bucket")
        part = F.pmod(F.xxhash64(self.counted), F.lit(BUCKET_PARTS)).cast("int")
        rows = reduce(DataFrame.unionByName, parts).withColumns({"bucket": bucket, "_part": part}).repartition("bucket", "_part")
        return rows.groupBy("bucket", "_part", *self.keys).agg(*[_merged(*v) for v in self.values]).select(*self.keys, *[v[0] for v in self.values], "bucket")

    def build(self, silver: DataFrame) -> DataFrame:
        return self.merge([self.rows(silver)])


def _merged(column: str, how: str, kind: str | None) -> Column:
    if how == SET:  # sets over a bounded domain; sorted, so that the value does not depend on the order of arrival
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)
    out = {SUM: F.sum, MIN: F.min, MAX: F.max}[how](column)
    return (out.cast(kind) if kind else out).alias(column)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("matter_id"), F.lit(buckets)).cast("int")


TIME = Partial(
    "time", "silver_time_entries", ("matter_id", "entry_month", "user_id", "entry_id"),
    (("hours", SUM, HOURS_SUM_TYPE), ("amount", SUM, AMOUNT_SUM_TYPE), ("last_date", MAX, None)),
    lambda silver: _billable(silver).select(
        "matter_id", F.trunc("entry_date", "month").alias("entry_month"), "user_id", "entry_id",
        F.col("hours").cast(HOURS_SUM_TYPE).alias("hours"), F.col("billable_amount_usd").cast(AMOUNT_SUM_TYPE).alias("amount"),
        F.col("entry_date").alias("last_date")),
    "entry_id",
)

DOCS = Partial(
    "docs", "silver_doc_audit", ("matter_id", "action", "doc_id", "user_id"),
    (("n", SUM, "bigint"), ("first_ts", MIN, None), ("last_ts", MAX, None)),
    lambda silver: silver.select("matter_id", "action", "doc_id", "user_id", F.lit(1).cast("bigint").alias("n"),
                                 F.col("audit_ts").alias("first_ts"), F.col("audit_ts").alias("last_ts")),
    "doc_id",
)

EVENTS = Partial(
    "events", "silver_matter_events", ("matter_id",),
    (("first_event_ts", MIN, None), ("last_event_ts", MAX, None), ("total_events", SUM, "bigint"),
     ("opened_events", SUM, "bigint"), ("closed_events", SUM, "bigint"), ("offices_touched", SET, None)),
    lambda silver: silver.select(
        "matter_id", F.col("event_ts").alias("first_event_ts"), F.col("event_ts").alias("last_event_ts"),
        F.lit(1).cast("bigint").alias("total_events"), (F.col("event_type") == "opened").cast("bigint").alias("opened_events"),
        (F.col("event_type") == "closed").cast("bigint").alias("closed_events"),
        F.array_compact(F.array("office")).alias("offices_touched")),
)

PARTIALS = {p.name: p for p in (TIME, DOCS, EVENTS)}


# ---- gold from partials ----

def monthly_from(time: DataFrame) -> DataFrame:
    """Sums and users by way of (matter, month, user), entries by way of (matter, month, entry): a hot matter spreads."""
    key = _group_key("matter_id", "entry_month")
    sums = time.select(key, "user_id", "hours", "amount").groupBy("_k", "user_id").agg(F.sum("hours").alias("hours"), F.sum("amount").alias("amount"))
    sums = sums.groupBy("_k").agg(
        F.sum("hours").cast(HOURS_SUM_TYPE).alias("total_hours"), F.sum("amount").cast(AMOUNT_SUM_TYPE).alias("total_revenue_usd"),
        F.count("user_id").alias("distinct_users"))
    entries = time.select(key, "entry_id").groupBy("_k").agg(F.countDistinct("entry_id").alias("entry_count"))
    return _join_branches(("matter_id", "entry_month"), sums, entries)


def activity_from(docs: DataFrame) -> DataFrame:
    key = _group_key("matter_id", "action")
    per_doc = docs.select(key, "doc_id", "n", "first_ts", "last_ts").groupBy("_k", "doc_id").agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    per_doc = per_doc.groupBy("_k").agg(
        F.sum("n").alias("event_count"), F.count("doc_id").alias("distinct_docs"),
        F.min("first_ts").alias("first_seen"), F.max("last_ts").alias("last_seen"))
    users = docs.select(key, "user_id").groupBy("_k").agg(F.countDistinct("user_id").alias("distinct_users"))
    return _join_branches(("matter_id", "action"), per_doc, users).select(*GOLD_COLUMNS["gold_doc_activity_by_matter"])


def revenue_from(time: DataFrame) -> DataFrame:
    return time.groupBy("matter_id").agg(
        F.sum("hours").cast(HOURS_SUM_TYPE).alias("total_billable_hours"), F.sum("amount").cast(AMOUNT_SUM_TYPE).alias("total_revenue_usd"),
        F.countDistinct("user_id").alias("distinct_timekeepers"), F.max("last_date").alias("last_billed_date"))


def doc_totals_from(docs: DataFrame) -> DataFrame:
    return docs.groupBy("matter_id").agg(F.sum("n").alias("total_doc_events"), F.countDistinct("doc_id").alias("distinct_docs"))
