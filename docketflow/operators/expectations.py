"""Named data-quality expectations: drop or warn, with per-rule counters.

A rule is a SQL predicate over the dataset's *output* columns.  A drop rule keeps a
row only when its predicate is TRUE (NULL counts as failed).  Several drop rules
are ANDed, and each rule is counted on its own.

Counting happens in the same pass as the data (``DataFrame.observe`` for streams)
or as one global aggregate (batch metrics table): partial counts per task, one
tiny final merge, so the cost does not depend on key skew.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP, WARN = "drop", "warn"
FAILED_RULES = "_failed_rules"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = DROP

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def failed(self) -> Column:
        return ~self.passed()


def metric_name(rule: Expectation) -> str:
    return f"failed_{rule.name}"


def counters(rules: tuple[Expectation, ...]) -> list[Column]:
    """Aggregate expressions: total rows plus one failure count per rule."""
    return [F.count(F.lit(1)).alias("n_rows")] + [
        F.count_if(r.failed()).alias(metric_name(r)) for r in rules
    ]


def enforce(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Keep rows passing every drop rule; warn rules never remove rows."""
    drops = [r.passed() for r in rules if r.action == DROP]
    if not drops:
        return df
    return df.filter(reduce(lambda a, b: a & b, drops))


def rejected(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """The rows that ``enforce`` drops, with the names of all drop rules that each one failed."""
    names = [F.when(r.failed(), F.lit(r.name)) for r in rules if r.action == DROP]
    if not names:
        return df.withColumn(FAILED_RULES, F.array().cast("array<string>")).where(F.lit(False))
    return df.withColumn(FAILED_RULES, F.array_compact(F.array(*names))).where(F.size(FAILED_RULES) > 0)


def observe_and_enforce(df: DataFrame, dataset: str, rules: tuple[Expectation, ...],
                        observation: Observation | str | None = None) -> DataFrame:
    """Count rule failures in-flight, then drop.  Works on batch and streaming input.

    For streams pass a name (str); per-micro-batch counts appear in
    ``query.recentProgress[i].observedMetrics[name]``.
    """
    obs = observation if observation is not None else f"dq_{dataset}"
    return enforce(df.observe(obs, *counters(rules)), rules)


def metrics_frame(df: DataFrame, dataset: str, rules: tuple[Expectation, ...]) -> DataFrame:
    """One row per rule: (dataset, rule, action, n_rows, n_failed) from a single global aggregate."""
    agg = df.agg(*counters(rules))
    stack_args = ", ".join(
        f"'{r.name}', '{r.action}', `{metric_name(r)}`" for r in rules
    )
    return agg.selectExpr(
        f"'{dataset}' AS dataset",
        f"stack({len(rules)}, {stack_args}) AS (rule, action, n_failed)",
        "n_rows",
    ).select("dataset", "rule", "action", "n_rows", F.col("n_failed").cast("bigint").alias("n_failed"))


def metrics_rows(dataset: str, rules: tuple[Expectation, ...], observed: list[dict]) -> list[tuple]:
    """Sum per-micro-batch observed counters into (dataset, rule, action, n_rows, n_failed) tuples."""
    n_rows = sum(int(m.get("n_rows", 0)) for m in observed)
    return [
        (dataset, r.name, r.action, n_rows, sum(int(m.get(metric_name(r), 0)) for m in observed))
        for r in rules
    ]
