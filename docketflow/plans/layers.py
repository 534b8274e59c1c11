"""Lazy silver/gold DataFrames over a set of raw sources.

``StandinLayers`` derives the raw sources from the given parquet tables;
``TableLayers`` reads the tables a pipeline run wrote.  Both expose the same
``silver(name)`` / ``gold(name)`` accessors, so reports and questions run on either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketflow.operators import gold as G
from docketflow.operators.silver import SILVER
from docketflow.sources.standin import standin_source


class _Layers:
    def __init__(self) -> None:
        self._memo: dict[str, DataFrame] = {}

    def _get(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def silver(self, name: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def gold(self, name: str) -> DataFrame:
        builders = {
            "gold_billable_hours_by_matter_month":
                lambda: G.billable_hours_by_matter_month(self.silver("silver_time_entries")),
            "gold_doc_activity_by_matter": lambda: G.doc_activity_by_matter(self.silver("silver_doc_audit")),
            "gold_matter_lifecycle": lambda: G.matter_lifecycle(self.silver("silver_matter_events")),
            "gold_matter_summary": lambda: G.matter_summary(
                self.silver("silver_matters_master"), self.silver("silver_time_entries"),
                self.silver("silver_matter_events"), self.silver("silver_doc_audit"),
            ),
        }
        return self._get(name, builders[name])


class StandinLayers(_Layers):
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, source: str) -> DataFrame:
        return self._get(f"raw:{source}", lambda: standin_source(self.spark, self.sf_dir, source))

    def typed(self, name: str) -> DataFrame:
        spec = SILVER[name]
        return self._get(f"typed:{name}", lambda: spec.typed(self.raw(spec.source)))

    def silver(self, name: str) -> DataFrame:
        spec = SILVER[name]
        return self._get(name, lambda: spec.build(self.raw(spec.source)))


class TableLayers(_Layers):
    """Layers read back from a pipeline's output root (see streaming.pipeline)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        super().__init__()
        self.spark, self.root = spark, root

    def silver(self, name: str) -> DataFrame:
        from docketflow.streaming.pipeline import read_layer_table

        return self._get(name, lambda: read_layer_table(self.spark, self.root, name))

    def gold(self, name: str) -> DataFrame:
        from docketflow.streaming.pipeline import read_layer_table

        return self._get(name, lambda: read_layer_table(self.spark, self.root, name))
