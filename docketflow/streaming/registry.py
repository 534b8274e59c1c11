"""Registered ingest/streaming queries over JSON-lines files landed from the given tables.

Each call lands the stand-in sources (whole tables) as JSON-lines files in a new
folder under the shared work root and runs the real bronze/silver streams and
gold refresh.  Lineage columns (file path, ingestion time) differ per run, so the
returned frames leave them out; everything else must equal the batch results.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.plans.layers import TableLayers
from docketflow.schemas import LINEAGE_COLUMNS, RAW_SCHEMAS, SOURCES
from docketflow.session import new_work_dir
from docketflow.sources import landing as landing_files
from docketflow.sources.landing import infer_raw_schema, land_json_batch, land_master_once, to_landing_shape
from docketflow.sources.rescue import rescue_json
from docketflow.sources.standin import standin_source
from docketflow.streaming.compaction import compact_silver, read_compacted
from docketflow.streaming.pipeline import (
    LANDING_RETENTION_DAYS,
    _fs,
    _run_source,
    current_layout,
    new_run_id,
    read_bronze,
    read_metrics,
    read_rejected,
    read_silver,
    readable_layout,
    refresh_gold,
    run_bronze_source,
    run_pipeline,
    run_rejected,
    table_catalog,
)
from docketflow.streaming.windows import late_rows, read_daily_doc_activity, run_daily_doc_activity

# The landed files are gzip: as plain text they would be the largest part of all that a query writes.
COMPRESSION = "gzip"

# Arrival waves: rows whose time is before the cutoff land first, the rest later.
WAVE_CUTOFFS = {
    "matters": ("timestamp", dt.datetime(1998, 1, 1)),
    "time_entries": ("date", dt.date(1998, 1, 1)),
    "doc_audit": ("timestamp", dt.datetime(2024, 1, 16)),
}


def _wave(df: DataFrame, source: str, wave: int | None) -> DataFrame:
    if wave is None:
        return df
    col, cutoff = WAVE_CUTOFFS[source]
    early = F.coalesce(F.col(col) < F.lit(cutoff), F.lit(False))
    return df.filter(early if wave == 1 else ~early)


def land_standin(spark: SparkSession, sf: str, landing: str, wave: int | None = None,
                 files_per_source: int | None = None) -> None:
    """Land the dimension once and the fact sources (optionally one arrival wave) as JSON-lines.

    By default each source keeps its natural partitioning (file count grows with the
    data); ``files_per_source`` forces a fixed count, for small test batches.
    """
    land_master_once(standin_source(spark, sf, "matters_master", lineage=False), landing, compression=COMPRESSION)
    for source in ("matters", "time_entries", "doc_audit"):
        df = _wave(standin_source(spark, sf, source, lineage=False), source, wave)
        land_json_batch(df, landing, source, files=files_per_source, compression=COMPRESSION)


def _drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE_COLUMNS)


def _land_source(spark: SparkSession, sf: str, landing: str, source: str, at_least: int | None = None) -> None:
    df = standin_source(spark, sf, source, lineage=False)
    if source == "matters_master":
        land_master_once(df, landing, compression=COMPRESSION)
    else:
        # files that hold no more rows than this: so many at least, more where the rows are many, and no shuffle
        records = min(landing_files.MAX_RECORDS_COMPRESSED, max(1, -(-df.count() // at_least))) if at_least else None
        land_json_batch(df, landing, source, max_records_per_file=records, compression=COMPRESSION)


def _bronze_of(spark: SparkSession, sf: str, source: str, at_least: int | None = None) -> DataFrame:
    """One source landed (as a number of files at least) and ingested as the pipeline does it."""
    work = new_work_dir(spark, "bronze")
    _land_source(spark, sf, f"{work}/landing", source, at_least)
    layout = current_layout(spark, f"{work}/out", run_id=new_run_id())
    run_bronze_source(spark, f"{work}/landing", layout, source)
    return read_bronze(spark, layout, SOURCES[source][0])


def _bronze_query(source: str):
    return lambda spark, sf: _drop_lineage(_bronze_of(spark, sf, source))


def rows_per_source_file(spark: SparkSession, sf: str) -> DataFrame:
    """Provenance of every source, the facts landed as four files each or more: rows, files, and rows without file or time."""
    parts = []
    for source in SOURCES:
        bronze = _bronze_of(spark, sf, source, at_least=4)
        parts.append(bronze.select(
            F.lit(source).alias("source"), "_source_file", "_ingested_at",
            F.col("_source_file").rlike(rf"/{source}/[^/]+\.json(\.gz)?$").alias("in_landing")))
    rows = reduce(DataFrame.unionByName, parts)
    # one landed file per writing task: the count is part of the landing's partitioning, so only "several" is stated
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_source_file").isNull() | F.col("_ingested_at").isNull()).alias("n_unknown"),
        F.min("in_landing").alias("all_in_landing"),
        ((F.approx_count_distinct("_source_file") > 1) | (F.col("source") == "matters_master")).alias("several_files"))


def land_json_batch_query(spark: SparkSession, sf: str) -> DataFrame:
    landing = f"{new_work_dir(spark, 'land')}/landing"
    land_json_batch(standin_source(spark, sf, "time_entries", lineage=False), landing, "time_entries", compression=COMPRESSION)
    return spark.read.schema(RAW_SCHEMAS["time_entries"]).json(f"{landing}/time_entries")


def land_master_once_query(spark: SparkSession, sf: str) -> DataFrame:
    """Second write is ignored: the dimension holds each row once."""
    landing = f"{new_work_dir(spark, 'master')}/landing"
    master = standin_source(spark, sf, "matters_master", lineage=False)
    land_master_once(master, landing, compression=COMPRESSION)
    land_master_once(master, landing, compression=COMPRESSION)
    return spark.read.schema(RAW_SCHEMAS["matters_master"]).json(f"{landing}/matters_master")


def infer_raw_schema_query(spark: SparkSession, sf: str) -> DataFrame:
    landing = f"{new_work_dir(spark, 'infer')}/landing"
    land_standin(spark, sf, landing)
    rows = []
    for source in SOURCES:
        for f in infer_raw_schema(spark, f"{landing}/{source}").fields:
            rows.append((source, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "source string, field string, type string")


# Dirty-line variants of the landed time entries (order key and line number pick one).
_DIRTY = (
    "line",                                                         # 0 clean
    "replace(line, '\"billable_flag\"', '\"extra_field\":1,\"billable_flag\"')",  # 1 unknown key
    "replace(line, '\"entry_id\"', '\"ENTRY_ID\"')",                # 2 wrong-case key
    "substr(line, 1, length(line) - 3)",                            # 3 broken JSON
    "concat('[', line, ']')",                                       # 4 top-level array
    "regexp_replace(line, '\"rate_usd\":([0-9]+)', '\"rate_usd\":$1.7')",  # 5 decimal for a bigint
    "regexp_replace(line, '\"hours\":(-?[0-9.E]+)', '\"hours\":\"$1\"')",  # 6 number as string
    "line",                                                         # 7 clean, followed by blank lines
)


def rescue_json_query(spark: SparkSession, sf: str) -> DataFrame:
    """Rescue parsing over every stand-in time entry (one output row each), a share of lines made dirty."""
    shaped = to_landing_shape(standin_source(spark, sf, "time_entries", lineage=False), "time_entries")
    line = F.to_json(F.struct(*shaped.columns), {"ignoreNullFields": "false"})
    order_key, line_number = (F.split_part("entry_id", F.lit("-"), F.lit(k)).cast("long") for k in (2, 3))
    pick = F.pmod(order_key * 7 + line_number, F.lit(len(_DIRTY)))
    lines = shaped.select(line.alias("line"), pick.alias("v"))
    variant_case = "CASE v " + " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(_DIRTY)) + " END"
    # every entry keeps its line; variant 7 adds an extra blank line, which parsing must skip
    texts = lines.select(F.explode(
        F.when(F.col("v") == len(_DIRTY) - 1, F.array(F.expr(variant_case), F.lit("   "), F.lit("\t")))
        .otherwise(F.array(F.expr(variant_case)))
    ).alias("value"))
    return rescue_json(texts, RAW_SCHEMAS["time_entries"])


def _files(spark: SparkSession, folder: str) -> set[str]:
    fs, p = _fs(spark, folder)
    return {s.getPath().toString() for s in fs.listStatus(p)} if fs.exists(p) else set()


def _land_old(spark: SparkSession, sf: str, landing: str, wave: int, days: int = 30) -> None:
    """Lands a wave whose files carry a modification time ``days`` back, as copies of older files do."""
    facts = [s for s in SOURCES if s != "matters_master"]
    before = {s: _files(spark, f"{landing}/{s}") for s in facts}
    land_standin(spark, sf, landing, wave=wave)
    then = int((dt.datetime.now().timestamp() - days * 86_400) * 1000)
    for s in facts:
        for name in _files(spark, f"{landing}/{s}") - before[s]:
            fs, p = _fs(spark, name)
            fs.setTimes(p, then, -1)


def _pipeline_root(spark: SparkSession, sf: str, waves: tuple = (None,), incremental_gold: bool = False) -> str:
    """A pipeline run after each wave; the second wave's files are older than the first's."""
    work = new_work_dir(spark, "pipe")
    for w in waves:
        if w == 2:
            _land_old(spark, sf, f"{work}/landing", w)
        else:
            land_standin(spark, sf, f"{work}/landing", wave=w)
        run_pipeline(spark, f"{work}/landing", f"{work}/out", register=False, incremental_gold=incremental_gold)
    return f"{work}/out"


def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrival waves, one pipeline run after each; silver equals the one-shot batch result."""
    root = _pipeline_root(spark, sf, waves=(1, 2))
    return _drop_lineage(TableLayers(spark, root).silver("silver_time_entries"))


def run_pipeline_query(spark: SparkSession, sf: str) -> DataFrame:
    root = _pipeline_root(spark, sf)
    return TableLayers(spark, root).gold("gold_matter_summary")


def full_refresh_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental runs, then a full refresh (fresh generation replaying every file)."""
    root = _pipeline_root(spark, sf, waves=(1, 2))
    work = root.removesuffix("/out")
    run_pipeline(spark, f"{work}/landing", f"{work}/out", full_refresh=True, register=False)
    return TableLayers(spark, f"{work}/out").gold("gold_billable_hours_by_matter_month")


def refresh_gold_query(spark: SparkSession, sf: str) -> DataFrame:
    root = _pipeline_root(spark, sf)
    refresh_gold(spark, readable_layout(spark, root), new_run_id())
    return TableLayers(spark, root).gold("gold_doc_activity_by_matter")


def _incremental_gold(table: str):
    """A gold table after two waves, the second one merged into what the first one left (``gold_state``)."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return TableLayers(spark, _pipeline_root(spark, sf, waves=(1, 2), incremental_gold=True)).gold(table)

    return query


def stream_expectation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Expectation counters observed in-flight by the silver streams, summed per rule."""
    root = _pipeline_root(spark, sf, waves=(1, 2))
    return (
        read_metrics(spark, root)
        .groupBy("dataset", "rule", "action")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed"))
    )


# key column of each silver dataset, as the rejected rows are named by it
_ROW_KEYS = {"silver_matter_events": "event_id", "silver_time_entries": "entry_id", "silver_doc_audit": "audit_id", "silver_matters_master": "client_name"}


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every row that some drop rule refused in two waves, with the rules it failed."""
    work = new_work_dir(spark, "rejected")
    layout = current_layout(spark, f"{work}/out", run_id=new_run_id())
    for wave in (1, 2):
        land_standin(spark, sf, f"{work}/landing", wave=wave)
        for source in SOURCES:
            run_bronze_source(spark, f"{work}/landing", layout, source)
            run_rejected(spark, layout, source)
    parts = [read_rejected(spark, layout, name).select(
        F.lit(name).alias("dataset"), F.col(key).alias("row_key"), "matter_id", F.array_join("_failed_rules", ",").alias("failed_rules"))
        for name, key in _ROW_KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


def stream_daily_doc_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Daily audit activity streamed over two waves; a tenth of the rows comes with the second one, most of it late."""
    work = new_work_dir(spark, "daily")
    layout = current_layout(spark, f"{work}/out", run_id=new_run_id())
    rows = standin_source(spark, sf, "doc_audit", lineage=False)
    second = (F.col("timestamp") >= F.lit(WAVE_CUTOFFS["doc_audit"][1])) | (F.split_part("audit_id", F.lit("-"), F.lit(2)).cast("long") % 10 == 3)
    for part in (rows.filter(~second), rows.filter(second)):
        land_json_batch(part, f"{work}/landing", "doc_audit", compression=COMPRESSION)
        _run_source(spark, f"{work}/landing", layout, "doc_audit", new_run_id(), None, LANDING_RETENTION_DAYS)
        run_daily_doc_activity(spark, layout)
    return late_rows(read_silver(spark, layout, "silver_doc_audit"), read_daily_doc_activity(spark, layout))


def compacted_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Time entries read from a clustered copy of the first wave and the files of the second one."""
    work = new_work_dir(spark, "compact")
    layout = current_layout(spark, f"{work}/out", run_id=new_run_id())
    for wave in (1, 2):
        df = _wave(standin_source(spark, sf, "time_entries", lineage=False), "time_entries", wave)
        land_json_batch(df, f"{work}/landing", "time_entries", compression=COMPRESSION)
        _run_source(spark, f"{work}/landing", layout, "time_entries", new_run_id(), None, LANDING_RETENTION_DAYS)
        if wave == 1:
            compact_silver(spark, layout, "silver_time_entries", new_run_id())
    return _drop_lineage(read_compacted(spark, layout, "silver_time_entries"))


def table_catalog_query(spark: SparkSession, sf: str) -> DataFrame:
    work = new_work_dir(spark, "catalog")
    land_standin(spark, sf, f"{work}/landing")
    database = "docketflow_" + work.rsplit("-", 1)[1]
    run_pipeline(spark, f"{work}/landing", f"{work}/out", register=True, database=database)
    return table_catalog(spark, database)


STREAM_QUERIES = {
    **{bronze: _bronze_query(source) for source, (bronze, _) in SOURCES.items()},
    "rows_per_source_file": rows_per_source_file,
    "land_json_batch": land_json_batch_query,
    "land_master_once": land_master_once_query,
    "infer_raw_schema": infer_raw_schema_query,
    "rescue_json": rescue_json_query,
    "ingest_incremental": ingest_incremental,
    "run_pipeline": run_pipeline_query,
    "full_refresh_equivalence": full_refresh_equivalence,
    "refresh_gold": refresh_gold_query,
    "incremental_gold_monthly": _incremental_gold("gold_billable_hours_by_matter_month"),
    "incremental_gold_activity": _incremental_gold("gold_doc_activity_by_matter"),
    "incremental_gold_summary": _incremental_gold("gold_matter_summary"),
    "stream_expectation_metrics": stream_expectation_metrics,
    "rejected_rows": rejected_rows,
    "stream_daily_doc_activity": stream_daily_doc_activity,
    "compacted_silver": compacted_silver,
    "table_catalog": table_catalog_query,
}
