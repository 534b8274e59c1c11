"""Incremental medallion pipeline: landing JSON -> bronze -> silver (streams) -> gold (batch).

Layout under ``root`` (a shared folder, e.g. below ``spark.checkpoint.dir``)::

    gen=<n>-<run_id>/bronze/<dataset>/          parquet file-sink output (+ _spark_metadata log)
    gen=<n>-<run_id>/silver/<dataset>/          same; not partitioned (see note below)
    gen=<n>-<run_id>/rejected/<dataset>/        rows refused by the drop rules (``keep_rejected``)
    gen=<n>-<run_id>/stream/<name>/             windowed streaming aggregates (``windows``)
    gen=<n>-<run_id>/state/                     partials of incremental gold (``gold_state``)
    gen=<n>-<run_id>/_checkpoints/<layer>/<dataset>/
    gen=<n>-<run_id>/gold/<table>/v=<n>-<run_id>/   one immutable version per refresh
    gen=<n>-<run_id>/metrics/dataset=<dataset>/batch_id=<id>/   expectation counts per micro-batch

``<n>`` counts up, so that the newest is the one committed last, whatever the run ids.

Bronze and silver are append-only streams run with ``trigger(availableNow=True)``:
each run consumes only files not seen before (file-source log + checkpoint give
exactly-once output even if executors or the driver die mid-run; a rerun resumes).
Gold is recomputed from silver and written to a new version directory, so a failed
refresh never exposes a half-written table.  A full refresh starts a new generation
(fresh checkpoints and outputs) and replays every landed file; nothing is deleted.

Silver is deliberately not ``partitionBy(date)``: late or back-filled rows spread a
micro-batch over many dates, and every task would then write one small file per
date (thousands per batch).  Silver stays a narrow map-only step; date filters are
pushed to the parquet scan and skip row groups through min/max statistics.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.operators import gold as G
from docketflow.operators.expectations import metrics_frame, metrics_rows
from docketflow.operators.silver import SILVER, SILVER_BY_SOURCE
from docketflow.schemas import GOLD_COLUMNS, RAW_SCHEMAS, SILVER_COLUMNS, SOURCES, bronze_schema
from docketflow.sources.rescue import rescue_json

TABLE_COMMENTS = {
    "bronze_matter_events": "Landed matter event lines as read, with rescued fields, file and time of ingestion.",
    "bronze_time_entries": "Landed time entry lines as read, with rescued fields, file and time of ingestion.",
    "bronze_doc_audit": "Landed document audit lines as read, with rescued fields, file and time of ingestion.",
    "bronze_matters_master": "Landed matter dimension lines as read; the dimension lands a single time.",
    "silver_matter_events": "Matter events that pass every drop rule, time of the event typed.",
    "silver_time_entries": "Time entries that pass every drop rule, with decimal hours, rate and amount, and the rate tier.",
    "silver_doc_audit": "Document audit rows with a known action and a document, time typed.",
    "silver_matters_master": "Matters with an id, opening time typed; unknown practice areas are kept and counted.",
    "gold_billable_hours_by_matter_month": "Sums of billable hours and amounts, users and entries, by matter and month of the entry.",
    "gold_doc_activity_by_matter": "Number of audit rows, documents and users, first and last time, by matter and action.",
    "gold_matter_lifecycle": "Events of each matter: first, last, how many in all and of each kind, offices.",
    "gold_matter_summary": "A row for each matter of the dimension with its revenue, lifecycle and document totals.",
}

METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("rule", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_failed", T.LongType()),
])


def new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


# ---------------------------------------------------------------- file system helpers (Hadoop FS: any store)

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def latest_child(spark: SparkSession, path: str, prefix: str, marker: str | None = None) -> str | None:
    """Newest child named ``prefix<number>-...``; with ``marker``, only children containing that file."""
    names = [n for n in list_children(spark, path) if n.startswith(prefix)]
    for name in sorted(names, key=_number, reverse=True):
        if marker is None or path_exists(spark, f"{path.rstrip('/')}/{name}/{marker}"):
            return name
    return None


def _number(name: str) -> int:
    return int(re.search(r"=(\d*)", name)[1] or 0)


def next_child(spark: SparkSession, paths: list[str], prefix: str, run_id: str) -> str:
    """A name that no child of ``paths`` has and that is newer than all of them."""
    numbers = [_number(n) for path in paths for n in list_children(spark, path) if n.startswith(prefix)]
    return f"{prefix}{max(numbers, default=0) + 1:06d}-{run_id}"


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


COMPLETE = "_COMPLETE"   # written after a pipeline run finished: the generation is readable
COMMITTED = "_SUCCESS"   # written by Spark's output committer when a gold version is complete


# ---------------------------------------------------------------- layout

@dataclass
class Layout:
    root: str
    generation: str

    @property
    def base(self) -> str:
        return f"{self.root.rstrip('/')}/{self.generation}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.base}/_checkpoints/{layer}/{name}"

    @property
    def metrics(self) -> str:
        return f"{self.base}/metrics"


def current_layout(spark: SparkSession, root: str, new_generation: bool = False, run_id: str | None = None) -> Layout:
    """Generation a run writes to: the newest one (a failed full refresh is resumed), or a new one."""
    gen = None if new_generation else latest_child(spark, root, "gen=")
    return Layout(root, gen or next_child(spark, [root], "gen=", run_id or new_run_id()))


def readable_layout(spark: SparkSession, root: str) -> Layout:
    """Newest generation whose pipeline run completed; readers never see a half-built replay."""
    gen = latest_child(spark, root, "gen=", marker=COMPLETE)
    if gen is None:
        raise FileNotFoundError(f"no completed pipeline run under {root}")
    return Layout(root, gen)


# ---------------------------------------------------------------- bronze

#: How long landed files are kept.  A file whose modification time lies further behind the
#: newest one than this would be passed over by the file source, so ``run_pipeline`` refuses it.
#: The file source remembers the files of this span on the driver: set it to the landing's retention.
LANDING_RETENTION_DAYS = 3650
#: Input of one micro-batch, unless a number of files is given.
MAX_BYTES_PER_TRIGGER = 64 << 30


def _bounded(reader, max_files_per_trigger: int | None, retention_days: int):
    reader = reader.option("maxFileAge", f"{retention_days}d")
    if max_files_per_trigger:
        return reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.option("maxBytesPerTrigger", str(MAX_BYTES_PER_TRIGGER))


def _log_entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path, batchId) of all files that a file stream has taken up, from its own log."""
    lines = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    return lines.select(F.from_json("value", "path string, batchId long").alias("f")).select("f.*").distinct()


def too_old(spark: SparkSession, path: str, retention_days: int, checkpoint: str | None = None, at_most: int = 10) -> list[str]:
    """Some of the files that lie further behind the newest file of ``path`` than the retention.

    Files that the stream of ``checkpoint`` has already taken up do not count.  Names and
    times are compared in Spark: one small job if no file is old.
    """
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.unix_seconds("modificationTime").alias("time"))
    newest, oldest = files.agg(F.max("time"), F.min("time")).first()
    if newest is None or newest - oldest <= retention_days * 86_400:
        return []
    old = files.where(F.col("time") < newest - retention_days * 86_400)
    if checkpoint and path_exists(spark, f"{checkpoint}/sources/0"):
        seen = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))  # the log holds encoded URIs
        old = old.join(_log_entries(spark, checkpoint).select(seen.alias("name")), "name", "left_anti")
    return [r["name"] for r in old.orderBy("name").limit(at_most).collect()]


def bronze_stream(spark: SparkSession, landing: str, source: str, max_files_per_trigger: int | None = None,
                  retention_days: int = LANDING_RETENTION_DAYS) -> DataFrame:
    """Unbounded DataFrame over ``landing/source``: rescued raw fields + ingestion columns."""
    reader = _bounded(spark.readStream.format("text"), max_files_per_trigger, retention_days)
    lines = reader.load(f"{landing.rstrip('/')}/{source}").select(
        "value", F.col("_metadata.file_path").alias("_source_file"))
    rescued = rescue_json(lines, RAW_SCHEMAS[source], keep=("_source_file",))
    return rescued.withColumn("_ingested_at", F.current_timestamp()).select(*bronze_schema(source).fieldNames())


def _sink(df: DataFrame, path: str, checkpoint: str, name: str, partition_by: str | None = None):
    w = (
        df.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(partition_by)
    return w.start(path)


# ---------------------------------------------------------------- silver

def read_bronze_stream(spark: SparkSession, layout: Layout, source: str,
                       max_files_per_trigger: int | None = None,
                       retention_days: int = LANDING_RETENTION_DAYS) -> DataFrame:
    bronze_name = SOURCES[source][0]
    reader = _bounded(spark.readStream.schema(bronze_schema(source)), max_files_per_trigger, retention_days)
    return reader.parquet(layout.table("bronze", bronze_name))


def _finished(query) -> list:
    """Waits for an availableNow query; its latest progress entries."""
    query.awaitTermination()
    return list(query.recentProgress)


# ---------------------------------------------------------------- expectation counters

def _batches_without(spark: SparkSession, checkpoint: str, stored: set[int]) -> tuple[list[int], DataFrame | None]:
    """Committed micro-batches that are not in ``stored``, and the log (path, batchId) of the files of all batches.

    Spark purges the logs of commits and offsets, but not that of the files: all of its
    batches up to the end of the last committed one are done.  Only numbers of batches
    without counters reach the driver.
    """
    done = [int(n) for n in list_children(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return [], None
    offsets = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{max(done)}").collect()]
    end = max(_log_offset(v) for v in offsets if "logOffset" in v)
    first = 0
    while first in stored:
        first += 1
    entries = _log_entries(spark, checkpoint)
    if first > end:
        return [], entries
    later = entries.where(F.col("batchId").between(first, end)).select("batchId").distinct()
    return sorted(r.batchId for r in later.collect() if r.batchId not in stored), entries


def _log_offset(offset: str | None) -> int:
    """Number of a batch in the log of files, from an offset of the file source; -1 before the first one."""
    found = re.search(r'"logOffset"\s*:\s*(-?\d+)', offset or "")
    return int(found[1]) if found else -1


def record_metrics(spark: SparkSession, layout: Layout, source: str, run_id: str, progress: list) -> list[tuple]:
    """Stores the counters of every committed silver micro-batch that has none yet; returns this call's rows.

    The batches of this run come from their progress.  Others (of a run that failed before
    it came here, or beyond the progress that Spark keeps) are counted again from the
    bronze files they read.  Each batch is a partition of its own that is written whole,
    so that a repeated call changes nothing.
    """
    name = SOURCES[source][1]
    rules, obs = SILVER[name].rules, f"dq_{name}"
    stored = {int(n.split("=", 1)[1]) for n in list_children(spark, f"{layout.metrics}/dataset={name}") if n.startswith("batch_id=")}
    batches, log = _batches_without(spark, layout.checkpoint("silver", name), stored)
    seen = {}
    for p in progress:
        start, end = _log_offset(p.sources[0].startOffset), _log_offset(p.sources[0].endOffset)
        if obs in (p.observedMetrics or {}) and end == start + 1:  # else its files are of several batches of the log
            seen[end] = p.observedMetrics[obs].asDict()
    rows = []
    for batch in batches:
        if batch in seen:
            counted = [m[1:] for m in metrics_rows(name, rules, [seen[batch]])]
        else:
            files = [r.path for r in log.where(F.col("batchId") == batch).select("path").collect()]  # of one micro-batch
            bronze = spark.read.schema(bronze_schema(source)).parquet(*files)
            counted = [tuple(r)[1:] for r in metrics_frame(SILVER[name].typed(bronze), name, rules).collect()]  # one row per rule
        rows += [(run_id, name, *c, batch) for c in counted]
    if rows:
        # one small file per micro-batch and dataset
        table = spark.createDataFrame(rows, T.StructType([*METRICS_SCHEMA.fields, T.StructField("batch_id", T.LongType())])).coalesce(1)
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "batch_id").parquet(layout.metrics)
    return rows


# ---------------------------------------------------------------- reading layer tables

def read_silver(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    spec = SILVER[name]
    schema = spec.typed(spark.createDataFrame([], RAW_SCHEMAS[spec.source])).schema
    path = layout.table("silver", name)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).select(*SILVER_COLUMNS[name])
    return spark.read.schema(schema).parquet(path).select(*SILVER_COLUMNS[name])


def committed_gold_version(spark: SparkSession, layout: Layout) -> str:
    """Newest refresh (``v=<number>-<run_id>``) whose every gold table committed: one consistent snapshot."""
    common = None
    for name in GOLD_COLUMNS:
        base = layout.table("gold", name)
        done = {v for v in list_children(spark, base)
                if v.startswith("v=") and path_exists(spark, f"{base}/{v}/{COMMITTED}")}
        common = done if common is None else common & done
    if not common:
        raise FileNotFoundError(f"no complete gold refresh under {layout.base}")
    return max(common, key=_number)


def read_gold(spark: SparkSession, layout: Layout, name: str, version: str | None = None) -> DataFrame:
    version = version or committed_gold_version(spark, layout)
    return spark.read.parquet(f"{layout.table('gold', name)}/{version}").select(*GOLD_COLUMNS[name])


def read_bronze(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    source = next(s for s, (b, _) in SOURCES.items() if b == name)
    if not path_exists(spark, layout.table("bronze", name)):
        return spark.createDataFrame([], bronze_schema(source))
    return spark.read.schema(bronze_schema(source)).parquet(layout.table("bronze", name))


def read_layer_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    layout = readable_layout(spark, root)
    if name.startswith("silver_"):
        return read_silver(spark, layout, name)
    if name.startswith("gold_"):
        return read_gold(spark, layout, name)
    return read_bronze(spark, layout, name)


# ---------------------------------------------------------------- gold

def refresh_gold(spark: SparkSession, layout: Layout, run_id: str, parallel: bool = True) -> dict[str, str]:
    """Recompute all gold tables from silver into new version directories; return their paths.

    Two pre-aggregates are written first: billable sums per (matter, month) and audit
    rows per (matter, action, document).  The monthly, document and summary tables share
    them, and the summary never touches silver facts.  Time entries, the largest fact, are
    shuffled once; the rows of the most frequent matters, which that would gather in a few
    tasks, are spread by user and by entry instead.  Independent tables are submitted
    concurrently (their small final stages then overlap instead of leaving cores idle).
    """
    from concurrent.futures import ThreadPoolExecutor

    silver = {name: read_silver(spark, layout, name) for name in SILVER}
    # numbered over all that a refresh writes, so that one that died under the same run id is in no one's way
    version = next_child(spark, [layout.table("gold", name) for name in (*GOLD_COLUMNS, "_by_month", "_by_doc")], "v=", run_id)
    written: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        path = f"{layout.table('gold', name)}/{version}"
        if name in GOLD_COLUMNS:
            df = G.contract(df, name)
            written[name] = path
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def together(tables: dict) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(max_workers=len(tables) if parallel else 1) as pool:
            futures = {name: pool.submit(write, name, df) for name, df in tables.items()}
            return {name: f.result() for name, f in futures.items()}

    entries, docs = silver["silver_time_entries"], silver["silver_doc_audit"]
    frequent = G.frequent_matters(entries)
    shared = together({
        "_by_month": G.billable_by_month(entries, frequent),
        "_by_doc": G.doc_activity_by_doc(docs),
        "gold_matter_lifecycle": G.matter_lifecycle(silver["silver_matter_events"]),
    })
    together({
        "gold_billable_hours_by_matter_month": G.billable_hours_from(shared["_by_month"], entries, frequent),
        "gold_doc_activity_by_matter": G.doc_activity_by_matter(docs, shared["_by_doc"]),
        "gold_matter_summary": G.matter_summary_from_branches(
            silver["silver_matters_master"],
            G.summary_revenue_from(shared["_by_month"]),
            G.summary_lifecycle_from_gold(shared["gold_matter_lifecycle"]),
            G.summary_doc_activity_from(shared["_by_doc"]),
        ),
    })
    return written


# ---------------------------------------------------------------- catalog (comments + quality property)

def register_tables(spark: SparkSession, layout: Layout, gold_paths: dict[str, str], database: str = "docketflow") -> None:
    """(Re)creates the catalog entries of all layer tables that exist; give each root a database of its own."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    locations = {}
    for source, (bronze_name, silver_name) in SOURCES.items():
        locations[bronze_name] = ("bronze", layout.table("bronze", bronze_name))
        locations[silver_name] = ("silver", layout.table("silver", silver_name))
    for name, path in gold_paths.items():
        locations[name] = ("gold", path)
    for name, (quality, path) in locations.items():
        if not path_exists(spark, path):
            continue  # its source has not landed yet
        comment = TABLE_COMMENTS[name].replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")  # drops the catalog entry only (external table)
        spark.sql(
            f"CREATE TABLE {database}.{name} USING parquet LOCATION '{path}' "
            f"COMMENT '{comment}' TBLPROPERTIES ('quality' = '{quality}')"
        )


def table_catalog(spark: SparkSession, database: str = "docketflow") -> DataFrame:
    """(table, comment, quality) for every registered layer table."""
    rows = []
    for t in spark.catalog.listTables(database):
        props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{t.name}").collect()}
        rows.append((t.name, t.description, props.get("quality")))
    return spark.createDataFrame(rows, "table string, comment string, quality string")


# ---------------------------------------------------------------- the pipeline

@dataclass
class RunResult:
    run_id: str
    layout: Layout
    gold_paths: dict[str, str]
    metrics: list[tuple] = field(default_factory=list)
    bronze_input_lines: dict[str, int] = field(default_factory=dict)
    silver_input_rows: dict[str, int] = field(default_factory=dict)


def _rows(progress: list) -> int:
    return int(sum(p.numInputRows for p in progress))


def run_bronze_source(spark: SparkSession, landing: str, layout: Layout, source: str,
                      max_files_per_trigger: int | None = None, retention_days: int = LANDING_RETENTION_DAYS) -> list:
    """Ingests what one source has landed since the last run."""
    name = SOURCES[source][0]
    stale = too_old(spark, f"{landing.rstrip('/')}/{source}", retention_days, layout.checkpoint("bronze", name))
    if stale:
        raise ValueError(f"{source}: files older than the landing retention of {retention_days} days would be skipped: {stale}")
    return _finished(_sink(bronze_stream(spark, landing, source, max_files_per_trigger, retention_days),
                           layout.table("bronze", name), layout.checkpoint("bronze", name), f"{name}_{layout.generation}"))


def _run_source(spark: SparkSession, landing: str, layout: Layout, source: str, run_id: str,
                max_files_per_trigger: int | None, retention_days: int, keep_rejected: bool = False) -> tuple[list, list, list[tuple]]:
    """bronze, silver and its counters for one source; returns (bronze progress, silver progress, metrics)."""
    bronze_progress = run_bronze_source(spark, landing, layout, source, max_files_per_trigger, retention_days)
    name = SOURCES[source][1]
    typed = SILVER_BY_SOURCE[source].build_observed(
        read_bronze_stream(spark, layout, source, max_files_per_trigger, retention_days), f"dq_{name}")
    progress = _finished(_sink(typed, layout.table("silver", name), layout.checkpoint("silver", name), f"{name}_{layout.generation}"))
    if keep_rejected:
        run_rejected(spark, layout, source, max_files_per_trigger, retention_days)
    return bronze_progress, progress, record_metrics(spark, layout, source, run_id, progress)


def run_rejected(spark: SparkSession, layout: Layout, source: str, max_files_per_trigger: int | None = None,
                 retention_days: int = LANDING_RETENTION_DAYS) -> list:
    """The rows that the drop rules refuse, with the rules each one failed, as a table beside silver.

    A stream of its own over the same bronze rows: exactly once like silver's, and a run that
    dies between the two is made up for by the next one, from the files each has not yet
    taken up.  So after every completed run silver and rejected rows together are bronze.
    """
    name = SOURCES[source][1]
    refused = SILVER[name].rejected(read_bronze_stream(spark, layout, source, max_files_per_trigger, retention_days))
    return _finished(_sink(refused, layout.table("rejected", name), layout.checkpoint("rejected", name), f"rejected_{name}_{layout.generation}"))


def read_rejected(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Rejected rows of a silver dataset: its columns and ``_failed_rules``."""
    schema = SILVER[name].rejected(spark.createDataFrame([], bronze_schema(SILVER[name].source))).schema
    path = layout.table("rejected", name)
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def run_pipeline(spark: SparkSession, landing: str, root: str, run_id: str | None = None,
                 full_refresh: bool = False, max_files_per_trigger: int | None = None,
                 register: bool = True, database: str = "docketflow",
                 retention_days: int = LANDING_RETENTION_DAYS, incremental_gold: bool = False,
                 keep_rejected: bool = False) -> RunResult:
    """bronze -> silver -> counters per source, then gold; each stream runs to completion.

    The four sources run side by side, each chaining its silver stream right after
    its own bronze stream, so small sources do not wait for the largest one; gold
    starts when every silver stream has finished.  A backlog is consumed in micro-batches
    of bounded bytes (or ``max_files_per_trigger`` files).  The expectation counters are
    stored before gold starts, so a failed gold refresh loses none.  With ``incremental_gold``
    gold is brought up to date from new silver files (``gold_state``) instead of recomputed.
    With ``keep_rejected`` the rows that the drop rules refuse are kept beside silver.
    """
    from concurrent.futures import ThreadPoolExecutor

    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError("dates are taken in UTC: set spark.sql.session.timeZone to UTC")
    run_id = run_id or new_run_id()
    layout = current_layout(spark, root, new_generation=full_refresh, run_id=run_id)
    sources = [s for s in SOURCES if path_exists(spark, f"{landing.rstrip('/')}/{s}")]
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        futures = {s: pool.submit(_run_source, spark, landing, layout, s, run_id, max_files_per_trigger, retention_days, keep_rejected)
                   for s in sources}
        done = {s: f.result() for s, f in futures.items()}
    if incremental_gold:
        from docketflow.streaming.gold_state import refresh_gold_incremental

        gold_paths = refresh_gold_incremental(spark, layout, run_id).paths
    else:
        gold_paths = refresh_gold(spark, layout, run_id)
    touch(spark, f"{layout.base}/{COMPLETE}")
    if register:
        register_tables(spark, layout, gold_paths, database)
    totals: dict[tuple, list[int]] = {}
    for s in sources:
        for _, dataset, rule, action, n_rows, n_failed, _ in done[s][2]:
            t = totals.setdefault((dataset, rule, action), [0, 0])
            t[0], t[1] = t[0] + n_rows, t[1] + n_failed
    return RunResult(
        run_id, layout, gold_paths, [(run_id, *k, *v) for k, v in totals.items()],
        {SOURCES[s][0]: _rows(done[s][0]) for s in sources},
        {SOURCES[s][1]: _rows(done[s][1]) for s in sources},
    )


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Counters of every micro-batch: run_id, dataset, rule, action, n_rows, n_failed, batch_id."""
    layout = readable_layout(spark, root)
    schema = T.StructType([*METRICS_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(layout.metrics).select(*schema.names)
