"""Compaction of silver: the streams' files rewritten as large files clustered by time and matter.

Layout under a generation::

    compact/<silver table>/data/v=<version>/       clustered rows
    compact/<silver table>/_files/v=<version>/     silver files whose rows they are
    compact/<silver table>/_manifest/v=<version>/  per clustered file its rows and the least and greatest matter and time; commits

Rows are ranged by (month, matter, time): a file holds a stretch of matters within a month or
a few, so reads of one matter and reads of a time range both leave most files out, and a
matter with a third of all rows spreads over many files.  Readers take the newest committed
version and, beside it, the silver files that have come since.  Nothing is replaced in place:
streams and readers of silver, or of an older version, go on undisturbed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.operators.silver import SILVER
from docketflow.schemas import RAW_SCHEMAS, SILVER_COLUMNS
from docketflow.streaming.gold_state import plain_path, sink_files
from docketflow.streaming.pipeline import COMMITTED, _number, list_children, next_child, path_exists

#: Silver bytes that go into one clustered file.
TARGET_BYTES = 256 << 20
#: Rows that go into one clustered file, for a task sorts a file's rows in memory: uncompressed
#: they take many times the bytes of silver, under 1 GB for this many of a few hundred bytes.
TARGET_ROWS = 2_000_000
#: The column that tells a row's time.
TIMES = {"silver_time_entries": "entry_date", "silver_doc_audit": "audit_ts", "silver_matter_events": "event_ts"}


def _base(layout, name: str) -> str:
    return layout.table("compact", name)


def _silver_schema(spark: SparkSession, name: str):
    spec = SILVER[name]
    return spec.typed(spark.createDataFrame([], RAW_SCHEMAS[spec.source])).schema


def compact_silver(spark: SparkSession, layout, name: str, run_id: str, target_bytes: int = TARGET_BYTES,
                   target_rows: int = TARGET_ROWS) -> str:
    """Writes a clustered copy of all rows that the table holds now; returns its version."""
    base, time = _base(layout, name), TIMES[name]
    version = next_child(spark, [f"{base}/{part}" for part in ("data", "_files", "_manifest")], "v=", run_id)
    sink_files(spark, layout, name).write.parquet(f"{base}/_files/{version}")
    files = spark.read.parquet(f"{base}/_files/{version}")
    rows = spark.read.schema(_silver_schema(spark, name)).parquet(layout.table("silver", name))
    # the files of the list and no later ones, whatever the stream adds meanwhile
    rows = rows.select("*", plain_path("_metadata.file_path").alias("path")).join(files.select("path"), "path", "left_semi").drop("path")
    n = max(1, -(-(files.agg(F.sum("size")).first()[0] or 0) // target_bytes), -(-rows.count() // target_rows))
    order = [F.trunc(F.to_date(time), "month"), F.col("matter_id"), F.col(time)]
    data = f"{base}/data/{version}"
    # the rows of one matter and time may be many: a hash after them lets these spread over files, too
    rows.repartitionByRange(n, *order, F.xxhash64(*[c for c in rows.columns if not c.startswith("_")])).sortWithinPartitions(*order).write.parquet(data)
    spread = spark.read.schema(rows.schema).parquet(data).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("matter_id").alias("matter_low"), F.max("matter_id").alias("matter_high"),
        F.min(F.to_timestamp(time)).alias("time_low"), F.max(F.to_timestamp(time)).alias("time_high"))
    spread.write.parquet(f"{base}/_manifest/{version}")
    return version


def compacted_version(spark: SparkSession, layout, name: str) -> str | None:
    base = f"{_base(layout, name)}/_manifest"
    done = [v for v in list_children(spark, base) if v.startswith("v=") and path_exists(spark, f"{base}/{v}/{COMMITTED}")]
    return max(done, key=_number, default=None)


def read_compacted(spark: SparkSession, layout, name: str, matter_id: str | None = None,
                   since: dt.datetime | None = None, before: dt.datetime | None = None) -> DataFrame:
    """Rows of a silver table, of one matter and of times in [since, before) if given, from the files that may hold any."""
    schema, time, base = _silver_schema(spark, name), TIMES[name], _base(layout, name)
    version = compacted_version(spark, layout, name)
    fresh = sink_files(spark, layout, name).select("path")
    chosen = spark.createDataFrame([], "path string")
    if version:
        fresh = fresh.join(spark.read.parquet(f"{base}/_files/{version}").select("path"), "path", "left_anti")
        chosen = spark.read.parquet(f"{base}/_manifest/{version}")
        if matter_id is not None:
            chosen = chosen.where((F.col("matter_low") <= matter_id) & (F.col("matter_high") >= matter_id))
        if since is not None:
            chosen = chosen.where(F.col("time_high") >= F.lit(since))
        if before is not None:
            chosen = chosen.where(F.col("time_low") < F.lit(before))
        chosen = chosen.select(plain_path("path").alias("path"))
    paths = [r.path for r in chosen.unionByName(fresh).collect()]
    rows = (spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)).select(*SILVER_COLUMNS[name])
    if matter_id is not None:
        rows = rows.where(F.col("matter_id") == matter_id)
    if since is not None:
        rows = rows.where(F.col(time) >= F.lit(since))
    return rows.where(F.col(time) < F.lit(before)) if before is not None else rows
