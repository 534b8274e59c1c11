"""Incremental gold: partial aggregates kept per bucket of matters, recomputed where new rows fall.

Layout under a generation::

    state/<partial>/v=<version>/bucket=<b>/   all partial rows of the bucket's matters, merged up to that version
    state/_files/<silver table>/v=<version>/  silver files that the version merged
    state/_manifest/v=<version>/              newest version of every (partial, bucket); written last, it commits

A refresh reads the silver files that no committed version has merged, merges their
partials with the kept ones of the buckets they fall into, and recomputes the gold rows of
these buckets; the other gold rows are carried over from the version that the manifest
belongs to.  Every version is written next to the older ones and becomes visible by its
manifest alone, so a refresh that dies leaves nothing behind that a later one would read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.operators import gold as G
from docketflow.operators.partials import PARTIALS, Partial, activity_from, bucket_of, doc_totals_from, monthly_from, revenue_from
from docketflow.operators.silver import SILVER
from docketflow.schemas import GOLD_COLUMNS, SILVER_COLUMNS

#: Buckets of matters, fixed when a generation's first state is written: size them so that one
#: holds a few hundred MB of partials (64 for tests, thousands at 100 TB).
BUCKETS = 64
DIMENSION = "silver_matters_master"
#: Which partials a gold table depends on; the summary also on the dimension.
DEPENDS = {
    "gold_billable_hours_by_matter_month": ("time",),
    "gold_doc_activity_by_matter": ("docs",),
    "gold_matter_lifecycle": ("events",),
    "gold_matter_summary": ("time", "docs", "events", DIMENSION),
}


@dataclass
class Refresh:
    version: str
    paths: dict[str, str]
    touched: dict[str, list[int]] = field(default_factory=dict)  # per partial (and the dimension), the buckets new rows fell into
    files: dict[str, list[str] | None] = field(default_factory=dict)  # per silver table, the files read; None: all


def _state(layout, *names: str) -> str:
    return layout.table("state", "/".join(names))


def committed_states(spark: SparkSession, layout) -> list[str]:
    """Versions whose manifest is complete, oldest first."""
    from docketflow.streaming.pipeline import COMMITTED, _number, list_children, path_exists

    base = _state(layout, "_manifest")
    return sorted((v for v in list_children(spark, base) if v.startswith("v=") and path_exists(spark, f"{base}/{v}/{COMMITTED}")), key=_number)


def plain_path(path: str) -> Column:
    """A path as Spark's logs and its metadata column write it, decoded, local ones with one slash."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def sink_files(spark: SparkSession, layout, silver: str) -> DataFrame:
    """(path, size) of the files that the stream into a silver table has committed, from the sink's own log.

    Spark's readers pass over the folders of a sink's log, so its lines come by way of text input.
    """
    reader = spark._jsparkSession.read().schema("path string, size long, action string")
    lines = DataFrame(reader.json(spark.sparkContext._jsc.textFile(f"{layout.table('silver', silver)}/_spark_metadata/[0-9]*")), spark)
    return lines.where("action = 'add'").select(plain_path("path").alias("path"), "size").distinct()


def fresh_files(spark: SparkSession, layout, silver: str, committed: list[str]) -> DataFrame:
    from docketflow.streaming.pipeline import list_children

    files = sink_files(spark, layout, silver).select("path")
    done = [f"{_state(layout, '_files', silver)}/{v}" for v in list_children(spark, _state(layout, "_files", silver)) if v in set(committed)]
    return files.join(spark.read.schema("path string").parquet(*done), "path", "left_anti") if done else files


def read_partial(spark: SparkSession, layout, partial: Partial, schema, manifest: dict, buckets: list[int]) -> DataFrame:
    """Kept rows of some buckets, each from the version that the manifest names."""
    paths = [f"{_state(layout, partial.name)}/{manifest[partial.name, b]}/bucket={b}" for b in buckets if (partial.name, b) in manifest]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def refresh_gold_incremental(spark: SparkSession, layout, run_id: str, buckets: int = BUCKETS, parallel: bool = True) -> Refresh:
    """Bring all gold tables up to date with silver, reading new silver files and the buckets they fall into."""
    from docketflow.streaming.pipeline import list_children, next_child, path_exists, read_silver

    committed = committed_states(spark, layout)
    last = committed[-1] if committed else None
    manifest: dict[tuple[str, int], str] = {}
    if last:
        rows = spark.read.parquet(f"{_state(layout, '_manifest')}/{last}").collect()  # partials times buckets
        manifest = {(r.partial, r.bucket): r.version for r in rows if r.partial}
        buckets = next(r.bucket for r in rows if not r.partial)
    version = next_child(spark, [layout.table("gold", n) for n in GOLD_COLUMNS] + [_state(layout, n) for n in (*PARTIALS, "_manifest")], "v=", run_id)
    done = Refresh(version, {n: f"{layout.table('gold', n)}/{version}" for n in GOLD_COLUMNS})
    bucket = bucket_of(buckets)

    def together(work, names) -> dict:
        with ThreadPoolExecutor(max_workers=len(names) if parallel else 1) as pool:
            futures = {n: pool.submit(work, n) for n in names}
            return {n: f.result() for n, f in futures.items()}

    def fresh(silver: str) -> DataFrame | None:
        """The rows of a silver table that no committed version has merged; None if there are none."""
        if not path_exists(spark, layout.table("silver", silver) + "/_spark_metadata"):
            done.files[silver] = []
            return None
        files = fresh_files(spark, layout, silver, committed)
        files.write.parquet(f"{_state(layout, '_files', silver)}/{version}")
        everything = read_silver(spark, layout, silver)
        if last is None:
            done.files[silver] = None
            return everything
        done.files[silver] = [r.path for r in spark.read.parquet(f"{_state(layout, '_files', silver)}/{version}").collect()]
        if not done.files[silver]:
            return None
        schema = SILVER[silver].typed(spark.createDataFrame([], _raw_schema(silver))).schema
        return spark.read.schema(schema).parquet(*done.files[silver]).select(*SILVER_COLUMNS[silver])

    def fallen(rows: DataFrame | None) -> list[int]:
        return [] if rows is None else sorted(r[0] for r in rows.select(bucket.alias("bucket")).distinct().collect())

    def merge(name: str):
        """Merge the new rows of a fact into its partial; returns the partial's schema.  Of the dimension only the buckets are wanted."""
        if name == DIMENSION:
            done.touched[name] = fallen(fresh(name))
            return None
        partial = PARTIALS[name]
        rows = fresh(partial.silver)
        schema = partial.build(read_silver(spark, layout, partial.silver)).schema
        done.touched[name] = fallen(rows) if last else []
        if rows is not None:
            kept_rows = [] if last is None else [read_partial(spark, layout, partial, schema, manifest, done.touched[name])]
            merged = partial.merge_by_bucket([partial.rows(rows), *kept_rows], buckets)
            merged.write.option("compression", "zstd").partitionBy("bucket").parquet(f"{_state(layout, name)}/{version}")
            if last is None:
                done.touched[name] = sorted(int(c.split("=")[1]) for c in list_children(spark, f"{_state(layout, name)}/{version}") if c.startswith("bucket="))
        return schema

    schemas = together(merge, [*PARTIALS, DIMENSION])
    if last and not any(done.touched.values()):
        return Refresh(last, {n: f"{layout.table('gold', n)}/{last}" for n in GOLD_COLUMNS}, done.touched, done.files)
    manifest |= {(name, b): version for name in PARTIALS for b in done.touched[name]}

    def kept(name: str, which: list[int]) -> DataFrame:
        return read_partial(spark, layout, PARTIALS[name], schemas[name], manifest, which)

    def write(table: str) -> None:
        touched = sorted({b for d in DEPENDS[table] for b in done.touched[d]})
        if table == "gold_matter_summary":
            matters = read_silver(spark, layout, DIMENSION).where(bucket.isin(touched))
            new = G.matter_summary_from_branches(matters, revenue_from(kept("time", touched)), G.summary_lifecycle_from_gold(kept("events", touched)), doc_totals_from(kept("docs", touched)))
        else:
            rows = kept(DEPENDS[table][0], touched)
            new = {"time": monthly_from, "docs": activity_from, "events": lambda df: df}[DEPENDS[table][0]](rows)
        new = G.contract(new, table)
        if last and len(touched) < buckets:
            old = spark.read.schema(new.schema).parquet(f"{layout.table('gold', table)}/{last}")
            new = new.unionByName(old.where(~bucket.isin(touched))) if touched else old
        new.write.parquet(done.paths[table])

    together(write, list(GOLD_COLUMNS))
    entries = [(name, b, v) for (name, b), v in sorted(manifest.items())] + [(None, buckets, None)]
    spark.createDataFrame(entries, "partial string, bucket int, version string").coalesce(1).write.parquet(f"{_state(layout, '_manifest')}/{version}")
    return done


def _raw_schema(silver: str):
    from docketflow.schemas import RAW_SCHEMAS

    return RAW_SCHEMAS[SILVER[silver].source]
