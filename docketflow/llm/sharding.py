"""Operator 7: proportional stratified interleaving into shards (DataFrame functions only).

Rows are shuffled within their source by a seeded digest of the id and ranked; a row of
rank r among n has the fractional rank (r + 1/2) / n.  In the order of fractional ranks
every stretch holds each source in proportion, so cutting the order into equal stretches
gives shards that each match the mixture, with row counts at most one apart.

Both orders are counted out without a task that holds a whole source: the digest (and
then the fractional rank) is cut into equal ranges, which are even by construction;
ranges are counted, summed up and ranked each on its own.

Defined cases: a null source is a source of its own; a null text has no bytes and the
checksum 0; ties in the digest (repeated ids) go by id, checksum and size, so rows that
still tie are equal in every column of the result; texts of any length are only measured;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE_ROWS = 50_000


def _counted(rows: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """Adds ``name``: each row's place (from 0) within ``keys`` in the order of its range, then of ``order``; and n, the rows of its key."""
    counts = rows.groupBy(*keys, "range").agg(F.count(F.lit(1)).alias("here"))
    key = W.partitionBy(*keys)
    before = counts.select(*keys, "range", F.coalesce(F.sum("here").over(key.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("here").over(key).alias("n"))
    place = F.row_number().over(W.partitionBy(*keys, "range").orderBy(*order)) - 1
    return rows.withColumn("_place", place).join(before, [*keys, "range"]).withColumn(name, F.col("_place") + F.col("before")).drop("_place", "before")


def interleave(docs: DataFrame, shards: int, seed: str = "0", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, text_crc32, shard, slot."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    rows = docs.select(
        F.col(id_col).alias("id"), F.struct(F.col(source_col).alias("source")).alias("stratum"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("digest"),
    )
    total = docs.count()
    ranges = max(1, total // RANGE_ROWS)
    start = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    ranged = rows.withColumn("range", F.floor(start * ranges / F.lit(2**32)).cast("int"))
    ranked = _counted(ranged, ["stratum"], ["digest", "id", "text_crc32", "size"], "rank")
    part = (F.col("rank") + F.lit(0.5)) / F.col("n")
    mixed = ranked.drop("range").withColumn("part", part).withColumn("range", F.floor(F.col("part") * ranges).cast("int")).drop("n").withColumn("all", F.lit(0))
    placed = _counted(mixed, ["all"], ["part", "stratum", "rank"], "place")
    shard = F.expr(f"(place * {shards}) div n")
    first = F.expr(f"(shard * n + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("place") - first).select("id", F.col("stratum.source").alias("source"), "size", "text_crc32", "shard", "slot")


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents``: doc_id, size, text_crc32, law, shard, slot, grown_shard, source."""
    found = interleave(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
