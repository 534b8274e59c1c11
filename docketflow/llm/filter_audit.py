"""Operator 12: what five filters remove, keep and cost in every order of application.

Four filters look at one text each; the fifth fails a text that a smaller id holds too.
Those are found without shuffling the corpus:

1. every document's flags, hash and digest are written as a narrow table;
2. a counting Bloom prepass: tasks count their hashes' cells, the counts of all tasks are
   merged shard by shard, and a hash with a cell counted once is surely unique;
3. only the texts of possible repeats are shuffled, grouped by the whole text, for the
   smallest id of each;
4. the flags of all documents are folded into counts per (part, flags, labels).  These are
   additive, so every order, step and Shapley sum comes from at most 128 counts a part.

The sketch has a fixed number of cells per document, so its power does not fall with the
size of the corpus.  Up to ``BROADCAST_BYTES`` of it go to every task, which clears texts
where they are read; a larger one stays in shards, the distinct hashes come to it, and the
texts are joined with the hashes that it could not clear.

Defined cases: a null text is empty, a null part the empty string; a document with a null
id repeats nothing and is no reason for another to; rows that share an id and a text are
both first; several labels of one id count once each kind, null labels as none; texts of
any length are judged and compared whole; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K
from .components import saved

#: Sketch: documents and cells of one shard (8 cells a document, 2 of them counted for each).
SHARD_DOCS = 1 << 16
CELLS = 8 * SHARD_DOCS
BROADCAST_BYTES = 64 << 20
#: Hashes that a task gathers before it sends their counts.
TASK_HASHES = 1 << 20
SKETCH = "shard int, once_n long, once binary, more_n long, more binary"
SKETCH_ARROW = pa.schema([("shard", pa.int32()), ("once_n", pa.int64()), ("once", pa.binary()), ("more_n", pa.int64()), ("more", pa.binary())])
FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> list[Column]:
    """Conditions of the filters A to D on a text that is not null."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return [n < 200, distinct.cast("long") * 100 < n.cast("long") * 50, capitals.cast("long") * 100 > F.length(text).cast("long") * 3, text.rlike("[#$%&*|]")]


def mask_of(conditions: list[Column]) -> Column:
    total = F.lit(0)
    for bit, condition in enumerate(conditions):
        total = total + F.when(condition, 1 << bit).otherwise(0)
    return total.cast("int")


def cells_of(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard of each 64-bit hash and its two different cells there."""
    own = K.mix(hashes, 21)
    shard = (own >> np.uint64(16)) % np.uint64(shards)
    first = K.mix(own, 22) % np.uint64(CELLS)
    step = np.uint64(1) + K.mix(own, 23) % np.uint64(CELLS - 1)
    return shard.astype(np.int64), first.astype(np.int64), ((first + step) % np.uint64(CELLS)).astype(np.int64)


def sketches(rows: DataFrame, shards: int) -> DataFrame:
    """Merged counting sketch of the column ``hash``: (shard, bits) of the cells counted more than once."""

    def counts(hashes: np.ndarray):
        u, n = np.unique(hashes, return_counts=True)
        shard, *pair = cells_of(u, shards)
        at = np.concatenate([shard * CELLS + c for c in pair])
        cell, inverse = np.unique(at, return_inverse=True)
        total = np.bincount(inverse, weights=np.tile(np.minimum(n, 2), 2), minlength=len(cell))
        cut = np.searchsorted(cell, np.arange(shards + 1) * CELLS)
        for s in np.flatnonzero(np.diff(cut)):
            own, twice = cell[cut[s] : cut[s + 1]] - s * CELLS, total[cut[s] : cut[s + 1]] > 1
            once, more = own[~twice].astype(np.uint64), own[twice].astype(np.uint64)
            yield int(s), len(once), X.pack(once), len(more), X.pack(more)

    def count(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch["hash"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            n += batch.num_rows
            if n >= TASK_HASHES:
                yield table(held)
                held, n = [], 0
        if n:
            yield table(held)

    def table(held) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*counts(np.concatenate(held)), strict=True), SKETCH_ARROW, strict=True)], schema=SKETCH_ARROW)

    def merge(blobs: pa.Table) -> pa.Table:
        seen = np.zeros(CELLS, np.uint8)
        for row in blobs.to_batches(max_chunksize=64):
            for _, once_n, once, more_n, more in zip(*[c.to_pylist() for c in row.columns], strict=True):
                seen[X.unpack(once, once_n).astype(np.int64)] += 1
                seen[X.unpack(more, more_n).astype(np.int64)] = 2
                np.minimum(seen, 2, out=seen)
        return pa.table([blobs["shard"][:1], pa.array([np.packbits(seen > 1).tobytes()], pa.binary())], names=["shard", "bits"])

    return rows.select("hash").mapInArrow(count, SKETCH).groupBy("shard").applyInArrow(merge, "shard int, bits binary")


def maybe_repeated(hashes: np.ndarray, bits: dict[int, np.ndarray], shards: int) -> np.ndarray:
    """Whether both cells of each hash were counted more than once."""
    shard, first, second = cells_of(hashes, shards)
    found = np.zeros(len(hashes), bool)
    for s in np.unique(shard):
        here = np.flatnonzero(shard == s)
        own = bits[int(s)]
        hit = np.ones(len(here), bool)
        for cell in (first[here], second[here]):
            hit &= (own[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
        found[here] = hit
    return found


def possible_repeats(rows: DataFrame, tables: list[DataFrame], documents: int) -> list[DataFrame]:
    """``tables``, each with a column ``hash``, and a column ``maybe``: false for hashes that stand once in ``rows``."""
    shards = -(-documents // SHARD_DOCS) or 1
    merged = saved(sketches(rows, shards), "sketch")
    if shards * CELLS // 8 <= BROADCAST_BYTES:
        sent = rows.sparkSession.sparkContext.broadcast({r.shard: bytes(r.bits) for r in merged.collect()})

        @F.pandas_udf("boolean")
        def look(hashes: pd.Series) -> pd.Series:
            bits = {s: np.frombuffer(b, np.uint8) for s, b in sent.value.items()}
            return pd.Series(maybe_repeated(hashes.to_numpy().astype(np.int64).view(np.uint64), bits, shards))

        return [t.withColumn("maybe", look("hash")) for t in tables]

    def lookup(hashes: pa.Table, own: pa.Table) -> pa.Table:
        if not hashes.num_rows:
            return pa.table({"hash": pa.array([], pa.int64())})
        at = hashes["hash"].to_numpy()
        bits = {own["shard"][0].as_py(): np.frombuffer(own["bits"][0].as_py(), np.uint8)}
        return pa.table({"hash": at[maybe_repeated(at.view(np.uint64), bits, shards)]})

    @F.pandas_udf("int")
    def shard_of(hashes: pd.Series) -> pd.Series:
        return pd.Series(cells_of(hashes.to_numpy().astype(np.int64).view(np.uint64), shards)[0].astype(np.int32))

    distinct = rows.select("hash").distinct().withColumn("shard", shard_of("hash"))
    found = saved(distinct.groupBy("shard").cogroup(merged.groupBy("shard")).applyInArrow(lookup, "hash long"), "possible")
    return [t.join(found.withColumn("maybe", F.lit(True)), "hash", "left").withColumn("maybe", F.coalesce("maybe", F.lit(False))) for t in tables]


def flag_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Documents per (part, mask of failed filters, good, toxic)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("hash"))
    facts = saved(base.select("id", "part", mask_of(failures(F.col("text"))).alias("mask"), "hash", F.unhex(F.sha2("text", 256)).alias("digest")), "flags")
    known, texts = possible_repeats(facts, [facts, base.select("id", "text", "hash")], facts.count())
    first = texts.where("maybe").groupBy("text").agg(F.min("id").alias("id")).select(F.unhex(F.sha2("text", 256)).alias("digest"), "id").withColumn("first", F.lit(True))
    repeats = known.where("maybe").groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")).join(first, ["id", "digest"], "left")
    late = F.col("id").isNotNull() & F.col("first").isNull()
    flagged = known.where("not maybe").select("id", "part", "mask", F.lit(1).cast("long").alias("n")).unionByName(
        repeats.select("id", "part", (F.col("mask") + F.when(late, 16).otherwise(0)).cast("int").alias("mask"), "n"))
    per_id = flagged.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    return per_id.join(marks, "id", "left").groupBy("part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(F.sum("n").alias("n"))


def audit(counts: DataFrame) -> DataFrame:
    """Every order and step from the additive counts: one row per part, filter_order and step."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = F.expr("shiftleft(1, ascii(substring(filter_order, step, 1)) - 65)")
    before = F.expr("aggregate(sequence(1, step), 0, (m, k) -> m | if(k < step, shiftleft(1, ascii(substring(filter_order, k, 1)) - 65), 0))")
    steps = steps.withColumn("bit", bit).withColumn("before", before)
    fails, passed = F.expr("mask & bit") > 0, F.expr("mask & before") == 0
    removed = fails & passed

    def total(condition: Column, n: Column | None = None) -> Column:
        return F.sum(F.when(condition, F.col("n") if n is None else n).otherwise(0)).cast("long")

    # of all orders, those in which the filter comes before the other ones that the document fails
    share = F.expr("n * (120 div bit_count(mask))")
    return steps.groupBy("part", "filter_order", F.col("step").cast("int").alias("step")).agg(
        total(passed & ~fails).alias("kept"), total(removed).alias("removed"), total(fails & ~passed).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"))


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents``: part, filter_order, step and their counts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return audit(flag_counts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP12_SQL = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as low from d),
m as (select doc_id, part, case when len(w) < 200 then 1 else 0 end + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
    + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end + case when doc_id > low then 16 else 0 end as mask from w),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
c as (select part, mask, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, count(*) as n from m left join l using (doc_id) group by all),
f(x, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits from f a, f b, f c, f d, f e
    where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1 : step - 1]), 0)::integer as before from o, range(1, 6) r(step)),
r as (select part, filter_order, step, bit, cast(sum(case when mask & (before | bit) = 0 then n else 0 end) as bigint) as kept,
    cast(sum(case when mask & before = 0 and mask & bit > 0 then n else 0 end) as bigint) as removed,
    cast(sum(case when mask & before > 0 and mask & bit > 0 then n else 0 end) as bigint) as redundant,
    cast(sum(case when mask = bit then n else 0 end) as bigint) as unique_fails,
    cast(sum(case when mask & before = 0 and mask & bit > 0 then n * good else 0 end) as bigint) as good_lost,
    cast(sum(case when mask & before = 0 and mask & bit > 0 then n * toxic else 0 end) as bigint) as toxic_lost
    from c, s group by part, filter_order, step, bit)
select part, filter_order, cast(step as integer) as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    cast(sum(removed) over (partition by part, bit) as bigint) as shapley from r
"""
