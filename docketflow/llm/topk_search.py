"""Operator 2: exact top-k search by inner product over one KD-tree per shard.

Vectors are dealt into shards of bounded size.  A shard's tree comes from median splits
on the widest component; each leaf keeps the tight bounding box of its vectors.  The best
inner product of a query with any point of a box is a sum of per-component maxima; a
query takes a shard's leaves in the order of these bounds and stops at the first bound
under its k-th score so far.  A first pass over one shard gives each block of queries
its first k-th scores, which the second pass carries to all other shards.

Queries meet shards in blocks: a row is one shard's tree with one block of queries.

Defined cases: vectors that are null or hold null, NaN or infinite components take no
part, nor rows with a null id; vectors of different lengths never meet; a candidate with
the query's id is the query itself; ties go to the smaller id; fewer candidates than k
give all of them; repeated rows are candidates each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.components import saved

SHARD_ROWS, QUERY_ROWS, LEAF = 16_384, 512, 256
HIT = pa.struct([("qblock", pa.int32())])


def leaves(vectors: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves of a KD-tree: median splits on the widest component."""
    todo, out = [np.arange(len(vectors))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        some = vectors[rows]
        wide = some.max(0) - some.min(0)
        if not wide.max():
            out += [rows[a : a + size] for a in range(0, len(rows), size)]
            continue
        half = len(rows) // 2
        order = np.argpartition(some[:, int(wide.argmax())], half)
        todo += [rows[order[half:]], rows[order[:half]]]
    return out


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest inner product of each query with any point of each box."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > 4 * k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search(vectors: np.ndarray, ids: np.ndarray, cuts: np.ndarray, low: np.ndarray, high: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """For each query: its best scores and ids in this shard that can still be among its k best."""
    bound = bounds(queries, low, high)
    order = np.argsort(-bound, axis=1, kind="stable")
    for q in range(len(queries)):
        scores, found, kth = np.zeros(0, vectors.dtype), np.zeros(0, np.int64), floor[q]
        for leaf in order[q]:
            if bound[q, leaf] < kth:
                break
            a, b = cuts[leaf], cuts[leaf + 1]
            s, i = vectors[a:b] @ queries[q], ids[a:b]
            ok = (s >= kth) & (i != own[q])
            if ok.any():
                scores, found = best(np.concatenate([scores, s[ok]]), np.concatenate([found, i[ok]]), k)
                if len(scores) == k:
                    kth = max(kth, scores[-1])
        yield scores, found


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.int64).reshape(-1, dim) if len(flat) else np.zeros((0, dim), np.int64)


def _kind(a: np.ndarray, b_max: int, dim: int):
    """float64 where every inner product is exact in it, else int64."""
    return np.float64 if int(np.abs(a).max(initial=0)) * b_max * dim < 2**52 else np.int64


def top_k(vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each query, by inner product of floor(scale * x)."""
    good = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    src = vectors.where(good).select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"), is_query.alias("asks")).withColumn("dim", F.size("v")).where("dim > 0")
    sizes = {r["dim"]: (r["n"], r["m"]) for r in src.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("m")).collect()}
    parts = [_top_k_of(src.where(F.col("dim") == dim), dim, n, int(m), k) for dim, (n, m) in sorted(sizes.items())]
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _top_k_of(src: DataFrame, dim: int, n: int, largest: int, k: int) -> DataFrame:
    shards = max(1, -(-n // SHARD_ROWS))
    by = F.xxhash64("id")
    kind = np.float64 if largest * largest * dim < 2**52 else np.int64

    def build(table: pa.Table) -> pa.Table:
        v, ids = _matrix(table["v"], dim).astype(kind), np.asarray(table["id"], np.int64)
        parts = leaves(v)
        rows = np.concatenate(parts)
        low, high = (np.array([f(v[p], axis=0) for p in parts]) for f in (np.min, np.max))
        cuts = np.cumsum([0, *[len(p) for p in parts]])
        body = [x.tobytes() for x in (v[rows], ids[rows], cuts.astype(np.int64), low, high)]
        return pa.table([pa.array([table["shard"][0].as_py()], pa.int32()), pa.array([len(parts)], pa.int32()), *[pa.array([b], pa.binary()) for b in body]], names=["shard", "leaves", "vectors", "ids", "cuts", "low", "high"])

    trees = saved(
        src.select("id", "v", F.pmod(by, F.lit(shards)).cast("int").alias("shard")).groupBy("shard").applyInArrow(build, "shard int, leaves int, vectors binary, ids binary, cuts binary, low binary, high binary"),
        "trees",
    )
    asked = src.where("asks")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def pack(table: pa.Table) -> pa.Table:
        v = _matrix(table["v"], dim).astype(kind)
        return pa.table([pa.array([table["qblock"][0].as_py()], pa.int32()), pa.array([v.tobytes()], pa.binary()), pa.array([np.asarray(table["id"], np.int64).tobytes()], pa.binary()), pa.array([None], pa.binary())], names=["qblock", "queries", "own", "floor"])

    queries = saved(asked.select("id", "v", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("qblock")).groupBy("qblock").applyInArrow(pack, "qblock int, queries binary, own binary, floor binary"), "queries")
    shape = "qblock int, place int, query_id long, vec_id long, score long"

    def look(batches):
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["vectors"], kind).reshape(-1, dim)
                q = np.frombuffer(row["queries"], kind).reshape(-1, dim)
                low, high = (np.frombuffer(row[c], kind).reshape(-1, dim) for c in ("low", "high"))
                own = np.frombuffer(row["own"], np.int64)
                floor = np.frombuffer(row["floor"], np.float64) if row["floor"] else np.full(len(q), -np.inf)
                found = list(search(v, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["cuts"], np.int64), low, high, q, own, floor, k))
                n = [len(s) for s, _ in found]
                place = np.repeat(np.arange(len(q)), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), row["qblock"]), pa.int32()), pa.array(place, pa.int32()), pa.array(own[place], pa.int64()), pa.array(np.concatenate([np.zeros(0, np.int64), *[i for _, i in found]]), pa.int64()), pa.array(np.concatenate([np.zeros(0, kind), *[s for s, _ in found]]).astype(np.int64), pa.int64())],
                    ["qblock", "place", "query_id", "vec_id", "score"],
                )

    # every block of queries with the shard of its own number, then with all the others
    first_shard = F.pmod(F.col("qblock"), F.lit(shards))
    first = saved(queries.withColumn("shard", first_shard).join(trees, "shard").repartition(blocks, "qblock").mapInArrow(look, shape), "first")
    kth = first.groupBy("qblock", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).where(F.col("n") >= k)
    levels = queries.select("qblock", F.length("own").alias("bytes")).join(kth, "qblock", "left").groupBy("qblock").agg(F.first("bytes").alias("bytes"), F.collect_list(F.struct("place", "low")).alias("lows"))  # at most QUERY_ROWS each

    def floors(batches):
        for batch in batches:
            out = []
            for size, lows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                f = np.full(size // 8, -np.inf)
                for x in lows:
                    if x["place"] is not None:
                        f[x["place"]] = x["low"]
                out.append(f.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["qblock", "floor"])

    carried = queries.drop("floor").join(levels.mapInArrow(floors, "qblock int, floor binary"), "qblock")
    others = carried.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != first_shard)
    rest = others.join(trees, "shard").repartition(max(1, min(blocks * shards, 4096)), "shard", "qblock").mapInArrow(look, shape)
    everything = first.unionByName(rest)
    ranked = everything.withColumn("rank", F.row_number().over(W.partitionBy("qblock", "place").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op2_topk_search(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``embeddings``: query_id, rank, vec_id, score of the 20 best for each vec_id divisible by 20."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20)


OP2_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
           where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
      from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""
