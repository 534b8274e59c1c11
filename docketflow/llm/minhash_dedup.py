"""Operator 9: near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's elements are its word shingles, the j-th occurrence of a shingle being an
element of its own (so a shingle's term frequency counts, and generalised Jaccard
becomes weighted set Jaccard).  An element weighs idf = 1 + ln(N / df) / ln(N): N texts
in all, df of them with the element, exact copies included in both.

1. Exact copies meet by a 128-bit digest; one of each set goes on, with its count.
2. Document frequencies of all elements are counted in packed form (``exchange``).
3. Improved consistent weighted sampling draws ``rows * bands`` samples a text; a band
   is ``rows`` of them.  Texts that share a band, and agree in at least two fifths of all
   samples, are candidates.  Frequent elements weigh 1 and unique ones 2, so that a pair
   at a plain similarity of 0.8 may have a weighted one of only 2/3; there the bands miss
   1.5 in 10,000, and a lower agreement has a chance of about 1e-6.  Buckets are compared
   in blocks of bounded size.
4. Inside each connected set of candidates all pairs are compared exactly, in blocks:
   a link is a weighted Jaccard similarity of ``threshold`` or more, or a plain one
   (the weights of common elements are low; they must not hide a near copy).  A block
   returns a spanning set of its links, not its pairs.
5. Classes are the connected components of the links.

Defined cases: a null text is a class of its own; equal texts (also empty ones) are one
class; a text with fewer words than a shingle has one element, all its words; a text
without words has none and is linked by equality only; repeated rows are members of
the same class; classes without an id, or with one that another class has, are told
apart by their component.  Nothing is capped: texts are compared whole, large buckets and
classes are split into blocks; an empty table gives an empty result; other columns are
not looked at (``one_of_each`` carries them in ``carried``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm import exchange as X
from docketflow.llm import kernels as K
from docketflow.llm.components import components, linked, saved

SEED = 59
DF_BITS = 48  # a collision only moves one weight a little
TABLE_BITS = 12
BUCKET_BLOCK, CLASS_BLOCK, BATCH_ROWS = 512, 192, 8000
AGREE = 0.4
COLUMNS = 8192


def draws(samples: int, seed: int = 11) -> tuple[np.ndarray, ...]:
    """1/r, r, beta and ln(c) of the sampling, r and c from Gamma(2, 1), beta uniform; one row per hash class of elements.

    Elements of a class differ by a uniform shift of beta of their own.
    """
    rng = np.random.default_rng(seed)
    shape = (1 << TABLE_BITS, samples)
    r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
    return 1 / r, r, rng.random(shape, np.float32), np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)


def elements(text, width: int):
    """For each slice of rows: lo, hi, and sorted by row: each element's row and 64-bit key."""
    raw, starts = K.text_buffers(text)
    pairs, words = K.pair_table(SEED), K.Powers(K.BASE_2)
    for lo, hi in K.row_slices(starts):
        part, word_lo, word_hi, rows = K.words_of(raw, starts, lo, hi)
        hashes = K.word_hashes(part, word_lo, word_hi, pairs, SEED)
        at = K.windows(rows, width, len(hashes))
        n = np.diff(rows)
        short = np.flatnonzero((n > 0) & (n < width))
        first = np.concatenate([at, rows[short]])
        keys = K.spans_hash(hashes, first, np.concatenate([at + width, rows[short + 1]]), words)
        row = np.searchsorted(rows, first, "right") - 1
        order = np.lexsort((keys, row))
        row, keys = row[order], keys[order]
        if len(keys):
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])
            nth = np.arange(len(keys)) - np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
            keys = np.where(nth > 0, K.mix(keys + nth.astype(np.uint64), 5), keys)
        yield lo, hi, row + lo, keys


def summed(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, count = keys[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(count, first) if len(first) else count


def totals(keys: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many texts have each key."""
    u, inv = np.unique(keys, return_inverse=True)
    return np.bincount(inv, weights=count, minlength=len(u)).astype(np.uint64)[inv]


def first_copies(table: pa.Table, side: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows that stand for all copies of their text, and how many copies each stands for."""
    reps = side.filter(pa.array([s == 0 for s in side["step"].to_pylist()], pa.bool_()))
    wanted = {k: (i, n) for k, i, n in zip(reps["body"].to_pylist(), reps["rid"].to_pylist(), reps["num"].to_pylist(), strict=True)}
    keep, counts = [], []
    for k, (node, i) in enumerate(zip(table["node"].to_pylist(), table["id"].to_pylist(), strict=True)):
        if node in wanted and wanted[node][0] == i:
            keep.append(k)
            counts.append(wanted.pop(node)[1])
    return table.take(pa.array(keep, pa.int64())), np.array(counts, np.int64)


def sample(row: np.ndarray, keys: np.ndarray, weight: np.ndarray, n_rows: int, table) -> np.ndarray:
    """Consistent weighted samples of each row as 32-bit codes (rows without elements: zeros)."""
    inv_r, r, beta, log_c = table
    out = np.zeros((n_rows, r.shape[1]), np.uint32)
    if not len(keys):
        return out
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    edges = np.append(first, len(keys))
    pos, end = 0, len(first)
    while pos < end:  # whole rows, about 2**13 elements at once
        to = max(pos + 1, int(np.searchsorted(edges, edges[pos] + (1 << 13), "right")) - 1)
        a, b = edges[pos], edges[to]
        spot = K.mix(keys[a:b], 9)
        which = (spot >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        shift = (spot.astype(np.uint32) >> np.uint32(8)).astype(np.float32) / np.float32(1 << 24)
        log_w = np.log(weight[a:b]).astype(np.float32)
        x = inv_r[which]
        x *= log_w[:, None]
        x += beta[which]
        x += shift[:, None]
        x -= np.floor(x)  # ln y = ln w - r * x, ln a = ln c - ln y - r
        x -= 1
        x *= r[which]
        x += log_c[which]
        x -= log_w[:, None]
        low = np.empty((to - pos, r.shape[1]), np.int64)
        for k in range(pos, to):
            c, d = edges[k] - a, edges[k + 1] - a
            low[k - pos] = x[c:d].argmin(0) + c  # equal draws have equal elements, or go to the first in the order of keys
        s = np.arange(r.shape[1])
        w = which[low]
        t = np.floor(inv_r[w, s] * log_w[low] + beta[w, s] + shift[low]).astype(np.int64)
        out[row[first[pos:to]]] = K.mix(keys[a:b][low] + t.astype(np.uint64) * np.uint64(K.BASE), 13) >> np.uint64(32)
        pos = to
    return out


def _by_key(table: pa.Table, names: list[str]):
    """Row numbers of each distinct key, in turn."""
    seen: dict = {}
    for k, key in enumerate(zip(*(table[n].to_pylist() for n in names), strict=True)):
        seen.setdefault(key, []).append(k)
    return seen


EDGES_ARROW = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _edges(nodes: list, found: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([nodes[x] for x, _ in found], pa.binary()), pa.array([nodes[y] for _, y in found], pa.binary())], schema=EDGES_ARROW)


def agreeing(table: pa.Table) -> pa.Table:
    """Links between texts of one bucket block that agree in enough samples."""
    nodes, sides = table["node"].to_pylist(), np.array(table["side"].to_pylist())
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(len(nodes), -1)
    need, out = AGREE * sig.shape[1], []
    for (_, lo, hi), rows in _by_key(table, ["key", "lo", "hi"]).items():
        mine = sig[rows]
        ok = np.zeros((len(rows), len(rows)), bool)
        for x in range(len(rows) - 1):
            ok[x, x + 1 :] = (mine[x] == mine[x + 1 :]).sum(1) >= need
        if lo != hi:  # pairs within one side are met in that side's own block
            ok &= sides[rows][:, None] != sides[rows][None, :]
        out += [(rows[x], rows[y]) for x, y in linked(ok | ok.T)]
    return _edges(nodes, out)


def similar(threshold: float):
    """Links between texts of one block of a candidate class, by exact similarity."""

    def check(table: pa.Table) -> pa.Table:
        nodes, sides, n_keys = table["node"].to_pylist(), np.array(table["side"].to_pylist()), table["n"].to_pylist()
        out = []
        for (_, lo, hi), rows in _by_key(table, ["key", "lo", "hi"]).items():
            keys = [X.unpack(table["keys"][k].as_py(), n_keys[k]) for k in rows]
            weights = [X.spread(table["weights"][k].as_py(), np.float32).astype(np.float64) for k in rows]
            heavy, many = np.array([w.sum() for w in weights]), np.array([len(k) for k in keys], np.float64)
            owner = np.repeat(np.arange(len(rows)), many.astype(np.int64))
            u, at, inv, n = np.unique(np.concatenate(keys), return_index=True, return_inverse=True, return_counts=True)
            common = np.flatnonzero(n > 1)
            column = np.full(len(u), -1)
            column[common] = np.arange(len(common))
            weight = np.concatenate(weights)[at[common]]
            col = column[inv]
            owner, col = owner[col >= 0], col[col >= 0]
            order = np.argsort(col, kind="stable")
            owner, col = owner[order], col[order]
            both, shared = np.zeros((len(rows), len(rows))), np.zeros((len(rows), len(rows)))
            for start in range(0, len(common), COLUMNS):
                a, b = np.searchsorted(col, [start, start + COLUMNS])
                has = np.zeros((len(rows), min(COLUMNS, len(common) - start)))
                has[owner[a:b], col[a:b] - start] = 1
                both += (has * weight[start : start + COLUMNS]) @ has.T
                shared += has @ has.T
            ok = (both >= threshold * (heavy[:, None] + heavy[None, :] - both) - 1e-9) | (shared >= threshold * (many[:, None] + many[None, :] - shared) - 1e-9)
            if lo != hi:
                ok &= sides[rows][:, None] != sides[rows][None, :]
            np.fill_diagonal(ok, False)
            out += [(rows[x], rows[y]) for x, y in linked(ok)]
        return _edges(nodes, out)

    return check


def _in_blocks(members: DataFrame, key: str, n: str, block: int, rows: int) -> DataFrame:
    """Each member once for every block pair of its key that it is in; batch gathers block pairs into tasks of bounded size."""
    sides = F.ceil(F.col(n) / block).cast("int")
    return (
        members.withColumn("sides", sides).withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
        .withColumn("batch", F.pmod(F.xxhash64(key, "lo", "hi"), F.lit(max(1, -(-rows // BATCH_ROWS)))).cast("int")).withColumnRenamed(key, "key").drop("sides", "other", n)
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 3) -> DataFrame:
    """One row per document: id, node (digest of its text), comp (the key of its class), class_id (the smallest id of its class), class_size.

    Only comp identifies a class: different classes have one class_id if their ids are null or repeated.
    A null text has neither node nor comp.
    """
    spark, samples = docs.sparkSession, bands * rows
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    groups, buckets = X.sizes(plain, "text")
    node = F.unhex(F.md5("text"))

    def deal(i, n):
        return F.pmod(F.xxhash64(i.cast("string"), n), F.lit(groups)).cast("int")

    parts = max(-(-groups // 2), int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = plain.where("text is not null").select("id", "text", node.alias("node")).select(deal(F.col("id"), F.col("node")).alias("grp"), "*").repartition(parts, "grp")
    reps = saved(plain.where("text is not null").select("id", node.alias("node")).groupBy("node").agg(F.min("id").alias("rid"), F.count(F.lit(1)).alias("num")), "reps")
    total = reps.agg(F.sum("num")).first()[0] or 0
    spare = {"bucket": F.lit(0), "comp": F.lit(None).cast("binary"), "side": F.lit(0)}
    order = ["grp", "step", "num", "body", "rid", "bucket", "comp", "side"]
    first = reps.select(deal(F.col("rid"), F.col("node")).alias("grp"), F.lit(0).alias("step"), "num", F.col("node").alias("body"), "rid", *[v.alias(k) for k, v in spare.items()]).select(order)

    def local(table: pa.Table, side: pa.Table):
        mine, copies = first_copies(table, side)
        found = list(elements(mine["text"], width))
        row = np.concatenate([np.zeros(0, np.int64), *[f[2] for f in found]])
        keys = np.concatenate([np.zeros(0, np.uint64), *[f[3] for f in found]])
        return mine, copies, row, keys

    def count(table: pa.Table, side: pa.Table) -> pa.Table:
        mine, copies, row, keys = local(table, side)
        if not len(keys):
            return X.BLOBS_ARROW.empty_table()
        known, n = summed(keys >> np.uint64(64 - DF_BITS), copies[row])
        return X.send(table["grp"][0].as_py(), known, n.astype(np.uint64), buckets, DF_BITS)

    def weighted(table: pa.Table, side: pa.Table):
        mine, _, row, keys = local(table, side)
        short = keys >> np.uint64(64 - DF_BITS)
        known, _ = summed(short, np.ones(len(short), np.int8))
        df = X.answers(side.filter(pa.array([s == 1 for s in side["step"].to_pylist()], pa.bool_())), np.uint64)
        weight = (1 + np.log(total / np.maximum(1, df.astype(np.float64))) / np.log(max(total, 2))).astype(np.float32)
        return mine, row, keys, weight[np.searchsorted(known, short)] if len(known) else np.zeros(0, np.float32)

    sig_arrow = pa.schema([("node", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def sign(table: pa.Table, side: pa.Table) -> pa.Table:
        mine, row, keys, weight = weighted(table, side)
        if not len(keys):
            return sig_arrow.empty_table()
        codes = sample(row, keys, weight, mine.num_rows, draws(samples))
        some = np.unique(row)
        codes = codes[some]
        band = np.zeros((len(some), bands), np.uint64)
        for r in range(rows):
            band = K.mix(band * np.uint64(K.BASE_2) + codes[:, r::rows].astype(np.uint64), r)
        names = mine["node"].to_pylist()
        return pa.table([pa.array([names[r] for r in some], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(band.view(np.int64).tolist(), pa.list_(pa.int64()))], schema=sig_arrow)

    blobs = base.groupBy("grp").cogroup(first.groupBy("grp")).applyInArrow(count, X.BLOBS)
    replies = saved(X.tally(blobs, totals, "u8"), "df")
    dfs = replies.select("grp", F.lit(1).alias("step"), F.lit(0).cast("long").alias("num"), "body", F.lit(None).cast(reps.schema["rid"].dataType).alias("rid"), "bucket", *[spare[c].alias(c) for c in ("comp", "side")]).select(order)
    known = first.unionByName(dfs)
    signed = saved(base.groupBy("grp").cogroup(known.groupBy("grp")).applyInArrow(sign, "node binary, sig binary, bands array<long>"), "sig")

    band_rows = signed.select("node", F.posexplode("bands").alias("band", "code")).select("node", F.xxhash64("band", "code").alias("key"))
    shared = band_rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = saved(band_rows.join(shared, "key"), "met")
    n_met = met.count()
    blocks = _in_blocks(met.join(signed.select("node", "sig"), "node"), "key", "m", BUCKET_BLOCK, n_met).select("batch", "key", "lo", "hi", "side", "node", "sig")
    candidates = components(blocks.groupBy("batch").applyInArrow(agreeing, "a binary, b binary").distinct())

    big = candidates.groupBy("comp").agg(F.count(F.lit(1)).alias("m"))
    mates = saved(candidates.join(big, "comp").join(reps, "node"), "mates")
    n_mates = mates.count()
    wanted = mates.select(deal(F.col("rid"), F.col("node")).alias("grp"), F.lit(2).alias("step"), F.col("m").alias("num"), F.col("node").alias("body"), "rid", F.lit(0).alias("bucket"), "comp", F.lit(0).alias("side")).select(order)
    vec_arrow = pa.schema([("node", pa.binary()), ("comp", pa.binary()), ("m", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])

    def vectors(table: pa.Table, side: pa.Table) -> pa.Table:
        ask = side.filter(pa.array([s == 2 for s in side["step"].to_pylist()], pa.bool_()))
        asked = {k: (c, m) for k, c, m in zip(ask["body"].to_pylist(), ask["comp"].to_pylist(), ask["num"].to_pylist(), strict=True)}
        if not asked or not table.num_rows:
            return vec_arrow.empty_table()
        mine, row, keys, weight = weighted(table, side)
        edges = np.searchsorted(row, np.arange(mine.num_rows + 1))
        out = []
        for k, name in enumerate(mine["node"].to_pylist()):
            if name in asked:
                a, b = edges[k], edges[k + 1]
                order = np.argsort(keys[a:b])
                out.append((name, *asked[name], int(b - a), X.pack(keys[a:b][order]), X.squeeze(weight[a:b][order])))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, vec_arrow.types, strict=True)], schema=vec_arrow)

    vecs = base.groupBy("grp").cogroup(known.unionByName(wanted).groupBy("grp")).applyInArrow(vectors, "node binary, comp binary, m long, n long, keys binary, weights binary")
    pairs = _in_blocks(vecs, "comp", "m", CLASS_BLOCK, 8 * n_mates).select("batch", "key", "lo", "hi", "side", "node", "n", "keys", "weights")
    links = pairs.groupBy("batch").applyInArrow(similar(threshold), "a binary, b binary")
    classes = components(links.distinct())

    label = reps.join(classes, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = label.groupBy("comp").agg(F.min("rid").alias("class_id"), F.sum("num").alias("class_size"))
    per_text = saved(label.join(sizes, "comp").select("node", "comp", "class_id", "class_size"), "classes")
    rows_out = plain.select("id", F.when(F.col("text").isNotNull(), node).alias("node")).join(per_text, "node", "left")
    alone = F.col("node").isNull()
    return rows_out.select("id", "node", "comp", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class the document with the smallest id (first copy of its text), and every null text: id, text, carried."""
    classes = near_duplicates(docs, id_col, text_col)
    kept = classes.where("node is not null and id <=> class_id").groupBy("comp").agg(F.min("class_id").alias("class_id"), F.min("node").alias("node"))
    groups, _ = X.sizes(docs, text_col)
    base = X.grouped(docs, id_col, text_col, groups, F.md5(F.col(text_col).cast("string")))
    carried = X.arrow(base, "carried")
    keep = kept.select(F.pmod(X.row_key(F.col("class_id"), F.lower(F.hex("node"))), F.lit(groups)).cast("int").alias("grp"), F.col("class_id").alias("rid"), "node")

    def pick(table: pa.Table, side: pa.Table) -> pa.Table:
        wanted = set(zip(side["rid"].to_pylist(), side["node"].to_pylist(), strict=True))
        rows = []
        for k, (i, text) in enumerate(zip(table["id"].to_pylist(), table["text"].to_pylist(), strict=True)):
            key = (i, hashlib.md5(text.encode()).digest() if text is not None else None)
            if text is None or key in wanted:
                wanted.discard(key)
                rows.append(k)
        some = table.select(["id", "text", "carried"]).take(pa.array(rows, pa.int64()))
        return some.set_column(2, "carried", X.same_rows(some["carried"], carried))

    return base.groupBy("grp").cogroup(keep.groupBy("grp")).applyInArrow(pick, X.shape(base, ["id", "text", "carried"]))


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table with a column nth: 0, 1, 2, ... over all rows."""
    own = F.monotonically_increasing_id()
    table = saved(df.select("*", F.shiftright(own, 33).alias("part"), own.bitwiseAND((1 << 33) - 1).alias("nth")), label)
    counts = sorted((r.part, r.n) for r in table.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # a row per task
    before = np.cumsum([0, *[n for _, n in counts]]).tolist()
    starts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "part long, start long")
    return table.join(F.broadcast(starts), "part").withColumn("nth", F.col("start") + F.col("nth")).drop("part", "start")


def distinct_ids(found: DataFrame) -> DataFrame:
    """id, class_id, class_size of ``near_duplicates`` with a class_id for each class, and each null text, of its own.

    Of the classes with one smallest id the first keeps it.  The others, and those whose
    ids are all null, get numbers that no document has: below the smallest id, or above
    the largest if there is no room.
    """
    rows = saved(found.select("id", F.coalesce(F.hex("comp"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))).alias("key"), "class_id", "class_size"), "rows")
    classes = rows.groupBy("key").agg(F.min("class_id").alias("class_id"))
    first = classes.where("class_id is not null").groupBy("class_id").agg(F.min("key").alias("key"))
    others = numbered(classes.join(first, "key", "left_anti").select("key"), "unnamed")
    n = others.count()
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    low, high = min(0, 0 if low is None else low), max(0, 0 if high is None else high)
    if low - n >= -(2**63):
        number = F.lit(low - 1) - F.col("nth") if n else F.lit(0).cast("long")
    elif high + n < 2**63:
        number = F.lit(high + 1) + F.col("nth")
    else:
        raise ValueError(f"no room for {n} class ids below {low} or above {high}")
    return rows.join(others.select("key", number.cast("long").alias("number")), "key", "left").select("id", F.coalesce("number", "class_id").alias("class_id"), "class_size")


def op9_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents``: doc_id, class_id, class_size."""
    found = distinct_ids(near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size")
