"""Operator 8: harmonic packing of tokenised documents into fixed sequences.

A document of n ids, at most ``capacity``, belongs to class k = capacity // n, and a
sequence of class k holds exactly k documents; so a document's sequence follows from its
rank in its class alone, and workers need to agree on nothing but the number of documents
each of them has per class.  The fewer than k documents left in each class (together a
bounded number, whatever the input) are packed first-fit decreasing.

What these sequences leave free, where it is ``least`` ids or more, is filled by documents
that are cut for it: all that are longer than ``capacity``, and, if these do not suffice,
a share of the shorter ones by a hash.  Free places and fillers each lie end to end on a
line, and a piece is where a place and a filler overlap; fillers beyond the last place are
cut at whole sequences.  No other document is cut.

Defined cases: a null or empty text is the closing id alone; repeated rows are packed
each, and each has a number of its own, so that copies spread like other rows; ids are those
of the tokenizer on the whole text, nothing is truncated; documents of one class are ranked
by that number; a text of any length is cut, never truncated; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm import exchange as X
from docketflow.llm import kernels as K
from docketflow.llm.components import saved

CAPACITY, CLOSING_ID, LEAST = 2048, 1, 64
#: Ids in a row of a long document; classes up to this one may be cut to fill; how much more is cut than is free; bins in a range.
PART, FILLERS, MORE, RANGE = 131_072, 8, 1.05, 65_536
CACHE_UNITS = 2_000_000
SEED = 71


def unit_bounds(part: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words split further between ASCII letters or digits and ASCII punctuation but the apostrophe.

    The tokenizer's own pre-tokenisation never joins across such a border, so the ids of
    a text are the ids of its units in turn.
    """
    kind = np.zeros(256, np.int8)
    kind[0x21:0x7F] = 2
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
        kind[a:b] = 1
    kind[0x27] = 0
    k = kind[part]
    border = k[1:] * k[:-1] == 2
    begin, end = np.zeros(len(part) + 1, bool), np.zeros(len(part) + 1, bool)
    begin[lo], end[hi] = True, True
    begin[1:-1] |= border
    end[1:-1] |= border
    return np.flatnonzero(begin), np.flatnonzero(end)


class UnitIds:
    """Token ids of units, each distinct unit encoded once; lives as long as the Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pairs = K.pair_table(SEED)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = self.n = np.zeros(0, np.int64)
        self.pool = np.array([CLOSING_ID], np.uint32)
        self.bytes, self.from_, self.size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, keys: np.ndarray, units: list[str]) -> None:
        """Adds units (their keys sorted and new)."""
        at, n, got = [], [], []
        for a in range(0, len(units), 20_000):
            some = units[a : a + 20_000]
            enc = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.cumsum([0, *[len(u) + 1 for u in some]])
            owner = np.searchsorted(starts, np.array([o[0] for o in enc.offsets], np.int64), "right") - 1
            count = np.bincount(owner, minlength=len(some)) if len(owner) else np.zeros(len(some), np.int64)
            n.append(count)
            got.append(np.array(enc.ids, np.uint32))
        n = np.concatenate(n)
        at = len(self.pool) + np.concatenate([[0], np.cumsum(n)[:-1]])
        self.pool = np.concatenate([self.pool, *got])
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = np.insert(self.keys, place, keys), np.insert(self.at, place, at), np.insert(self.n, place, n)
        written = [u.encode() for u in units]
        size = np.array([len(w) for w in written], np.int64)
        self.from_, self.size = np.insert(self.from_, place, len(self.bytes) + np.cumsum(size) - size), np.insert(self.size, place, size)
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(written), np.uint8)])

    def plain(self, raw: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """What ``ids`` returns, by the tokenizer on each whole text."""
        rows = [[*self.tokenizer.encode(raw[a:b].tobytes().decode(), add_special_tokens=False).ids, CLOSING_ID] for a, b in zip(starts[lo:hi], starts[lo + 1 : hi + 1], strict=True)]
        return np.concatenate([np.array(r, np.uint32) for r in rows]), np.cumsum([0, *[len(r) for r in rows]])

    def ids(self, raw: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows lo..hi with the closing id after each, and where each row starts (one more at the end)."""
        part, word_lo, word_hi, _ = K.words_of(raw, starts, lo, hi)
        edges = (starts[lo : hi + 1] - starts[lo]).astype(np.int64)
        body = part.tobytes()
        if b"<|" not in body:  # a special token counts only as it is written
            body = body.lower()
            part = np.frombuffer(body, np.uint8)
            word_lo, word_hi = unit_bounds(part, word_lo, word_hi)
        keys = K.word_hashes(part, word_lo, word_hi, self.pairs, SEED)
        u, first, inv = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(u) > CACHE_UNITS:
            self.clear()
        place = np.minimum(np.searchsorted(self.keys, u), max(0, len(self.keys) - 1))
        new = self.keys[place] != u if len(self.keys) else np.ones(len(u), bool)
        if new.any():
            self.learn(u[new], [body[word_lo[k] : word_hi[k]].decode() for k in first[new]])
        place = np.searchsorted(self.keys, u)
        # a hash only proposes: every unit must be the one that was encoded, byte for byte
        size, known = word_hi - word_lo, place[inv]
        if not (np.array_equal(size, self.size[known]) and K.same_spans(part, word_lo, self.bytes, self.from_[known], size)):
            return self.plain(raw, starts, lo, hi)
        rows = np.searchsorted(word_lo, edges)
        at = np.insert(self.at[place][inv], rows[1:], 0)
        n = np.insert(self.n[place][inv], rows[1:], 1)
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.pool[np.repeat(at - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[rows + np.arange(len(rows))]


def unit_ids(path: str) -> UnitIds:
    state = sys.modules.setdefault("_worker_unit_ids", types.ModuleType("_worker_unit_ids"))
    if getattr(state, "path", None) != path:
        state.path, state.units = path, UnitIds(path)
    return state.units


def parts(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, keep_ids: bool) -> DataFrame:
    """One row per document, or per ``PART`` ids of a longer one: id, start, length, ids_crc32, doc_tokens, ids (null if they are not needed again)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def encode(batches):
        units = unit_ids(tokenizer)
        for batch in batches:
            raw, starts = K.text_buffers(batch.column(1))
            for lo, hi in K.row_slices(starts, 1 << 20):
                ids, at = units.ids(raw, starts, lo, hi)
                flat = memoryview(ids.astype("<u4").tobytes())
                row, found, kept = [], [], []
                for r in range(hi - lo):
                    n = int(at[r + 1] - at[r])
                    for start in range(0, n, PART):
                        size = min(PART, n - start)
                        some = flat[4 * (int(at[r]) + start) :][: 4 * size]
                        row.append(lo + r)
                        found.append((start, size, zlib.crc32(some), n))
                        kept.append(some.tobytes() if keep_ids or capacity // size <= FILLERS else None)
                cols = [batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(c, pa.int64()) for c in zip(*found, strict=True)]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(kept, pa.binary())], ["id", *names, "ids"])

    return src.mapInArrow(encode, X.shape(src, ["id"], ", ".join(f"{n} long" for n in names) + ", ids binary"))


def _first_fit(capacity: int):
    def fit(left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", "uid"], ascending=[False, True])
        room, bins = [], []
        for size in left["length"]:
            b = next((x for x, free in enumerate(room) if free >= size), len(room))
            if b == len(room):
                room.append(capacity)
            room[b] -= size
            bins.append(b)
        return left.assign(bin=bins, rank=range(len(left)))

    return fit


def share_cut(classes: list, capacity: int) -> float:
    """Share of the documents of classes 1 to FILLERS that is cut, from (k, rows, ids) per class, k = 0 for longer ones."""
    free = {k: max(0.0, rows * capacity / k - ids) for k, rows, ids in classes if k}
    missing = sum(free.values()) - sum(ids for k, _, ids in classes if not k)
    gain = sum(ids + free[k] for k, _, ids in classes if 0 < k <= FILLERS)
    return min(1.0, MORE * missing / gain) if missing > 0 and gain else 0.0


def whole_bins(items: DataFrame, rows: int, capacity: int) -> DataFrame:
    """Items with sequence_id and offset: k to a sequence of class k, the rest first-fit decreasing."""
    dealt = items.withColumn("worker", F.pmod(F.xxhash64("uid"), F.lit(max(1, rows // 50_000))).cast("int"))
    counts = dealt.groupBy("k", "worker").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("k").orderBy("worker").rowsBetween(W.unboundedPreceding, -1)
    # at most 2 * sqrt(capacity) classes, one row each
    full = counts.groupBy("k").agg(F.floor(F.sum("n") / F.col("k")).alias("bins"))
    bases = full.withColumn("base", F.coalesce(F.sum("bins").over(W.orderBy("k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = counts.select("k", "worker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).join(F.broadcast(bases), "k")
    own = W.partitionBy("k", "worker").orderBy("uid")
    ranked = dealt.withColumn("rank", F.row_number().over(own) - 1).join(before, ["k", "worker"]).withColumn("rank", F.col("rank") + F.col("before"))
    whole = F.col("rank") < F.col("bins") * F.col("k")
    cols = [c for c in items.columns if c != "k"]
    placed = ranked.where(whole).select(*cols, (F.col("base") + F.floor(F.col("rank") / F.col("k"))).alias("sequence_id"), "rank")
    # fewer than k documents of each class: at most capacity * (ln(capacity) + 1) in all
    rest = ranked.where(~whole).select("uid", "length", F.lit(0).alias("one"))
    fitted = rest.groupBy("one").applyInPandas(_first_fit(capacity), "uid long, length long, one int, bin long, rank long")
    base = full.agg(F.sum("bins")).first()[0] or 0
    last = items.select(cols).join(fitted.select("uid", (F.lit(base) + F.col("bin")).alias("sequence_id"), "rank"), "uid")
    within = W.partitionBy("sequence_id").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    return placed.unionByName(last).withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0))).drop("rank")


def on_a_line(rows: DataFrame, chunk, order: str, size: str) -> DataFrame:
    """Rows with ``at``, the sum of ``size`` before them: within their chunk, and over the chunks before it."""
    some = rows.withColumn("chunk", chunk)
    sums = some.groupBy("chunk").agg(F.sum(size).alias("sum"))
    bases = sums.select("chunk", F.coalesce(F.sum("sum").over(W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = W.partitionBy("chunk").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    at = F.coalesce(F.sum(size).over(within), F.lit(0))
    return some.withColumn("at", at).join(bases, "chunk").withColumn("at", F.col("at") + F.col("base")).drop("chunk", "base")


def filled(places: DataFrame, fillers: DataFrame, capacity: int) -> DataFrame:
    """Where free places and fillers overlap on their lines: uid and its pieces (first id, length, sequence_id, offset)."""
    step = 2 * capacity  # both sides have few rows in a stretch of the line: places of LEAST ids or more, fillers of over capacity / (FILLERS + 1)

    def stretches(rows: DataFrame, size: str) -> DataFrame:
        first, last = F.floor(F.col("at") / step), F.floor((F.col("at") + F.col(size) - 1) / step)
        return rows.withColumn("stretch", F.explode(F.sequence(first, last)))

    a = stretches(places, "free").withColumnRenamed("at", "a")
    b = stretches(fillers, "length").withColumnRenamed("at", "b")
    lo, hi = F.greatest("a", "b"), F.least(F.col("a") + F.col("free"), F.col("b") + F.col("length"))
    both = a.join(b, "stretch").where((lo < hi) & (F.floor(lo / step) == F.col("stretch")))
    piece = F.struct((lo - F.col("b")).alias("first"), (hi - lo).alias("size"), "sequence_id", (F.col("taken") + lo - F.col("a")).alias("offset"))
    return both.groupBy("uid").agg(F.collect_list(piece).alias("cut"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]; sequences are numbered without gaps."""
    k = F.floor(F.lit(capacity) / F.col("length"))
    found = saved(parts(docs, id_col, text_col, tokenizer, capacity, keep_ids).withColumn("uid", F.monotonically_increasing_id()).withColumn("k", k), "parts")
    classes = found.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.sum("length").alias("ids")).collect()
    share = share_cut(classes, capacity)
    filler = (F.col("k") == 0) | (F.col("k") <= FILLERS) & (F.pmod(F.xxhash64("uid", F.lit(SEED)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    kept = [c for c in found.columns if keep_ids or c != "ids"]
    placed = saved(whole_bins(found.where(~filler).select(kept), sum(c.rows for c in classes), capacity), "whole")

    used = placed.groupBy("sequence_id").agg(F.sum("length").alias("taken")).withColumn("free", F.lit(capacity) - F.col("taken")).where(F.col("free") >= LEAST)
    places = on_a_line(used, F.floor(F.col("sequence_id") / RANGE), "sequence_id", "free")
    fillers = on_a_line(found.where(filler).select("uid", "length"), F.shiftright("uid", 33), "uid", "length")
    bins = placed.agg(F.max("sequence_id")).first()[0]
    bins = 0 if bins is None else bins + 1
    free, need = used.agg(F.sum("free")).first()[0] or 0, found.where(filler).agg(F.sum("length")).first()[0] or 0
    new = F.col("id").cast("long")
    beyond = docs.sparkSession.range(max(0, -(-(need - free) // capacity))).select((new + bins).alias("sequence_id"), F.lit(0).cast("long").alias("taken"), F.lit(capacity).cast("long").alias("free"), (new * capacity + free).alias("at"))
    plan = filled(places.select("sequence_id", "taken", "free", "at").unionByName(beyond), fillers, capacity)

    names = ["length", "ids_crc32", "sequence_id", "offset"]
    own = found.where(filler).select("uid", "id", F.col("start").alias("from"), "doc_tokens", "ids").join(plan, "uid")
    some = lambda c: F.substring(F.col("ids"), F.lit(1) + (c["first"] * 4).cast("int"), (c["size"] * 4).cast("int"))
    fields = lambda c: [(c["first"]).alias("first"), c["size"].alias("length"), F.crc32(some(c)).alias("ids_crc32"), c["sequence_id"].alias("sequence_id"), c["offset"].alias("offset"), *([some(c).alias("ids")] if keep_ids else [])]
    cut = own.select("id", "from", "doc_tokens", F.explode(F.transform("cut", lambda c: F.struct(*fields(c)))).alias("p"))
    cut = cut.select("id", (F.col("from") + F.col("p.first")).alias("start"), "doc_tokens", *[f"p.{n}" for n in names], *(["p.ids"] if keep_ids else []))
    out = placed.drop("uid").unionByName(cut).select("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else []))
    return _as_lists(out) if keep_ids else out


def _as_lists(found: DataFrame) -> DataFrame:
    """The ids as arrays of integers."""
    names = found.columns

    def run(batches):
        for batch in batches:
            lists = [np.frombuffer(b.as_py(), "<u4").astype(np.int32) for b in batch.column(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lists, pa.list_(pa.int32()))], names)

    return found.mapInArrow(run, X.shape(found, names[:-1], "ids array<int>"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    found = pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), default_tokenizer())
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
