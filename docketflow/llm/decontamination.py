"""Operator 10: benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared lower-cased with white space runs as one space.  An item of m
characters with an edit budget of e shares at least m - q + 1 - q * e of its q-grams with
any region that holds it within the budget, all of them on diagonals at most e apart.
Shared q-grams are counted per document, item and diagonal band (bands overlap by half,
so one of them holds the whole run); bands that reach the bound are aligned in the band.

The budget is a tenth of the item's characters, fewer where less than q q-grams would be
left to count.  A part of an item, or an item with words replaced, leaks too: a band whose shared q-grams
cover at least ``PART`` of the item's characters, and ``PART_CHARS`` of them, is aligned
as well, and reported if no more characters than the rest are edited (``whole`` is false).
Bands are wide enough for a word of ``WORD`` characters more or less.

The benchmark is read in parts of bounded size, each part against all documents; the
documents are not shuffled.

Defined cases: null or empty texts and items match nothing; items shorter than q are
looked for as they are; an item that occurs several times in a document is reported at
its best place; repeated rows and items are each reported; a document of any length is
searched whole; an empty table gives an empty result, an empty benchmark no leaks; all
other columns, whatever their names, are carried in ``carried``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm import exchange as X
from docketflow.llm import kernels as K

Q, BUDGET = 8, 0.1
PART, PART_CHARS, WORD = 0.6, 48, 16
PART_BYTES = 16 << 20
TABLE_BITS = 22


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters at each place, by doubling."""
    c, width, base = chars.astype(np.uint64) + np.uint64(1), 1, K.BASE
    done, out = 0, None
    while True:
        if q & width:
            if out is None:
                out, done = c.copy(), width
            else:
                n = max(0, len(out) - width)
                out = out[:n] * np.uint64(pow(base, width, 2**64)) + c[done : done + n] if n else out[:0]
                done += width
        if done == q:
            return K.mix(out[: max(0, len(chars) - q + 1)])
        n = max(0, len(c) - width)
        c = c[:n] * np.uint64(pow(base, width, 2**64)) + c[width : width + n]
        width *= 2


class Items:
    """q-gram index of one part of the benchmark."""

    def __init__(self, rows: list[tuple], q: int, budget: float):
        self.q, self.ids = q, [r[0] for r in rows]
        texts = [normal(r[1]) for r in rows]
        self.texts, self.chars = texts, [points(t) for t in texts]
        m = np.array([len(c) for c in self.chars], np.int64)
        self.edits = np.maximum(0, np.minimum((budget * m).astype(np.int64), (m - 2 * q + 1) // q))
        self.bound = m - q + 1 - q * self.edits
        self.part = np.maximum(np.ceil(PART * m).astype(np.int64), PART_CHARS)  # out of reach for shorter items
        self.reach = np.where(m >= PART_CHARS, np.maximum(self.edits, WORD), self.edits)
        self.short = [k for k, n in enumerate(m) if 0 < n < q]
        grams = [qgrams(c, q) if len(c) >= q else np.zeros(0, np.uint64) for c in self.chars]
        item = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
        key = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place = key[order], item[order], place[order]
        self.seen = np.zeros(1 << TABLE_BITS, bool)
        self.seen[(key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every (place in the text, item, place in the item) with a common q-gram."""
        at = np.flatnonzero(self.seen[(grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(self.key, grams[at], "left"), np.searchsorted(self.key, grams[at], "right")
        n = hi - lo
        which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.item[which], self.place[which]


def banded(item: np.ndarray, text: np.ndarray, first: int, last: int) -> tuple[int, int, int]:
    """Fewest edits of the whole item against any stretch of the text on diagonals first..last: edits, start, end."""
    shown = text if len(text) else np.zeros(1, np.uint32)
    width = last - first + 1
    far = len(item) + len(text) + 1
    diag = np.arange(first, last + 1)
    cost = np.where((diag >= 0) & (diag <= len(text)), 0, far)
    start = diag.copy()
    steps = np.arange(width)
    for i in range(1, len(item) + 1):
        j = i + diag
        inside = (j >= 1) & (j <= len(text))
        same = cost + np.where(inside, shown[np.clip(j - 1, 0, len(shown) - 1)] != item[i - 1], far)
        drop = np.append(cost[1:] + 1, far)
        drop = np.where((j >= 0) & (j <= len(text)), drop, far)
        best, new = np.where(same <= drop, same, drop), np.where(same <= drop, start, np.append(start[1:], 0))
        run = np.minimum.accumulate(best - steps)
        from_ = np.maximum.accumulate(np.where(best - steps == run, steps, 0))
        cost = np.where(inside, np.minimum(best, run + steps), best)
        start = np.where(cost == best, new, new[from_])
    k = int(np.argmin(cost))
    return int(cost[k]), int(start[k]), int(diag[k] + len(item))


def regions(items: Items, texts: list[str]) -> list[list[tuple]]:
    """For each text: (item number, start, end, edits, whole) of the items it holds, whole or in part."""
    parts = [points(t) for t in texts]
    gap = np.zeros(items.q, np.uint32)
    chars = np.concatenate([x for p in parts for x in (p, gap)] or [gap])
    starts = np.cumsum([0, *[len(p) + items.q for p in parts]])
    found: list[dict] = [{} for _ in texts]
    at, item, place = items.hits(qgrams(chars, items.q)) if len(chars) >= items.q and len(items.key) else (np.zeros(0, np.int64),) * 3
    row = np.searchsorted(starts, at, "right") - 1
    at = at - starts[row]
    if len(at):
        diag, wide = at - place, items.reach[item] + 1
        band = diag // wide
        row, item, at, place, diag = (np.concatenate([x, x]) for x in (row, item, at, place, diag))
        band = np.concatenate([band, band - 1])  # a band holds its own stripe and the next
        order = np.lexsort((place, band, item, row))
        row, item, band, place = row[order], item[order], band[order], place[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
        first = np.flatnonzero(new)
        fresh = new | np.concatenate([[True], place[1:] != place[:-1]])  # an item's q-gram counts once in a band
        n = np.add.reduceat(fresh.astype(np.int64), first)
        one = np.flatnonzero(fresh)  # characters that they cover
        ends = np.append(new[one[1:]], True)
        cover = np.where(ends, items.q, np.minimum(items.q, np.append(place[one][1:], 0) - place[one]))
        covered = np.add.reduceat(cover, np.flatnonzero(new[one]))
        full, part = n >= items.bound[item[first]], covered >= items.part[item[first]]
        for b, in_part in zip(first[full | part], part[full | part], strict=True):
            r, i = int(row[b]), int(item[b])
            e, reach = int(items.edits[i]), int(items.reach[i])
            if found[r].get(i, (0, 0, 1))[2] == 0:
                continue
            lo = int(band[b]) * (reach + 1)
            edits, start, end = banded(items.chars[i], parts[r], lo - e, lo + 2 * reach + 1 + e)
            most = max(e, len(items.chars[i]) - int(items.part[i])) if in_part else e
            if edits <= most and edits < found[r].get(i, (0, 0, most + 1))[2]:
                found[r][i] = (start, end, edits, edits <= e)
    for i in items.short:
        for r, text in enumerate(texts):
            if (k := text.find(items.texts[i])) >= 0:
                found[r][i] = (k, k + len(items.texts[i]), 0, True)
    return [[(i, *x) for i, x in sorted(f.items())] for f in found]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", q: int = Q, budget: float = BUDGET) -> DataFrame:
    """Every document as id, text, carried (its other columns) and leaks: item_id, start, end, edits, whole.

    start and end are character positions in the normalised text.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*rest or [F.lit(None).alias("none")]).alias("carried"))
    bench = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text")).where(F.length("text") > 0)
    leak = f"array<struct<item_id:{bench.schema['item_id'].dataType.simpleString()},start:long,end:long,edits:long,whole:boolean>>"
    out = out.withColumn("leaks", F.array().cast(leak))
    shape, carried = X.shape(out, out.columns), X.arrow(out, "carried")
    parts = max(1, -(-(bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    leak_arrow = X.arrow(out, "leaks")
    for part in range(parts):  # each of bounded size, whatever the benchmark's
        some = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        shared = docs.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in sorted(some, key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1]))])

        def search(batches, shared=shared):
            items = Items(shared.value, q, budget)
            for batch in batches:
                _, starts = K.text_buffers(batch.column(1))
                for lo, hi in K.row_slices(starts, 1 << 20):
                    some = batch.slice(lo, hi - lo)
                    texts = [normal(t) for t in some.column(1).to_pylist()]
                    before = some.column(3).to_pylist()
                    leaks = [(b or []) + [{"item_id": items.ids[i], "start": s, "end": e, "edits": n, "whole": w} for i, s, e, n, w in f] for b, f in zip(before, regions(items, texts), strict=True)]
                    yield pa.RecordBatch.from_arrays([*some.columns[:2], X.same_rows(some.column(2), carried), pa.array(leaks, leak_arrow)], ["id", "text", "carried", "leaks"])

        out = out.mapInArrow(search, shape)
    return out


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents`` and ``benchmark``: doc_id, item_id, region_start, region_end, edits, whole for every item that a document holds, whole or in part."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = find_leaks(docs.select("doc_id", "text"), bench.select("item_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", F.col("leak.start").alias("region_start"), F.col("leak.end").alias("region_end"), "leak.edits", "leak.whole")
