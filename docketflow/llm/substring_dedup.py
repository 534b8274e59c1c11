"""Operator 1: exact substring dedup over fixed-block anchors.

A repeat of at least ``window`` words contains one whole block of ``(window + 1) // 2``
words aligned to either copy's own grid.  So

1. every document's non-overlapping blocks are the index, and the rolling windows of
   block length at every word are the probes; hashes of both meet in key ranges
   (``exchange``) and each document learns which of its blocks occur anywhere else;
2. each anchor that was hit is extended to the windows of ``window`` words around it;
   these meet again under 96 bits from two independent word hashes, which decide which
   windows repeat;
3. adjoining repeated windows are merged into the maximal repeated spans, which are cut.

All three steps work per group of documents on bounded slices.  The texts are
shuffled once: the plan reuses that exchange for every step.

Defined cases: a null or empty text has no words; fewer words than the window repeat
nothing; repeated rows are separate documents, so both copies go; a repeat inside one
document counts, overlapping or not; no cap on the length or the number of repeats;
an empty table gives an empty result; all other columns, whatever their names, are
carried in ``carried``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K

#: Seeds of the two independent word hashes: of anchors and keys, and of the check beside a key.
SEED, CHECK_SEED = 31, 47
KEY_BITS = 48  # anchors: a collision only costs an extension that step 2 refuses


def _anchors(text, block: int, make):
    """For each slice of rows: ``make(raw part, word bounds, row words, word hashes, block hash at each word)``."""
    raw, starts = K.text_buffers(text)
    pairs, words = K.pair_table(SEED), K.Powers(K.BASE_2)
    for lo, hi in K.row_slices(starts):
        part, word_lo, word_hi, row_words = K.words_of(raw, starts, lo, hi)
        hashes = K.word_hashes(part, word_lo, word_hi, pairs, SEED)
        at = K.windows(row_words, block, len(hashes))
        keys = K.spans_hash(hashes, at, at + block, words) >> np.uint64(64 - KEY_BITS)
        yield make(lo, hi, part, word_lo, word_hi, row_words, hashes, at, keys, words)


def _own_index(row_words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Position of each word within its own row."""
    return at - row_words[np.searchsorted(row_words, at, "right") - 1]


def _distinct(keys: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys; per key bit 0: any flag, bit 1: more than once."""
    order = np.argsort(keys, kind="stable")
    keys, flag = keys[order], flag[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, np.zeros(0, np.uint8)
    many = np.diff(np.append(first, len(keys))) > 1
    return keys[first], (np.maximum.reduceat(flag, first) | (many << 1)).astype(np.uint8)


def _shared(keys: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Keys that are someone's block and occur more than once."""
    u, inv, n = np.unique(keys, return_inverse=True, return_counts=True)
    bits = np.zeros(len(u), np.uint8)
    np.bitwise_or.at(bits, inv, extra)
    good = ((bits & 1) > 0) & ((n > 1) | (bits & 2 > 0))
    return good[inv].astype(np.uint8)


def _wide(hashes: np.ndarray, others: np.ndarray, at: np.ndarray, width: int, powers: K.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Key of the windows at ``at`` and a 32-bit check from the other word hash."""
    return K.spans_hash(hashes, at, at + width, powers, 1), (K.spans_hash(others, at, at + width, K.Powers(K.BASE), 2) >> np.uint64(32)).astype(np.uint32)


def _candidates(row_words, hashes, at, hit, block: int, window: int) -> np.ndarray:
    """Windows whose aligned block was hit."""
    full = np.zeros(len(hashes) + 1, bool)
    full[at[hit]] = True
    wins = K.windows(row_words, window, len(hashes))
    own = _own_index(row_words, wins)
    return wins[full[wins + (-own) % block]]


WIDE = np.dtype([("key", "<u8"), ("check", "<u4")])


def _distinct_wide(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (key, check), whether each occurs more than once, and where each input row went."""
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(new) - 1
    return k[first], c[first], np.diff(np.append(first, len(k))) > 1, place


def _repeated(keys: np.ndarray, extra: np.ndarray) -> np.ndarray:
    _, _, _, place = _distinct_wide(keys, extra["check"])
    n = np.bincount(place, weights=1 + extra["many"], minlength=1)
    return (n[place] > 1).astype(np.uint8)


EXTRA = [("check", "<u4"), ("many", "u1")]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """One row per document: id, text (cut), carried (its other columns), n_words, n_removed, kept_sha256, spans.

    ``spans`` are the maximal repeated word ranges [start, end) that were cut; ``text``
    keeps all other bytes of the text as they were.
    """
    block = (window + 1) // 2
    groups, buckets = X.sizes(docs, text_col)
    base = X.grouped(docs, id_col, text_col, groups)
    carried = X.arrow(base, "carried")

    def local(text):
        found = list(_anchors(text, block, lambda lo, hi, part, a, b, rows, h, at, keys, p: (keys, (_own_index(rows, at) % block == 0).astype(np.uint8))))
        return _distinct(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint8))

    def probe(table: pa.Table) -> pa.Table:
        keys, bits = local(table["text"])
        return X.send(table["grp"][0].as_py(), keys, bits, buckets, KEY_BITS)

    def candidates(text, first: pa.Table):
        known = local(text)[0]
        good = known[X.answers(first, np.uint8) > 0] if len(known) else known
        check = K.pair_table(CHECK_SEED)

        def make(lo, hi, part, a, b, rows, h, at, keys, p):
            place = np.minimum(np.searchsorted(good, keys), max(0, len(good) - 1))
            hit = good[place] == keys if len(good) else np.zeros(len(keys), bool)
            wins = _candidates(rows, h, at, hit, block, window)
            others = K.word_hashes(part, a, b, check, CHECK_SEED) if len(wins) else h
            return lo, hi, part, a, b, rows, wins, *_wide(h, others, wins, window, p)

        return list(_anchors(text, block, make))

    def extend(table: pa.Table, first: pa.Table) -> pa.Table:
        if not table.num_rows:
            return X.BLOBS_ARROW.empty_table()
        found = candidates(table["text"], first)
        key, check, many, _ = _distinct_wide(np.concatenate([f[7] for f in found]), np.concatenate([f[8] for f in found]))
        extra = np.zeros(len(key), EXTRA)
        extra["check"], extra["many"] = check, many
        return X.send(table["grp"][0].as_py(), key, extra, buckets, 64)

    out_arrow = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]

    def cut(table: pa.Table, both: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([table["id"], table["text"], X.same_rows(table["carried"], carried), *[pa.array([], t) for _, t in out_arrow]], names=["id", "text", "carried", *[n for n, _ in out_arrow]])
        step = np.array(both["step"].to_pylist(), np.int64)
        found = candidates(table["text"], both.filter(pa.array(step == 1)))
        _, _, _, place = _distinct_wide(np.concatenate([f[7] for f in found]), np.concatenate([f[8] for f in found]))
        twice = X.answers(both.filter(pa.array(step == 2)), np.uint8)[place] > 0 if len(place) else np.zeros(0, bool)
        texts, n_words, n_removed, digests, spans, done = [], [], [], [], [], 0
        for lo, hi, part, word_lo, word_hi, rows, wins, key, _ in found:
            steps = np.zeros(len(word_lo) + 1, np.int32)
            dup = wins[twice[done : done + len(wins)]]
            done += len(wins)
            np.add.at(steps, dup, 1)
            np.add.at(steps, dup + window, -1)
            gone = np.cumsum(steps)[:-1] > 0
            raw = part.tobytes()
            total = np.concatenate([[0], np.cumsum(gone)])
            ends = np.append(word_lo, len(raw))
            for r in range(hi - lo):
                a, b = int(rows[r]), int(rows[r + 1])
                lost = int(total[b] - total[a])
                n_words.append(b - a)
                n_removed.append(lost)
                if not lost:
                    text = table["text"][lo + r].as_py()
                    texts.append(text)
                    digests.append(hashlib.sha256(b" ".join((text or "").encode().split())).hexdigest())
                    spans.append([])
                    continue
                mask = gone[a:b]
                turn = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                cuts = turn.reshape(-1, 2)
                spans.append([{"start": int(x), "end": int(y)} for x, y in cuts])
                words = [raw[x:y] for x, y in zip(word_lo[a:b][~mask], word_hi[a:b][~mask], strict=True)]
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                row_end = int(word_hi[b - 1])
                kept, at = [], int(word_lo[a])
                for x, y in cuts:  # a span goes with the white space that follows it
                    kept.append(raw[at : int(ends[a + x])])
                    at = int(ends[a + y]) if a + y < b else row_end
                kept.append(raw[at:row_end])
                texts.append(b"".join(kept).strip(K.SPACES).decode())
        cols = [table["id"], pa.array(texts, pa.string()), X.same_rows(table["carried"], carried), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, out_arrow[3][1])]
        return pa.table(cols, names=["id", "text", "carried", *[n for n, _ in out_arrow]])

    first = X.tally(base.groupBy("grp").applyInArrow(probe, X.BLOBS), _shared, "u1")
    wide = base.groupBy("grp").cogroup(first.groupBy("grp")).applyInArrow(extend, X.BLOBS)
    second = X.tally(wide, _repeated, EXTRA)
    both = first.withColumn("step", F.lit(1)).unionByName(second.withColumn("step", F.lit(2)))
    out = X.shape(base, ["id", "text", "carried"], "n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>")
    return base.groupBy("grp").cogroup(both.groupBy("grp")).applyInArrow(cut, out)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents``: doc_id, n_words, n_removed, kept_sha256."""
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) as s from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
dup as (select s from p group by s having count(*) > 1),
cov as (select distinct doc_id, unnest(range(i, i + 35)) as i from p join dup using (s)),
k as (select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from d) anti join cov using (doc_id, i) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(k.n, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)
"""
