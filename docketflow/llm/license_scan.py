"""Operator 13: license scan by ordered signature rules.

A text is lower-cased (A-Z) and brought to its words, joined by single spaces.  The words
that are keywords of some rule pick the rules to run, so that most texts run none.  Each
match is an interval of words.  Overlaps are settled by containment: a detection goes if
its interval lies within that of a detection of a better priority, or within a longer one
of its own priority (of equal intervals and priorities the first rule stays).  Base
phrases are counted beside the rules and are never suppressed.

The scan is a map over documents: no shuffle, and time linear in the text, however often
a phrase occurs in it.

Defined cases: a null or empty text has no words, no labels, null first and last words
and the score 0; repeated rows (and null or repeated ids) each get a row of their own, in
any order; texts of any length are scanned whole; ties between rules go to the one that
stands first in the table; an empty table gives an empty result; all other columns,
whatever their names, are carried in ``carried``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .license_rules import BASE, BASE_SCORE, rules

#: Bytes of words [0-9a-z\x80-\xff] as they are, A-Z in lower case, all others a border.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,start:long,end:long>>"


class Scanner:
    """The compiled rules, grouped by keyword."""

    def __init__(self, table=None):
        self.rules = rules() if table is None else table
        # the space before is part of the pattern: a literal beginning is found fast
        self.compiled = [re.compile(b" " + (pattern if b"|" not in re.sub(rb"\([^()]*\)", b"", pattern) else b"(?:" + pattern + b")") + b"(?= )") for *_, pattern in self.rules]
        self.by_keyword: dict[bytes, list[int]] = {}
        for k, (_, _, _, keyword, _) in enumerate(self.rules):
            self.by_keyword.setdefault(keyword, []).append(k)
        self.keywords = frozenset(self.by_keyword)
        self.base = [(phrase.split()[0].encode(), label, re.compile(b" " + phrase.encode() + b"(?= )")) for phrase, label in BASE.items()]
        self.base_keywords = frozenset(first for first, _, _ in self.base)

    def matches(self, joined: bytes, which) -> list[tuple[int, int, int, int]]:
        """(start, end, priority, rule) in bytes of every match of the rules ``which``."""
        return [(m.start() + 1, m.end(), self.rules[k][1], k) for k in which for m in self.compiled[k].finditer(joined)]

    def scan(self, text: bytes) -> tuple:
        words = text.translate(TO_WORDS).split()
        hits = self.keywords.intersection(words)
        base_hits = self.base_keywords.intersection(words)
        if not hits and not base_hits:
            return len(words), 0, None, None, "", "", 0.0, []
        joined = b" " + b" ".join(words) + b" "
        places, base_labels = [], set()
        for first, label, pattern in self.base:
            if first in base_hits:
                found = [m.start() + 1 for m in pattern.finditer(joined)]
                places += found
                base_labels |= {label} if found else set()
        kept = outermost(self.matches(joined, sorted(k for word in hits for k in self.by_keyword[word])))
        borders = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)

        def word_at(byte: int) -> int:
            return int(np.searchsorted(borders, byte)) - 1

        detections = [{"label": self.rules[k][0], "start": word_at(a), "end": word_at(b) + 1} for a, b, _, k in kept]
        labels = base_labels | {d["label"] for d in detections}
        score = max([BASE_SCORE[x] for x in base_labels] + [self.rules[k][2] for *_, k in kept], default=0.0)
        first, last = (word_at(min(places)), word_at(max(places))) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, detections


def outermost(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Detections (start, end, priority, rule) that no other one suppresses, in the order of their starts."""
    kept, reach = [], {}
    for start, end, priority, rule in sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3])):
        # all intervals seen start at or before this one: whether one contains it is a matter of the ends
        if any(p <= priority and far >= end for p, far in reach.items()):
            continue
        reach[priority] = max(end, reach.get(priority, 0))
        kept.append((start, end, priority, rule))
    return kept


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text, carried (its other columns), the columns of ``COLUMNS``."""
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)] or [F.lit(None).alias("none")]).alias("carried"))
    carried = X.arrow(base, "carried")
    names = [c.strip().split(" ")[0] for c in COLUMNS.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))]

    def scan(batches):
        scanner = Scanner()
        for batch in batches:
            found = [scanner.scan((t.as_py() or "").encode()) for t in batch["text"]]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], X.same_rows(batch["carried"], carried), *columns], names=["id", "text", "carried", *names])

    return base.mapInArrow(scan, X.shape(base, ["id", "text", "carried"], COLUMNS))


def op13_license_scan(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
