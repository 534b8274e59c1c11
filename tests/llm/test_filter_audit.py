import re
from itertools import permutations

import numpy as np
import pytest
from helpers import DATA, documents, same_as_sql

import docketflow.llm.filter_audit as A


def brute(rows, labels):
    """rows: (id, text, part); every order applied document by document."""
    low = {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(i, low.get(t or "", i))
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    out = {}
    failed = []
    for i, t, p in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > low[t]}
        failed.append((i, p or "", {k for k, v in fails.items() if v}))
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [i for i, f in mine if x in f and not f & before]
                out[part, "".join(order), step] = [
                    sum(not f & (before | {x}) for _, f in mine), len(gone), sum(x in f and bool(f & before) for _, f in mine),
                    sum(f == {x} for _, f in mine), sum(i in good for i in gone), sum(i in toxic for i in gone), 0]
    for (part, order, step), v in out.items():
        v[6] = sum(u[1] for (p, o, s), u in out.items() if p == part and o[s - 1] == order[step - 1])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_query_matches_sql(spark, monkeypatch, broadcast):
    monkeypatch.setattr(A, "BROADCAST_BYTES", broadcast)
    same_as_sql(A.op12_filter_audit(spark, f"{DATA}/sf0.01"), A.OP12_SQL, f"{DATA}/sf0.01")


LONG = "Wort " * 250
TEXTS = [None, "", "", "a", "a", "a", "A#", "A#", LONG, LONG, LONG + "x", "\x0b\x1c  a", "é" * 300, " ".join(map(str, range(250))), " ".join(map(str, range(250))), "X" * 100_000]
IDS = [7, 3, None, 5, 4, 4, None, 9, 10, 11, 12, 13, 14, 16, 15, 17]
LABELS = [(4, 1, 0), (4, 0, 1), (5, 1, None), (9, None, 1), (10, 1, 0), (11, 1, 1), (16, 1, 0), (99, 1, 1), (None, 1, 1)]


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_edges(spark, monkeypatch, broadcast):
    from pyspark.sql import functions as F

    monkeypatch.setattr(A, "BROADCAST_BYTES", broadcast)
    docs = documents(spark, TEXTS, ids=IDS, mask=3, hash="clash", part="p", good=True)
    parts = ["en", None, "", "de"]
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, "en").when(F.col("doc_id") % 4 == 2, "").when(F.col("doc_id") % 4 == 3, "de"))
    rows = [(i, t, None if i is None or i % 4 == 1 else {0: "en", 2: "", 3: "de"}[i % 4]) for i, t in zip(IDS, TEXTS, strict=True)]
    assert {r[2] for r in rows} == set(parts)
    assert got(A.audit(A.flag_counts(docs, label_table(spark, LABELS)))) == brute(rows, LABELS)
    assert A.audit(A.flag_counts(docs.where("false"), label_table(spark, LABELS))).count() == 0
    assert len(got(A.audit(A.flag_counts(docs, label_table(spark, LABELS).where("false"))))) == 3 * 600


def test_sketch_clears_unique_hashes_only(spark, monkeypatch):
    """No repeat is ever cleared, few unique ones are kept, whatever the shards and tasks."""
    monkeypatch.setattr(A, "SHARD_DOCS", 4096)
    monkeypatch.setattr(A, "CELLS", 8 * 4096)
    monkeypatch.setattr(A, "TASK_HASHES", 3000)
    from pyspark.sql import functions as F

    n = 40_000
    hashes = spark.range(n, numPartitions=7).select(F.xxhash64("id").alias("hash"))
    hot = spark.range(n // 2, numPartitions=5).select(F.xxhash64(F.lit(3)).alias("hash"))
    again = spark.range(1000, numPartitions=2).select(F.xxhash64(F.col("id") + 500).alias("hash"))
    rows = hashes.unionByName(hot).unionByName(again)
    want = {r.hash for r in rows.groupBy("hash").count().where("count > 1").collect()}
    for limit in (64 << 20, 0):
        monkeypatch.setattr(A, "BROADCAST_BYTES", limit)
        (looked,) = A.possible_repeats(rows, [rows], n + n // 2 + 1000)
        maybe = {r.hash for r in looked.where("maybe").select("hash").distinct().collect()}
        assert want <= maybe and looked.count() == n + n // 2 + 1000
        assert len(maybe - want) < 0.08 * n


def test_two_cells_differ():
    shard, first, second = A.cells_of(np.arange(100_000, dtype=np.uint64), 3)
    assert (first != second).all() and set(shard.tolist()) == {0, 1, 2}


def test_hot_text_adds_one_row_a_task(spark):
    """A third of all rows with one text: the sketch rows and the exact groups do not follow its copies."""
    from pyspark.sql import functions as F

    rows = spark.range(30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, F.xxhash64(F.lit(1))).otherwise(F.xxhash64("id")).alias("hash"))
    assert A.sketches(rows, 1).count() == 1
    docs = rows.select(F.monotonically_increasing_id().alias("doc_id"), F.col("hash").cast("string").alias("text"), F.lit("en").alias("lang"))
    counts = A.flag_counts(docs, label_table(spark, LABELS)).collect()
    assert sum(r.n for r in counts) == 30_000 and sum(r.n for r in counts if r["mask"] & 16) == 9_999
