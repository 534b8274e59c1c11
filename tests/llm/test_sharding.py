import collections
import hashlib
import zlib

import pytest
from helpers import DATA, documents

from docketflow.llm.sharding import interleave, op7_sharding


def brute(rows, shards):
    """rows: (id, text, source)."""
    by = collections.defaultdict(list)
    for i, t, s in rows:
        raw = (t or "").encode()
        by[s].append((hashlib.md5(f"0:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, zlib.crc32(raw), len(raw) + 16, i))
    order = []
    for s, members in by.items():
        for r, m in enumerate(sorted(members)):
            order.append(((r + 0.5) / len(members), s is not None, s or "", r, m[5], m[4], m[3]))
    order.sort()
    n = len(order)
    out = []
    for place, (_, _, _, _, i, size, crc) in enumerate(order):
        shard = place * shards // n
        out.append((i, size, crc, shard, place - -(-shard * n // shards)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r[0], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("range_rows", [50_000, 37])
def test_query_matches_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr("docketflow.llm.sharding.RANGE_ROWS", range_rows)
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text", "source").collect()
    df = op7_sharding(spark, f"{DATA}/sf0.01")
    assert got(df) == brute([tuple(r) for r in docs], 40)
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    sizes = collections.Counter(r.shard for r in df.collect())
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1
    mix = collections.Counter((r.shard, r.source) for r in df.collect())
    share = collections.Counter(r.source for r in docs)
    assert all(abs(mix[(k, s)] - n / 40) < 3 for k in range(40) for s, n in share.items())


def test_edges(spark):
    texts = [None, "", "é", "a", "a", "a", "long " * 1000]
    docs = documents(spark, texts, ids=[None, 1, 2, 3, 3, None, 4], size="clash", shard=5)
    assert got(interleave(docs, 3)) == brute([(i, t, "src0") for i, t in zip([None, 1, 2, 3, 3, None, 4], texts)], 3)
    assert interleave(docs.where("false"), 3).count() == 0
    from pyspark.sql import functions as F

    nulls = docs.withColumn("source", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(F.col("source")))
    assert got(interleave(nulls, 40)) == brute([(i, t, None if i == 3 else "src0") for i, t in zip([None, 1, 2, 3, 3, None, 4], texts)], 40)
