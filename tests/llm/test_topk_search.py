import math
import random

from helpers import DATA, same_as_sql
from pyspark.sql import functions as F

from docketflow.llm.topk_search import OP2_SQL, op2_topk_search, top_k


def test_query_matches_sql(spark):
    same_as_sql(op2_topk_search(spark, f"{DATA}/sf0.001"), OP2_SQL, f"{DATA}/sf0.001")


def brute(data, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in good if j != i and len(c) == len(q))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, data, k):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0, k).collect())


def test_edges_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr("docketflow.llm.topk_search.SHARD_ROWS", 100)
    monkeypatch.setattr("docketflow.llm.topk_search.QUERY_ROWS", 7)
    r = random.Random(2)
    f = lambda n: [float(int(r.gauss(0, 1) * 64)) / 64 for _ in range(n)]
    data = [(i, f(4)) for i in range(400)] + [(i, [0.25] * 4) for i in range(400, 500)]  # ties
    data += [(500, None), (501, []), (520, [1.0, None, 0.0, 0.0]), (540, [math.nan] * 4), (560, [math.inf] * 4), (None, [1.0] * 4), (580, [1.0, 2.0]), (581, [3.0, 1.0]), (20, f(4))]
    assert run(spark, data, 5) == brute(data, 5)


def test_fewer_candidates_than_k_and_none(spark):
    data = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [-1.0, 2.0])]
    assert run(spark, data, 20) == brute(data, 20)
    assert run(spark, [(0, [1.0])], 20) == []
    assert run(spark, [], 20) == []


def test_large_components_stay_exact(spark):
    data = [(i, [float(2**22 + i), -float(2**14 * i)]) for i in range(40)]
    assert run(spark, data, 3) == brute(data, 3)
