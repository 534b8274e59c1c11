import __spark_entry__
import corpus_pipeline as P
from helpers import DATA, documents
from pyspark.sql import functions as F

from docketflow.llm.components import saved


def test_stages_keep_the_columns_and_take_effect(spark):
    sf = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in P.STAGES:
        before, docs = docs, saved(stage(spark, docs, sf), f"test-{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
            assert docs.join(before, "doc_id", "left_anti").count() == 0 and docs.count() == docs.select("doc_id").distinct().count()
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "packing"]
    texts = [r.text for r in seen["near_duplicates"].collect()]
    assert len(set(texts)) == len(texts)
    assert seen["substrings"].count() == seen["near_duplicates"].count()
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = "\n".join(" ".join(r.text.lower().split()) for r in seen["decontamination"].collect())
    assert not any(i in left for i in items)
    assert sorted(r.doc_id for r in seen["packing"].select("doc_id").distinct().collect()) == sorted(r.doc_id for r in seen["decontamination"].collect())
    assert seen["packing"].count() == P.run(spark, sf).count() > 0


def test_stages_on_empty_and_odd_documents(spark):
    sf = f"{DATA}/sf0.001"
    odd = documents(spark, [None, "", "a", "a", "b " * 30_000], ids=[None, 1, 2, 2, 3], extra="x").withColumn("lang", F.lit(None).cast("string"))
    for docs in (odd, odd.where("false")):
        for _, stage in P.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() <= 40


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_run_equals_brute_force(spark):
    """After the classifier (held to labels in its own tests) every stage is repeated in plain Python."""
    from test_decontamination import normal
    from test_minhash_dedup import brute as classes_of
    from test_packing import check
    from tokenizers import Tokenizer

    from docketflow.llm.packing import default_tokenizer

    sf = f"{DATA}/sf0.001"
    kept = sorted((r.doc_id, r.text) for r in P.quality_stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect())
    classes = classes_of([t for _, t in kept])
    one = [d for k, d in enumerate(kept) if classes[k] == k]
    words = [t.encode().split() for _, t in one]
    seen = {}
    for w in words:
        for k in range(len(w) - 34):
            seen[tuple(w[k : k + 35])] = seen.get(tuple(w[k : k + 35]), 0) + 1
    cut = []
    for (i, _), w in zip(one, words, strict=True):
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        cut.append((i, b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    items = [normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {i: t for i, t in cut if not any(b in normal(t) for b in items)}
    rows = P.run(spark, sf).collect()
    check(rows, clean, Tokenizer.from_file(default_tokenizer()))
