import pytest
from helpers import DATA, documents
from pyspark.sql import functions as F

from docketflow.llm.quality import classify, op3_quality_classifier, platt, word_set


def test_held_out_accuracy(spark):
    """Labels of every third document are held out; most of what is rejected is bad, and few clean documents are."""
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    found = classify(docs, labels.where(~held)).select("doc_id", "keep").join(labels.where(held), "doc_id")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    clean, lost, bad, kept = found.select(F.count_if(good), F.count_if(good & ~F.col("keep")), F.count_if(~good), F.count_if(~good & F.col("keep"))).first()
    assert clean > 900 and lost < 0.02 * clean
    assert bad > 200 and kept < 0.08 * bad


def test_query_scores_every_document(spark):
    found = op3_quality_classifier(spark, f"{DATA}/sf0.001")
    assert found.count() == spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").count()
    assert found.where("score is null or keep is null or not score between 0 and 1").count() == 0


@pytest.mark.parametrize("labels", [[], [(0, 1, 0)], [(k, 1, 0) for k in range(40)], [(k, k % 2, 0) for k in range(80)] + [(None, 1, 1), (3, None, 1), (999, 0, 0), (4, 0, 0)]])
def test_edges(spark, labels):
    texts = [None, "", "  "] + ["good clean words here" if k % 2 else "bad!! BAD!! $$$" for k in range(3, 80)] + ["é" * 200_000]
    docs = documents(spark, texts, score="clash", keep="clash").withColumn("source", F.when(F.col("doc_id") > 5, F.col("source")))
    docs = docs.unionByName(docs.where("doc_id = 7")).unionByName(docs.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = classify(docs, table).collect()
    assert len(found) == len(texts) + 2 and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in found)
    assert classify(docs.where("false"), table).count() == 0
    if len(labels) > 50:
        assert all(r.keep == (r.text.startswith("good")) for r in found if r.text and len(r.text) < 100 and r.text.strip())


def test_word_set_counts_frequent_beginnings():
    found = word_set("abcdxx abcdyy abcdzz other, words")
    assert {"abcd~2", "abcdxx", "words"} <= found and word_set(None) == set()


def test_platt_stands_separable_margins():
    import numpy as np

    a, b = platt(np.array([-1e6, -5.0, 5.0, 1e6]), np.array([0.0, 0.0, 1.0, 1.0]))
    assert a > 0 and abs(b) < 5


def test_every_word_of_a_long_text_and_labels_without_documents(spark, monkeypatch):
    """A mark with the largest code of over 4,000 is chosen; labels without a document don't use up the sample."""
    from docketflow.llm import quality as Q

    common = " ".join(f"w{k}q" for k in range(5000))
    mark = max((f"mark{k}" for k in range(50_000)), key=Q.code)
    docs = documents(spark, [f"{common} {mark}" if k % 2 else common for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(2000)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(Q, "FIT", 50)
    found = Q.sample(docs, labels)
    assert len(found) == 40 and found["y"].notna().all()
    assert all((Q.code(mark) in w.tolist()) == (i % 2 == 1) for i, w in zip(found["doc_id"], found["words"], strict=True))


def test_pseudo_labels_come_from_the_whole_pool_and_the_fit_is_the_optimum(spark):
    """Choice by sorting all margins, and the gradient over all chosen rows, by brute force."""
    import numpy as np
    import pyarrow as pa

    from docketflow.llm import quality as Q

    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    work = Q.CoTraining(Q.sample(docs, labels))
    known = {r.doc_id for r in labels.collect()}
    rows = docs.select("doc_id", "text", "source", "lang").toPandas()
    rows = rows[~rows["doc_id"].isin(known)].reset_index(drop=True)
    assert len(rows) > 5_000
    described = work.model.described(rows["text"].tolist(), rows["source"].tolist(), rows["lang"].tolist())
    described["luck"] = (np.arange(len(rows)) * 0.618034) % 1
    first = list(work.model.betas)
    pool = spark.createDataFrame(described[["luck", "cols", "form", "meta"]]).repartition(7)
    work.round(pool)
    both = Q.views(pa.RecordBatch.from_pandas(described), work.model.widths[0])
    picked = Q.chosen(both, described["luck"].to_numpy(), work.history)
    want = Q.SHARE * len(rows)
    for v in (0, 1):
        at = Q.margins(*both[v], first[v], len(rows))
        active, label = picked[1 - v]
        for side in (1.0, 0.0):
            mine = active & (label == side)
            m = at if side else -at
            sure = m > np.log(Q.SURE / (1 - Q.SURE)) + 0.01
            part = want * work.model.prior if side else want * (1 - work.model.prior)
            assert abs(mine.sum() - min(part, sure.sum())) <= 0.15 * part + 5
            if mine.any():
                assert m[mine].min() >= np.sort(m)[::-1][: max(1, int(part))].min() - 0.02
    for v, (active, label) in enumerate(picked):
        stats = Q.statistics(*both[v], label, active, work.model.betas[v])
        _, slope, _ = work.objective(v, work.model.betas[v], stats)
        assert np.abs(slope).max() < 1e-3
    assert picked[1][0].sum() > 100  # the metadata view is rarely sure on these tables
