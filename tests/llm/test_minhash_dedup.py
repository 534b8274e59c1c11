import collections
import inspect
import math
import random

import numpy as np
import pytest
from helpers import documents, twins

from docketflow.llm import minhash_dedup as M
from docketflow.llm.components import components, linked


def elements(text, width=5):
    w = (text or "").encode().split()
    grams = [tuple(w[k : k + width]) for k in range(len(w) - width + 1)] if len(w) >= width else ([tuple(w)] if w else [])
    n = collections.Counter()
    out = set()
    for g in grams:
        n[g] += 1
        out.add((g, n[g]))
    return out


def brute(texts, threshold=0.8):
    """Class of each text, by all pairs."""
    sets = [elements(t) for t in texts]
    df = collections.Counter(e for s, t in zip(sets, texts) if t is not None for e in s)
    total = sum(t is not None for t in texts)
    idf = {e: 1 + math.log(total / n) / math.log(max(2, total)) for e, n in df.items()}
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if texts[a] is None or texts[b] is None:
                continue
            both, either = sets[a] & sets[b], sets[a] | sets[b]
            weight = lambda s: sum(idf[e] for e in s)
            if texts[a] == texts[b] or either and (weight(both) >= threshold * weight(either) or len(both) >= threshold * len(either)):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(len(texts))]


def near(r, words, rate):
    return " ".join(f"new{r.randrange(10**9)}" if r.random() < rate else w for w in words)


def corpus(r, groups=12):
    texts = [None, None, "", "", " ", "a b", "a b", "a  b", "one two three four five", "x " * 400, "x " * 400, "x " * 390]
    for g in range(groups):
        words = [f"g{g}w{r.randrange(10**6)}" for _ in range(r.choice([12, 80, 300]))]
        texts += [" ".join(words)] * r.choice([1, 3]) + [near(r, words, rate) for rate in (0.004, 0.01, 0.02, 0.04, 0.08, 0.2)]
    texts += ["common first line of many documents here\n" + " ".join(f"u{r.randrange(10**6)}" for _ in range(60)) for _ in range(60)]
    return texts


@pytest.mark.parametrize("blocks", [(512, 192, 8000), (4, 3, 50)])
def test_classes_match_brute_force(spark, monkeypatch, blocks):
    for name, v in zip(("BUCKET_BLOCK", "CLASS_BLOCK", "BATCH_ROWS"), blocks):
        monkeypatch.setattr(M, name, v)
    texts = corpus(random.Random(4))
    got = {r.id: (r.class_id, r.class_size) for r in M.near_duplicates(documents(spark, texts, id="clash", node=1)).collect()}
    want = brute(texts)
    size = collections.Counter(want)
    assert [got[k] for k in range(len(texts))] == [(c, size[c]) for c in want]


def test_repeated_and_null_ids_and_empty(spark):
    docs = documents(spark, ["same text"] * 3 + ["other", None, None], ids=[5, 5, None, None, None, 9])
    got = sorted(((r.id, r.class_id, r.class_size) for r in M.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 5, 3), (5, 5, 3), (None, 5, 3), (None, None, 1), (None, None, 1), (9, 9, 1)], key=repr)
    kept = sorted(((r.id, r.text) for r in M.one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(5, "same text"), (None, "other"), (None, None), (9, None)], key=repr)
    assert M.near_duplicates(documents(spark, [])).count() == 0
    assert M.near_duplicates(documents(spark, ["only one"])).count() == 1


def test_different_texts_under_null_or_one_id(spark):
    texts = ["first of all", "quite another", "first of all", "third text", "fourth text", "fourth text", None, None, None, "fifth"]
    docs = documents(spark, texts, ids=[None, None, None, 7, 7, 8, None, 7, 7, -(2**63) + 1])
    kept = sorted(((r.id, r.text) for r in M.one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(None, "first of all"), (None, "quite another"), (7, "third text"), (7, "fourth text"), (None, None), (7, None), (7, None), (-(2**63) + 1, "fifth")], key=repr)
    for some in (docs, docs.where("doc_id is null or doc_id > 0"), docs.where("doc_id is null")):
        got = M.distinct_ids(M.near_duplicates(some)).collect()
        size = collections.Counter(r.class_id for r in got)
        assert len(got) == some.count() and None not in size and all(size[r.class_id] == r.class_size for r in got)
        n_texts = some.where("text is not null").select("text").distinct().count() + some.where("text is null").count()
        assert len(size) == n_texts


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng, table = np.random.default_rng(1), M.draws(64)
    for n in (100, 20_000):
        agree = []
        for _ in range(30):
            both = rng.integers(0, 2**63, int(n * 0.85)).astype(np.uint64)
            sides = []
            for _ in range(2):
                own = rng.integers(0, 2**63, n - len(both)).astype(np.uint64)
                keys, weight = np.concatenate([both, own]), np.concatenate([np.full(len(both), 1.5), np.full(len(own), 2.0)]).astype(np.float32)
                order = np.argsort(keys)
                sides.append(M.sample(np.zeros(n, np.int64), keys[order], weight[order], 1, table))
            agree.append((sides[0] == sides[1]).mean())
        shared, own = 1.5 * len(both), 2.0 * (n - len(both))
        assert abs(np.mean(agree) - shared / (shared + 2 * own)) < 0.03


def test_candidates_reach_plain_similarity_in_a_hot_group():
    """At a plain 0.8 with shared elements of weight 1 and own ones of weight 2 hardly a pair is missed."""
    given = inspect.signature(M.near_duplicates).parameters
    bands, rows = given["bands"].default, given["rows"].default
    rng, table, missed, pairs = np.random.default_rng(3), M.draws(bands * rows), 0, 1500
    for _ in range(pairs):
        keys = np.sort(rng.integers(0, 2**63, 100).astype(np.uint64))
        kind = rng.permutation([0] * 80 + [1] * 10 + [2] * 10)
        sides = []
        for own in (1, 2):
            mine = (kind == 0) | (kind == own)
            sides.append(M.sample(np.zeros(90, np.int64), keys[mine], np.where(kind[mine] == 0, 1, 2).astype(np.float32), 1, table)[0])
        same = sides[0] == sides[1]
        in_band = np.all([same[r::rows] for r in range(rows)], axis=0).any()
        missed += not (in_band and same.mean() >= M.AGREE)
    assert missed <= 5, missed


def test_components(spark):
    r = random.Random(8)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, x) for x in range(5001, 5100)]
    got = {bytes(x.node): bytes(x.comp) for x in components(spark.createDataFrame([(bytes([a // 256, a % 256]), bytes([b // 256, b % 256])) for a, b in pairs], "a binary, b binary")).collect()}
    up = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in range(len(up)):
        before = dict(up)
        for a, b in pairs:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
        if up == before:
            break
    assert got == {bytes([a // 256, a % 256]): bytes([c // 256, c % 256]) for a, c in up.items()}
    assert components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_linked_is_a_spanning_set():
    ok = np.zeros((5, 5), bool)
    ok[0, 3] = ok[3, 0] = ok[3, 4] = ok[4, 3] = True
    assert sorted(linked(ok)) == [(0, 3), (0, 4)]


@pytest.mark.parametrize("n", [1024, 2048])
def test_twin_words_are_two_classes(spark, n):
    a, b = twins(n)
    found = M.near_duplicates(documents(spark, [a, b, f"x {a} y", f"x {b} y", a]))
    assert len({r.comp for r in found.collect()}) == 4
