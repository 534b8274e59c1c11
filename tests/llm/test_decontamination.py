import random

import numpy as np
import pytest
from helpers import DATA, documents

from docketflow.llm.decontamination import BUDGET, PART, PART_CHARS, WORD, Q, banded, find_leaks, normal, op10_decontamination, points, qgrams


def distance_within(item, text):
    """Fewest edits of item against any stretch of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        diag, row[0] = row[0], 0
        for k in range(1, len(item) + 1):
            diag, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, diag + (c != item[k - 1]))
        best = min(best, row[-1])
    return best


def budget(m):
    return max(0, min(int(BUDGET * m), (m - 2 * Q + 1) // Q))


def in_part(item, text):
    """Whether some diagonal band's shared q-grams cover enough of the item, by sets."""
    need, stripe = max(-(-len(item) * PART // 1), PART_CHARS), max(budget(len(item)), WORD) + 1
    bands = {}
    for p in range(len(item) - Q + 1):
        a = text.find(item[p : p + Q])
        while a >= 0:
            for band in ((a - p) // stripe, (a - p) // stripe - 1):
                bands.setdefault(band, set()).update(range(p, p + Q))
            a = text.find(item[p : p + Q], a + 1)
    return max(map(len, bands.values()), default=0) >= need and distance_within(item, text) <= len(item) - need


def changed(r, text, edits):
    s = list(text)
    for _ in range(edits):
        k = r.randrange(len(s))
        s[k : k + 1] = r.choice([["#"], [], [s[k], "#"]])
    return "".join(s)


def test_planted_items_match_brute_force(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [prose(n) for n in (4, 6, 10, 25, 40, 60)] + ["Short", None, "", "  ", "of the of the of the of the of the of the"]
    texts = [None, "", "short", prose(50), "of the " * 60, "x" * 50_000]
    for k in range(6):
        b = budget(len(normal(items[k])))
        for edits in {0, b, b + 1, 3 * b + 4}:
            texts.append(prose(r.randrange(40)) + " " + changed(r, items[k].upper(), edits).replace(" ", "\n ") + " " + prose(r.randrange(40)))
        texts.append(items[k][: len(items[k]) // 2] + " " + prose(30))
    docs = documents(spark, texts, id="clash", leaks=0)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    leaks = [(d.id, x) for d in find_leaks(docs, bench).collect() for x in d.leaks]
    got = {(i, x.item_id): x.edits for i, x in leaks if x.whole}
    parts = {(i, x.item_id) for i, x in leaks if not x.whole}
    want, want_parts = {}, set()
    for i, t in enumerate(texts):
        for j, item in enumerate(items):
            m = normal(item)
            if m and normal(t) and len(t) < 20_000 and (e := distance_within(m, normal(t))) <= budget(len(m)):
                want[(i, j)] = e
            elif m and t and len(t) < 20_000 and in_part(m, normal(t)):
                want_parts.add((i, j))
    assert got == want and len(want) > 12
    assert parts == want_parts


def test_query_finds_the_items_of_the_tables(spark):
    sf = f"{DATA}/sf0.01"
    docs = {r.doc_id: normal(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in op10_decontamination(spark, sf).collect()}
    exact = {(i, j) for i, t in docs.items() for j, b in items.items() if b in t}
    assert exact <= got.keys()
    for (i, j), r in got.items():
        assert distance_within(items[j], docs[i]) <= r.edits
        assert r.edits <= budget(len(items[j])) if r.whole else in_part(items[j], docs[i])
        if not r.edits:
            assert docs[i][r.region_start : r.region_end] == items[j]


def test_benchmark_in_parts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr("docketflow.llm.decontamination.PART_BYTES", 60)
    items = [(k, f"this is benchmark item number {k} with some more words") for k in range(6)]
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string")
    docs = documents(spark, ["- " + t + " -" for _, t in items] * 2, ids=[0, 1, 2, 3, 4, 5, 0, None, 2, 3, 4, 5])
    found = find_leaks(docs, bench).collect()
    assert all(any(x.edits == 0 for x in d.leaks) for d in found) and len(found) == 12
    assert all(d.leaks == [] for d in find_leaks(docs, bench.where("false")).collect())
    assert find_leaks(docs.where("false"), bench).count() == 0


@pytest.mark.parametrize("q", [1, 2, 5, 8, 11, 12, 13])
def test_qgrams_are_equal_for_equal_stretches(q):
    r = random.Random(q)
    s = "".join(r.choice("ab") for _ in range(400))
    h = qgrams(points(s), q)
    by = {}
    for k in range(len(s) - q + 1):
        by.setdefault(s[k : k + q], set()).add(int(h[k]))
    assert len(h) == len(s) - q + 1 and all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)
    assert len(qgrams(points("a" * (q - 1)), q)) == 0


def test_banded_equals_full_alignment():
    r = random.Random(1)
    for _ in range(300):
        item = "".join(r.choice("abc") for _ in range(r.randrange(1, 20)))
        text = "".join(r.choice("abc") for _ in range(r.randrange(0, 30)))
        edits, start, end = banded(points(item), points(text), -40, 60)
        assert edits == distance_within(item, text)
        assert 0 <= start <= len(text) and end <= len(text) and distance_within(item, text[start:end]) == edits
    assert np.array_equal(points("aé"), [97, 233])


def test_items_with_empty_and_null_ids(spark):
    """Ids of any type are put in order, an empty string beside null and other ones too."""
    text = "the committee met seventeen times in the hall by the river to settle the terms of the treaty"
    bench = spark.createDataFrame([("", text), (None, text + " at last"), ("b", "another passage of some length that no document of this table holds anywhere")], "item_id string, text string")
    found = find_leaks(documents(spark, [f"before. {text} after", "nothing"], item_id="clash", leaks="clash"), bench).collect()
    assert {r.id: [x.item_id for x in r.leaks] for r in found}[1] == []
    assert "" in {r.id: [x.item_id for x in r.leaks] for r in found}[0]


def test_replaced_words_and_parts_of_an_item(spark):
    """One longer word in place of another, several edits, and 70 % of an item are reported; less than half of it is not."""
    item = "the committee met seventeen times in the hall by the river to settle the terms of the treaty"
    texts = [
        item.replace("committee", "delegation"),
        item.replace("seventeen", "twenty-three"),
        item[: int(0.7 * len(item))],
        item[int(0.3 * len(item)) :],
        item.replace("hall", "hell").replace("river", "rivers").replace("terms", "term"),
        item[: int(0.45 * len(item))],
        "the committee of the river met in a hall to settle on the treaty and its many terms",
    ]
    docs = documents(spark, [f"words that come first {t} and words that follow" for t in texts])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = {r.id: [(x.item_id, x.whole) for x in r.leaks] for r in find_leaks(docs, bench).collect()}
    assert all([i for i, _ in found[k]] == [7] for k in range(5)) and found[5] == found[6] == []
    assert found[4] == [(7, True)] and found[2] == found[3] == [(7, False)]
