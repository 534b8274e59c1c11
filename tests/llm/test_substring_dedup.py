import collections
import hashlib
import random

import pytest
from helpers import DATA, documents, same_as_sql, twins

from docketflow.llm.substring_dedup import OP1_SQL, op1_substring_dedup, substring_dedup


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_query_matches_sql(spark):
    same_as_sql(op1_substring_dedup(spark, f"{DATA}/sf0.001"), OP1_SQL, f"{DATA}/sf0.001")


def test_edges_match_brute_force(spark):
    r = random.Random(5)
    word = lambda n: [f"w{r.randrange(10**6)}é" for _ in range(n)]
    shared = word(60)
    texts = [
        None, "", "   \n\t", "one", " ".join(word(34)), " ".join(word(35)), " ".join(shared), " ".join(word(7) + shared + word(50)),
        "\n".join(word(3) + shared[10:50] + word(9)), " ".join(shared[:34]), "a " * 40, "a " * 200, "same text twice " * 20, "same text twice " * 20,
        " ".join(word(3000) + shared[:36]), "nbsp\u00a0is no space " * 3, "x" * 300_000, "x" * 300_000,
    ]
    for window in (35, 6, 1):
        got = {x.id: (x.n_words, x.n_removed, x.kept_sha256) for x in substring_dedup(documents(spark, texts, id=1, grp="clash"), window=window).collect()}
        assert [got[k] for k in range(len(texts))] == brute(texts, window)


def test_text_is_cut_in_place(spark):
    shared = " ".join(f"s{k}" for k in range(40))
    texts = [f"first line\n{shared} tail\n\nend", f"{shared}", "untouched  text\n "]
    got = {x.id: x for x in substring_dedup(documents(spark, texts)).collect()}
    assert got[0].text == "first line\ntail\n\nend" and got[0].spans[0].asDict() == {"start": 2, "end": 42}
    assert got[1].text == "" and got[2].text == texts[2]
    assert got[0].carried.lang == "en"


def test_repeated_and_null_ids(spark):
    text = " ".join(f"s{k}" for k in range(50))
    got = substring_dedup(documents(spark, [text, text, text, "b"], ids=[7, 7, None, None])).collect()
    assert sorted(x.n_removed for x in got) == [0, 50, 50, 50]


def test_empty_table(spark):
    assert substring_dedup(documents(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1024, 2048])
def test_twin_words_repeat_nothing(spark, n):
    same = " ".join(f"w{k}" for k in range(34))
    texts = [f"{same} {w}" for w in twins(n)] + [f"{w} {same}" for w in twins(n)]
    assert [x.n_removed for x in substring_dedup(documents(spark, texts)).collect()] == [0] * 4
