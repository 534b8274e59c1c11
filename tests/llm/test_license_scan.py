import re

import pytest
from helpers import DATA, documents, duck
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docketflow.llm.license_rules import BASE, BASE_SCORE, rules
from docketflow.llm.license_scan import Scanner, op13_license_scan, outermost, scan_licenses

RULES = rules()


def brute(text: str | None) -> tuple:
    """All rules on every text, words by a pattern, containment by comparing all pairs."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    joined = " ".join(words)
    starts = {}
    at = 0
    for k, w in enumerate(words):
        starts[at] = k
        at += len(w) + 1
    base = [(i, label) for phrase, label in BASE.items() for n in [len(phrase.split())] for i in range(len(words)) if words[i : i + n] == phrase.split()]
    found = []
    for k, (label, priority, score, _, pattern) in enumerate(RULES):
        for m in re.finditer(r"(?:(?<= )|\A)(?:" + pattern.decode() + r")(?= |\Z)", joined):
            found.append((starts[m.start()], starts[m.start()] + m[0].count(" ") + 1, priority, k, label, score))

    def hidden(d):
        return any(o is not d and o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and ((o[0], o[1]) != (d[0], d[1]) or (o[2], o[3]) < (d[2], d[3])) for o in found)

    kept = [d for d in found if not hidden(d)]
    base_labels = sorted({x for _, x in base})
    places = sorted(i for i, _ in base)
    score = max([BASE_SCORE[x] for x in base_labels] + [d[5] for d in kept], default=0.0)
    return len(words), len(places), places[0] if places else None, places[-1] if places else None, ",".join(base_labels), ",".join(sorted({d[4] for d in kept} | set(base_labels))), score


def seen(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hundreds_of_rules_with_a_keyword_in_every_match():
    assert len(RULES) > 300
    assert all(1 <= p <= 5 and 0 < s <= 1 for _, p, s, _, _ in RULES)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_keyword_gate_loses_no_match(data):
    k = data.draw(st.integers(0, len(RULES) - 1))
    pattern = RULES[k][4].decode().replace("[^ ]+", "[a-z0-9]+").replace("[^ ]", "[a-z0-9]")
    text = data.draw(st.from_regex(pattern, fullmatch=True))
    scanner = Scanner()
    assert RULES[k][3] in text.encode().split()
    found = scanner.matches(b" x " + text.encode() + b" y ", [k])
    assert found and max(e - s for s, e, _, _ in found) >= 1
    assert scanner.scan(text.encode())[-1]


def test_containment():
    # (start, end, priority, rule): longer or better ones suppress what they contain, overlaps both stay
    assert outermost([(0, 5, 2, 0), (1, 4, 2, 1), (1, 4, 1, 2), (3, 8, 3, 3), (0, 5, 2, 4)]) == [(0, 5, 2, 0), (1, 4, 1, 2), (3, 8, 3, 3)]
    assert outermost([(2, 4, 1, 0), (0, 9, 4, 1)]) == [(0, 9, 4, 1), (2, 4, 1, 0)]
    assert outermost([]) == []


TEXTS = [
    None, "", "   ", "---", "Licensed under CC BY-NC 4.0.", "cc by, cc by. CC-BY!", "GNU General Public License, version 3 (all rights reserved)",
    "licensed under the Apache License, Version 2.0", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "mit der Zeit, beer and new open games", "all rights\nreserved all RIGHTS reserved", "ALL RİGHTS RESERVED", "ccby cc  by", "MIT License or BSD-3-Clause or ISC license",
    "© 2021 Foo. Tous droits réservés", "word " * 6_000 + "cc by-sa 4.0", "cc by " * 3_000, "in the public domain is in the public domain",
]


def test_edges_against_brute_force(spark):
    docs = documents(spark, TEXTS + [TEXTS[5]], ids=[None, None, *range(2, len(TEXTS)), 2], labels="clash", n_words=7, carried="x")
    got = scan_licenses(docs)
    assert got.schema["carried"].dataType["labels"].dataType.simpleString() == "string"
    rows = got.select("text", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert tuple(r)[1:] == brute(r.text), (r.text or "")[:60]
    assert scan_licenses(docs.where("false")).count() == 0
    one = next(r for r in got.where("doc_id is null").collect()) if "doc_id" in got.columns else got.where("id is null").first()
    assert one.n_words == 0 and one.first_word is None and one.labels == "" and one.score == 0.0


def test_query_against_brute_force(spark):
    texts = dict(duck(f"{DATA}/sf0.001").execute("select doc_id, text from documents").fetchall())
    rows = op13_license_scan(spark, f"{DATA}/sf0.001").collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        assert tuple(r)[1:] == brute(texts[r.doc_id])


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_base_columns_against_sql(spark, sf):
    df = op13_license_scan(spark, f"{DATA}/{sf}")
    sql = r"""
    with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
    p as (select doc_id, w, range(len(w)) as i from w),
    b as (select doc_id, len(w) as n_words, list_filter(i, lambda k: w[k + 1 : k + 2] = ['cc', 'by'] or w[k + 1 : k + 3] = ['general', 'public', 'license'] or w[k + 1 : k + 3] = ['all', 'rights', 'reserved']) as hit from p)
    select doc_id, n_words, len(hit) as n_base, list_min(hit) as first_word, list_max(hit) as last_word from b"""
    want = sorted(duck(f"{DATA}/{sf}").execute(sql).fetchall())
    assert seen(df.select("doc_id", "n_words", "n_base", "first_word", "last_word")) == sorted(want, key=repr)


def test_linear_in_repeats():
    import time

    scanner, took = Scanner(), []
    for n in (40_000, 160_000):
        began = time.time()
        scanner.scan(b"licensed under the apache license version 2 0 " * n)
        took.append(time.time() - began)
    assert took[1] < 12 * took[0]
