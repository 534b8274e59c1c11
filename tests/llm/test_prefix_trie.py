import collections
import hashlib
import random
import re
import zlib

import pytest
from helpers import DATA, same_as_sql

import docketflow.llm.prefix_trie as T
from pyspark.sql import functions as F


def sequences(rows):
    """rows (conv, turn, role, text) -> conv -> list of (role, text), ordered."""
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            by[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), r, x))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in by.items()}


def reorder(seqs):
    out = {}
    for c, s in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c - 20 * int(c / 20))
        out[c] = seqs.get(base, [])[:h] + s[h:]
    return out


def brute(seqs):
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows, **more):
    out = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return out.withColumns({k: F.lit(v) for k, v in more.items()})


def trie(conversations):
    lead = F.crc32(F.encode(F.col("conv").cast("string"), "utf-8")) % 4
    return sorted((tuple(r) for r in T.prefix_trie(*T.rebuilt(T.turns(conversations), 20, lead)).collect()), key=repr)


def test_query_matches_sql(spark):
    same_as_sql(T.op11_prefix_trie(spark, f"{DATA}/sf0.01"), T.OP11_SQL, f"{DATA}/sf0.01")


def test_edges(spark):
    rows = [(None, 0, "user", "lost"), (None, None, None, None), (-7, 0, "u", "minus"), (-20, 1, "u", "a b"), (-40, 1, "u", "a b")]
    rows += [(c, t, "user" if t % 2 == 0 else "bot", f"turn {t}") for c in range(20, 45) for t in range(c % 7)]
    rows += [(60, None, "x", "first"), (60, None, "x", "first"), (60, 0, None, None), (60, 0, "", ""), (60, 0, "x", ""), (60, 5, "a", "b " * 50_000)]
    rows += [(61, 1, "y", "own")] + [(c, 0, "user", "same") for c in range(100, 140)] + [(63, 2, "é", "ü\x0b\x1cz")]
    got = trie(table(spark, rows, depth=9, name="clash", conv="x", lo=1))
    assert got == brute(reorder(sequences(rows)))
    assert any(r[3] > 1 and r[1] == 0 for r in got)
    assert trie(table(spark, rows).where("false")) == []
    assert trie(table(spark, [(1, 0, "a", "b")])) == brute(reorder(sequences([(1, 0, "a", "b")])))
    turnless = [(21, 0, "a", "b")] if zlib.crc32(b"21") % 4 else [(22, 0, "a", "b")]
    assert trie(table(spark, turnless)) == brute(reorder(sequences(turnless))) and len(trie(table(spark, turnless))) == 1


@pytest.mark.parametrize("seed,depth", [(1, 5), (2, 21)])
def test_random_tries_against_brute_force(spark, seed, depth):
    """Few distinct turns and random lengths: many shared beginnings, ends at every depth."""
    rng = random.Random(seed)
    seqs, rows = {}, []
    for c in range(150):
        stem = list(seqs.get(rng.randrange(max(1, c)), []))[: rng.randrange(depth + 1)]
        seqs[c] = stem + [rng.choice("ab") for _ in range(rng.randrange(depth + 1 - len(stem)))]
        rows += [(c, k, "r", x * (1 + k % 3)) for k, x in enumerate(seqs[c])]
    own = table(spark, rows)
    symbols, convs = T.rebuilt(T.turns(own), 20, F.lit(0))
    got = sorted((tuple(r) for r in T.prefix_trie(symbols, convs).collect()), key=repr)
    want = brute({c: s for c, s in sequences(rows).items()})
    assert got == want
    assert max(r[1] for r in got) > depth // 2


def test_hot_conversation_and_hot_beginning_spread(spark, monkeypatch):
    """A third of all rows in one conversation, another third with one first turn; long lists of ends in pieces."""
    monkeypatch.setattr(T, "PIECE_BYTES", 64)
    rows = [(1, k, "u", f"t{k % 11}") for k in range(120)] + [(c, 0, "u", "hello") for c in range(1000, 1120)] + [(c, 0, "u", f"w{c}") for c in range(2000, 2120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or this little input is one range
    placed = T.numbered(T.turns(table(spark, rows)).repartition(5))
    parts = placed.where("conv = 1").groupBy("part").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and max(p["count"] for p in parts) < 100
    assert trie(table(spark, rows).repartition(5)) == brute(reorder(sequences(rows)))
