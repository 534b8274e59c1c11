"""Operator 11: the prefix trie of all conversations, by van Emde Boas recursion.

A conversation is a sequence of turns; every distinct beginning of one is a node, named by
its depth and the smallest conversation that begins so.  A subproblem holds the sequences
below one node, between its depth ``lo`` and ``lo + 2**(k + 1)``, and is cut at half depth:

- sequences that reach the cut are grouped by the digest of their turns from ``lo`` to the
  cut; each group is a node there, and its smallest member names it;
- the upper trie goes on with one sequence for each cut prefix, which carries the number of
  its members, and with the sequences that end above the cut;
- the lower forest goes on with the sequences that reach below it, under their new node.

All subproblems of one width are one round, so a trie of depth D takes log2(D) rounds.
Digests of all blocks of 2**k turns come from those of 2**(k - 1), so a round compares one
value per sequence and no task ever holds a conversation.

Totals are grafted upward along the same cuts: first every node's sum over its lower
forest, widths ascending, then, widths descending, each upper trie receives the totals of
the cut nodes that its sequences stand for.

Hot cases: turns are numbered by ranges of (conversation, turn), so a conversation that
holds a third of all rows spreads over tasks; equal beginnings are counted before the
shuffle and leave one sequence each; the ids that end at one node are joined to pieces of
64 KB by range before one digest runs over the pieces.

Defined cases: a null role or text is empty; a null turn comes first; turns with equal
numbers go by the digest of role and text, equal rows stay separate turns; rows without a
conversation id belong to none and are left out; texts of any length are digested whole;
an empty table has no nodes; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import saved

SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of ids in one piece of a node's list.
PIECE_BYTES = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, sym, words) of every turn: the digest of role and text, the words of the text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    return conversations.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("sym"),
        F.size(F.array_remove(F.split(text, SPACE), "")).cast("long").alias("words"))


def numbered(rows: DataFrame) -> DataFrame:
    """(conv, part, place, sym, words): ``place`` counts a conversation's turns within the range ``part`` of all."""

    def count(batches):
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch["conv"].to_numpy(zero_copy_only=False)
            at = np.arange(len(conv))
            first = np.concatenate([[True], conv[1:] != conv[:-1]])
            place = at - np.maximum.accumulate(np.where(first, at, 0))
            if last == conv[0]:
                head = np.flatnonzero(first)[1] if first.sum() > 1 else len(conv)
                place[:head] += n
            last, n = conv[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch["conv"], pa.array(np.full(len(conv), part, np.int32)), pa.array(place.astype(np.int64)), batch["sym"], batch["words"]], names=["conv", "part", "place", "sym", "words"])

    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("sym"), F.col("tie")]  # the row number splits a range of equal rows
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.drop("turn", "tie").mapInArrow(count, "conv long, part int, place long, sym binary, words long")


def rebuilt(rows: DataFrame, group: int, lead: Column) -> tuple[DataFrame, DataFrame]:
    """Sequences after the exchange of their beginnings: turns (conv, pos, sym, words) and conversations (conv, len).

    The first ``lead`` (a column of ``conv``, below 4) turns come from the conversation at
    the last multiple of ``group``.
    """
    placed = saved(numbered(rows), "places")
    here = placed.groupBy("conv", "part").agg((F.max("place") + 1).alias("n"))
    own = W.partitionBy("conv")
    runs = here.select("conv", "part", F.sum("n").over(own).alias("n"), F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    runs = saved(runs.withColumn("h", lead.cast("long")).withColumn("first", F.col("conv") - F.col("conv") % group), "runs")
    lengths = runs.where("before = 0").drop("before", "part")
    given = lengths.join(lengths.select(F.col("conv").alias("first"), F.col("n").alias("found")), "first", "left").withColumn("given", F.least("h", F.coalesce("found", F.lit(0))))
    convs = saved(given.select("conv", "first", "h", "given", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    # (conv, part) instead of conv: the turns of a hot conversation meet it in many places
    moved = runs.select("conv", "part", "before", "h").join(convs.select("conv", "given"), "conv")
    at = placed.join(moved, ["conv", "part"]).withColumn("pos", F.col("place") + F.col("before"))
    kept = at.where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "sym", "words")
    heads = at.where((F.col("conv") % group == 0) & (F.col("pos") < 4)).select(F.col("conv").alias("first"), "pos", "sym", "words")
    taken = convs.where("given > 0").select("conv", "first", "h").join(heads, "first").where("pos < h").select("conv", "pos", "sym", "words")
    return saved(kept.unionByName(taken), "turns"), convs.select("conv", "len")


def blocks(symbols: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k: (conv, block, sym) of all whole blocks of 2**k turns, at the multiples of 2**k."""
    found = [symbols.select("conv", F.col("pos").alias("block"), "sym")]
    for _ in range(1, levels):
        last = found[-1]
        left = last.where("block % 2 = 0").select("conv", F.expr("shiftright(block, 1)").alias("block"), F.col("sym").alias("a"))
        right = last.where("block % 2 = 1").select("conv", F.expr("shiftright(block, 1)").alias("block"), F.col("sym").alias("b"))
        found.append(saved(left.join(right, ["conv", "block"]).select("conv", "block", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("sym")), "blocks"))
    return found


def cuts(convs: DataFrame, level_blocks: list[DataFrame], root: int) -> list[DataFrame]:
    """Members of each round: (conv, lo, start, name, n_convs, weight, stands, len).

    Of the sequences below node (lo, start) those that reach the cut; ``name`` is their
    node there; ``stands`` tells sequences that stand for all members of a node at ``len``.
    """
    members: list[DataFrame] = [None] * len(level_blocks)
    live = convs.where("len > 0").select("conv", F.lit(0).cast("long").alias("lo"), F.lit(root).cast("long").alias("start"), F.lit(1).cast("long").alias("weight"), F.lit(False).alias("stands"), "len")
    for k in reversed(range(len(level_blocks))):
        half = 1 << k
        reach = live.where(F.col("len") >= F.col("lo") + half).withColumn("block", F.expr(f"shiftright(lo, {k})")).join(level_blocks[k], ["conv", "block"])
        key = ["lo", "start", "sym"]
        nodes = reach.groupBy(*key).agg(F.min("conv").alias("name"), F.sum("weight").alias("n_convs"))
        members[k] = found = saved(reach.join(nodes, key).select("conv", "lo", "start", "name", "n_convs", "weight", "stands", "len"), f"cut-{k}")
        if k:
            mid = F.col("lo") + half
            upper = found.where("conv = name").select("conv", "lo", "start", F.col("n_convs").alias("weight"), F.lit(True).alias("stands"), mid.alias("len"))
            lower = found.where(F.col("len") > mid).select("conv", mid.alias("lo"), F.col("name").alias("start"), "weight", "stands", "len")
            live = saved(live.where(F.col("len") < mid).unionByName(upper).unionByName(lower), f"live-{k}")
    return members


def ends(found: DataFrame) -> DataFrame:
    """(depth, conv, ends_sha256) from rows (depth, conv, member): the digest of the members, ascending, joined by commas."""

    def piece(batches):
        key, first, ids, size = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([first], pa.int64()), pa.array([b",".join(ids)], pa.binary())], names=["depth", "conv", "first", "body"])

        for batch in batches:
            for *this, member in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if this != key or size >= PIECE_BYTES:
                    if key is not None:
                        yield out()
                    key, first, ids, size = this, member, [], 0
                ids.append(str(member).encode())
                size += len(ids[-1]) + 1
        if key is not None:
            yield out()

    def digest(batches):
        key, state = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()])], names=["depth", "conv", "ends_sha256"])

        for batch in batches:
            for *this, body in zip(batch["depth"].to_pylist(), batch["conv"].to_pylist(), batch["body"], strict=True):
                if this != key:
                    if key is not None:
                        yield out()
                    key, state = this, hashlib.sha256(body.as_py())
                else:
                    state.update(b"," + body.as_py())
        if key is not None:
            yield out()

    order = ["depth", "conv", "member"]
    pieces = found.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(piece, "depth long, conv long, first long, body binary")
    return pieces.repartition("depth", "conv").sortWithinPartitions("depth", "conv", "first").mapInArrow(digest, "depth long, conv long, ends_sha256 string")


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


SUMS = ["n_leaves", "saved_tokens"]


def grafted(nodes: DataFrame, members: list[DataFrame]) -> DataFrame:
    """Subtree sums: ``nodes`` (depth, conv, level, lo, start, n_leaves, saved_tokens) with the last two summed up."""
    given, below = [], []

    def plus(own: DataFrame, more: list[DataFrame]) -> DataFrame:
        if not more:
            return own
        extra = union(more).groupBy("depth", "conv").agg(*[F.sum(c).alias(f"more_{c}") for c in SUMS])
        return own.join(extra, ["depth", "conv"], "left").select("depth", "conv", "lo", "start", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in SUMS])

    for k in range(len(members) + 1):  # the root comes last
        own = nodes.where(F.col("level") == k).select("depth", "conv", "lo", "start", *SUMS)
        below.append(saved(plus(own, given), f"below-{k}"))
        given.append(below[-1].groupBy(F.col("lo").alias("depth"), F.col("start").alias("conv")).agg(*[F.sum(c).alias(c) for c in SUMS]))
    done = [below.pop()]
    for k in reversed(range(len(members))):
        stands = members[k].where("stands").select(F.col("len").alias("depth"), "conv", (F.col("lo") + (1 << k)).alias("mid"), "name")
        up = stands.join(union(done).select("depth", "conv", *SUMS), ["depth", "conv"]).groupBy(F.col("mid").alias("depth"), F.col("name").alias("conv")).agg(*[F.sum(c).alias(c) for c in SUMS])
        done.append(saved(plus(below[k], [up]), f"total-{k}"))
    return union(done).select("depth", "conv", *SUMS)


def prefix_trie(symbols: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of sequences.

    ``symbols`` (conv, pos, sym, words) holds the turns, ``convs`` (conv, len) every
    conversation, also those without turns.  Result: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    whole = convs.agg(F.min("conv").alias("root"), F.count(F.lit(1)).alias("n"), F.max("len").alias("len")).first()
    members = cuts(convs, blocks(symbols, int(whole.len).bit_length()), whole.root) if whole.n and whole.len else []
    root = convs.groupBy().agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    named = [root.select(zero.alias("depth"), "conv", F.lit(len(members)).alias("level"), none.alias("lo"), none.alias("start"), "n_convs", none.alias("parent"), zero.alias("words"))]
    reached = [convs.where("len = 0").select(zero.alias("depth"), F.lit(whole.root).cast("long").alias("conv"), F.col("conv").alias("member"))]
    if members:
        nodes = union([m.where("conv = name").select((F.col("lo") + (1 << k)).alias("depth"), "conv", F.lit(k).alias("level"), "lo", "start", "n_convs") for k, m in enumerate(members)])
        above = members[0].where("stands").select(F.col("len").alias("depth"), "conv", F.col("name").alias("above"))  # the node of one turn less
        last = symbols.select("conv", (F.col("pos") + 1).alias("depth"), "words")
        named.append(nodes.join(above, ["depth", "conv"], "left").join(last, ["depth", "conv"]).withColumn("parent", F.coalesce("above", "start")).drop("above"))
        reached += [m.where(~F.col("stands") & (F.col("len") == F.col("lo") + (1 << k))).select(F.col("len").alias("depth"), F.col("name").alias("conv"), F.col("conv").alias("member")) for k, m in enumerate(members)]
    nodes = saved(union(named), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv")).agg(F.count(F.lit(1)).alias("n_children"))
    own = saved(nodes.join(children, ["depth", "conv"], "left").withColumn("n_children", F.coalesce("n_children", zero)).withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")), "own")
    found = own.select("depth", "conv", "parent", "n_convs", "n_children").join(grafted(own, members), ["depth", "conv"]).join(ends(union(reached)), ["depth", "conv"], "left")
    return found.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", *SUMS, F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``conversations``: one row per node of the trie of the rebuilt conversations."""
    lead = F.crc32(F.encode(F.col("conv").cast("string"), "utf-8")) % 4
    return prefix_trie(*rebuilt(turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), 20, lead))


OP11_SQL = r"""
with t as (select conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as sym, turn,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words from conversations where conv_id is not null),
o as (select conv_id, list(sym order by turn nulls first, sym) as s, list(words order by turn nulls first, sym) as w from t group by conv_id),
h as (select *, (xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda c: unicode(c)::bigint), lambda a, b:
    list_reduce(range(8)::bigint[], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(a, b)), 4294967295), 4294967295) % 4)::bigint as h from o),
r as (select a.conv_id, list_concat(coalesce(b.s[1 : a.h], []), a.s[a.h + 1 :]) as s, list_concat(coalesce(b.w[1 : a.h], []), a.w[a.h + 1 :]) as w
    from h a left join h b on b.conv_id = a.conv_id - a.conv_id % 20),
m as (select conv_id, s, w, d, s[1 : d] as k from r, lateral (select unnest(range(len(s) + 1)) as d)),
n as (select k, d, min(conv_id) as conv_id, count(*) as n_convs, case when d > 0 then (count(*) - 1) * min(w[d]) else 0 end as own,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(s) = d), '')) as ends_sha256 from m group by k, d),
c as (select k[1 : d - 1] as k, count(*) as n_children from n where d > 0 group by 1),
f as (select n.*, p.conv_id as parent_conv_id, coalesce(n_children, 0) as n_children from n left join n p on n.d = p.d + 1 and n.k[1 : n.d - 1] = p.k left join c on c.k = n.k),
u as (select k[1 : e] as k, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(own) as saved_tokens
    from f, lateral (select unnest(range(d + 1)) as e) group by 1)
select conv_id, d as depth, parent_conv_id, n_convs, n_children, cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, ends_sha256 from f join u using (k)
"""
