"""Connected components of a large edge table, and small helpers around written tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.session import new_work_dir


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table written to the cluster's shared folder: cuts the lineage and survives lost executors."""
    path = f"{new_work_dir(df.sparkSession, label)}/t.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node it is linked with.

    Each round maps every node to its smallest neighbour and the edges with it, so that
    the graph shrinks to nothing; the rounds' maps are then chained.  All of them are
    written tables, and only whether an edge is left reaches the driver.
    """
    maps, left = [], edges
    while True:
        left = saved(left.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if maps and left.limit(1).count() == 0:
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = saved(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("comp")), "labels")
        maps.append(step)
        left = left.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    out = maps[0]
    for step in maps[1:]:
        out = out.join(step.toDF("comp", "next"), "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
    return saved(out, "components")


class Joined:
    """Union-find over the rows of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.parts = n

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, x: int, others) -> None:
        for y in others:
            a, b = self.root(x), self.root(int(y))
            if a != b:
                self.up[max(a, b)] = min(a, b)
                self.parts -= 1

    def stars(self) -> list[tuple[int, int]]:
        return [(r, x) for x in range(len(self.up)) if (r := self.root(x)) != x]


def linked(ok: np.ndarray) -> list[tuple[int, int]]:
    """A spanning set of links of a symmetric boolean matrix."""
    found = Joined(len(ok))
    for x in range(len(ok)):
        found.link(x, np.flatnonzero(ok[x, x + 1 :]) + x + 1)
        if found.parts == 1:
            break
    return found.stars()
