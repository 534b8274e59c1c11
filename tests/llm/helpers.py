"""Small inputs and comparisons for the tests of the llm operators."""

from __future__ import annotations

import os

import duckdb

DATA = "/root/testdata"


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{sf_dir}/{f}')")
    return con


def rows(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def same_as_sql(df, sql: str, sf_dir: str) -> None:
    con = duck(sf_dir)
    want = con.execute(sql).to_arrow_table()
    assert sorted(want.column_names) == sorted(df.columns)
    names = sorted(df.columns)
    assert rows(df) == sorted(zip(*(want.column(n).to_pylist() for n in names)), key=repr)


def documents(spark, texts, ids=None, **more):
    """A documents table of the given texts; ``more`` are columns with one value."""
    ids = list(range(len(texts))) if ids is None else ids
    data = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in zip(ids, texts, strict=True)]
    from pyspark.sql import functions as F

    out = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    return out.withColumns({k: F.lit(v) for k, v in more.items()}) if more else out


def twins(n: int) -> tuple[str, str]:
    """A Thue-Morse word of n letters and its complement: they collide under any polynomial hash modulo 2**64 from 1,024 letters on."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
