"""Spark result vs DuckDB oracle: column names, row count, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from docketflow.sources.tables import TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    cols = {n: table.column(n).to_pylist() for n in names}
    rows = [tuple(_norm(cols[n][i]) for n in names) for i in range(table.num_rows)]
    return names, sorted(rows, key=repr)


def compare(spark, key: str, sf_dir: str, spark_df=None, sql: str | None = None, con=None) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    df = spark_df if spark_df is not None else queries()[key](spark, sf_dir)
    sql = sql or oracle_sql()[key]
    con = con or duck_connect(sf_dir)
    s_names, s_rows = _rows(df.toArrow())
    d_names, d_rows = _rows(con.execute(sql).to_arrow_table())
    if s_names != d_names:
        return False, f"columns differ: spark={s_names} duck={d_names}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    if s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"
