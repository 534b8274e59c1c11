"""What queries write and shuffle: landed files are small and many, layers compressed, kept partials shuffled once."""

import gzip
import os
import re
import zlib

import pytest
from conftest import SF0001

from docketflow.operators import gold as G
from docketflow.operators.partials import DOCS, EVENTS, TIME, bucket_of
from docketflow.session import new_work_dir
from docketflow.sources import landing as L
from docketflow.streaming import pipeline as P
from docketflow.streaming import registry as R


def _names(path):
    path = path.removeprefix("file:")
    return [n for n in os.listdir(path) if n.startswith("part-")]


def test_landed_and_layer_files_are_compressed(spark):
    work = new_work_dir(spark, "volume")
    R.land_standin(spark, SF0001, f"{work}/landing")
    layout = P.current_layout(spark, f"{work}/out", run_id="r")
    for source, (bronze, silver) in P.SOURCES.items():
        landed = _names(f"{work}/landing/{source}")
        assert landed and all(n.endswith(".json.gz") for n in landed)
        P._run_source(spark, f"{work}/landing", layout, source, "r", None, P.LANDING_RETENTION_DAYS)
        assert P.read_bronze(spark, layout, bronze).count() == R.standin_source(spark, SF0001, source, lineage=False).count()
        for layer, name in (("bronze", bronze), ("silver", silver)):
            assert all(n.endswith(".zstd.parquet") for n in _names(layout.table(layer, name)))


@pytest.mark.parametrize("source", ["matters", "time_entries", "doc_audit"])
def test_landed_files_grow_with_the_rows(spark, monkeypatch, source):
    """Several files of few rows, more than the four asked for at least where the rows are many."""
    rows = R.standin_source(spark, SF0001, source, lineage=False).count()
    few, many = (f"{new_work_dir(spark, 'few')}/landing" for _ in range(2))
    R._land_source(spark, SF0001, few, source, at_least=4)
    assert len(_names(f"{few}/{source}")) >= 4
    monkeypatch.setattr(L, "MAX_RECORDS_COMPRESSED", rows // 10)
    R._land_source(spark, SF0001, many, source, at_least=4)
    assert len(_names(f"{many}/{source}")) >= 10


DAY, TS = "to_date('2024-01-05')", "timestamp'2024-01-01 00:00:00'"


@pytest.mark.parametrize("partial,cols", [
    (TIME, ["concat('M-', id % 7) matter_id", "to_date('2024-01-01') entry_month", "concat('U-', id % 3) user_id", "concat('T-', id % 400) entry_id",
            "cast(1 AS decimal(15,2)) hours", "cast(2 AS decimal(22,2)) amount", f"{DAY} last_date"]),
    (DOCS, ["if(id % 9 = 0, null, 'M-HOT') matter_id", "'view' action", "if(id % 5 = 0, null, concat('D-', id % 400)) doc_id", "concat('U-', id % 3) user_id",
            "1L n", f"{TS} first_ts", f"{TS} last_ts"]),
    (EVENTS, ["concat('M-', id % 7) matter_id", f"{TS} first_event_ts", f"{TS} last_event_ts", "1L total_events", "1L opened_events", "0L closed_events",
              "array('NYC') offices_touched"]),
])
def test_merge_by_bucket(spark, partial, cols):
    """The rows of ``merge`` with their bucket; where rows hardly shrink, one shuffle that spreads a hot matter."""
    rows, more = spark.range(0, 1000, 1, 3).selectExpr(*cols), spark.range(100, 150).selectExpr(*cols)
    got, want = partial.merge_by_bucket([rows, more], 8), partial.merge([rows, more])
    assert got.drop("bucket").exceptAll(want.select(*got.drop("bucket").columns)).count() == 0 and got.count() == want.count()
    assert got.where(got.bucket != bucket_of(8)).count() == 0
    if partial.counted:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "hashpartitioning(bucket" in plan


def _plan(df, how="simple"):
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), how)


def test_landed_files_are_smaller_than_at_best_speed(spark):
    work = new_work_dir(spark, "small")
    R._land_source(spark, SF0001, f"{work}/landing", "time_entries")
    folder = f"{work}/landing/time_entries".removeprefix("file:")
    packed = [open(f"{folder}/{n}", "rb").read() for n in _names(folder)]
    assert sum(map(len, packed)) < 0.9 * sum(len(zlib.compress(gzip.decompress(b), 1)) for b in packed)


def test_entries_are_shaped_before_the_join(spark):
    """No price or time of a line is shuffled, only what follows from it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(R.standin_source(spark, SF0001, "time_entries", lineage=False), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(shuffled) == 2 and any("l_linenumber" in s for s in shuffled)
    assert not re.search("l_extendedprice|l_quantity|l_shipdate|l_returnflag|l_suppkey", " ".join(shuffled))


ENTRIES = [
    "if(id % 50 = 0, null, if(id % 3 = 0, 'M-HOT', concat('M-', id % 9))) matter_id", "if(id % 11 = 0, null, concat('U-', id % 7 % 5)) user_id",
    "if(id % 13 = 0, null, concat('T-', id % 180)) entry_id", "cast(id % 8 + 0.25 AS decimal(5,2)) hours",
    "if(id % 4 = 1, null, cast(id AS decimal(12,2))) billable_amount_usd",
    "if(id % 17 = 0, null, date_add(date'2024-01-05', cast(id * 37 % 200 AS int))) entry_date", "if(id % 19 = 0, null, id % 5 > 0) billable_flag",
]


@pytest.mark.parametrize("frequent", [[], ["M-HOT", "M-4"], None])
def test_monthly_and_revenue_from_rows_by_month(spark, frequent):
    """Rows with NULLs and repeats give what the plain aggregates give, whichever matters are spread; the others are shuffled once."""
    rows = spark.range(0, 2000, 1, 5).selectExpr(*ENTRIES)
    frequent = G.frequent_matters(rows) if frequent is None else frequent
    by_month = G.billable_by_month(rows, frequent)
    monthly = G.contract(G.billable_hours_from(by_month, rows, frequent), "gold_billable_hours_by_matter_month")
    for got, want in ((monthly, G.billable_hours_by_matter_month(rows)), (G.summary_revenue_from(by_month), G.summary_revenue(rows))):
        want = want.select(*got.columns)
        assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    if not frequent:
        shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", _plan(by_month))
        assert len(shuffles) == 4 and sum(bool(re.fullmatch(r"matter_id#\d+", keys)) for keys in shuffles) == 1, shuffles


def test_frequent_matters(spark):
    rows = spark.range(20_000).selectExpr("if(id % 2 = 0, 'M-HOT', concat('M-', id)) matter_id", "true billable_flag")
    assert "M-HOT" in G.frequent_matters(rows) and len(G.frequent_matters(rows)) <= G.FREQUENT
    assert G.frequent_matters(rows.where("matter_id is null")) == []
