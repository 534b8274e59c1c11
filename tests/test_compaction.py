"""Clustered copies of silver: the same rows, most files left out, readers undisturbed."""

import datetime as dt

import pytest
from conftest import SF0001

from docketflow.plans.questions import doc_events_last_week
from docketflow.session import new_work_dir
from docketflow.sources.landing import land_json_batch
from docketflow.sources.standin import standin_source
from docketflow.streaming import compaction as C
from docketflow.streaming import pipeline as P

NAME = "silver_doc_audit"


@pytest.fixture(scope="module")
def compacted(spark):
    work = new_work_dir(spark, "compacted")
    layout = P.current_layout(spark, f"{work}/out", run_id="r")

    def wave(condition):
        land_json_batch(standin_source(spark, SF0001, "doc_audit", lineage=False).where(condition), f"{work}/landing", "doc_audit")
        P._run_source(spark, f"{work}/landing", layout, "doc_audit", P.new_run_id(), None, P.LANDING_RETENTION_DAYS)

    wave("audit_id not like '%7'")
    before = P.read_silver(spark, layout, NAME)  # a reader from before the compaction
    rows = before.count()
    C.compact_silver(spark, layout, NAME, "c1", target_bytes=2000)
    return layout, wave, before, rows


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_same_rows_and_files_left_out(spark, compacted):
    layout, _, before, rows = compacted
    silver = P.read_silver(spark, layout, NAME)
    assert before.count() == rows == silver.count()
    whole = C.read_compacted(spark, layout, NAME)
    n = len(whole.inputFiles())
    assert n >= 8 and same(whole, silver)
    matter = silver.where("matter_id is not null").first().matter_id
    one = C.read_compacted(spark, layout, NAME, matter_id=matter)
    assert same(one, silver.where(silver.matter_id == matter)) and one.count() > 0
    assert len(one.inputFiles()) <= n // 3
    since, until = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 17)
    week = C.read_compacted(spark, layout, NAME, since=since, before=until)
    assert same(week, silver.where((silver.audit_ts >= since) & (silver.audit_ts < until)))
    few = C.read_compacted(spark, layout, NAME, matter_id=matter, before=dt.datetime(1990, 1, 1))
    assert few.count() == 0 and few.inputFiles() == []
    assert same(doc_events_last_week(C.read_compacted(spark, layout, NAME)), doc_events_last_week(silver))


def test_later_files_and_dead_compactions(spark, compacted, monkeypatch):
    layout, wave, _, rows = compacted
    wave("audit_id like '%7'")
    silver = P.read_silver(spark, layout, NAME)
    assert silver.count() > rows and same(C.read_compacted(spark, layout, NAME), silver)
    # a compaction that dies before its manifest is never read; the next one has another number
    version = C.compacted_version(spark, layout, NAME)
    spark.range(1).write.parquet(f"{layout.table('compact', NAME)}/data/v=000002-dead")
    assert C.compacted_version(spark, layout, NAME) == version
    assert C.compact_silver(spark, layout, NAME, "c3", target_bytes=2000).startswith("v=000003")
    assert same(C.read_compacted(spark, layout, NAME), silver)


def test_time_range_leaves_out_months(spark):
    """Over years, a file holds few months: one month's rows are in a few files."""
    work = new_work_dir(spark, "months")
    layout = P.current_layout(spark, f"{work}/out", run_id="r")
    land_json_batch(standin_source(spark, SF0001, "time_entries", lineage=False), f"{work}/landing", "time_entries")
    P._run_source(spark, f"{work}/landing", layout, "time_entries", "r", None, P.LANDING_RETENTION_DAYS)
    C.compact_silver(spark, layout, "silver_time_entries", "c", target_bytes=2000)
    whole = C.read_compacted(spark, layout, "silver_time_entries")
    month = C.read_compacted(spark, layout, "silver_time_entries", since=dt.datetime(1995, 3, 1), before=dt.datetime(1995, 4, 1))
    assert month.count() == whole.where("entry_date >= '1995-03-01' and entry_date < '1995-04-01'").count() > 0
    assert len(whole.inputFiles()) >= 12 and len(month.inputFiles()) <= len(whole.inputFiles()) // 4


def test_rows_bound_a_file(spark):
    """Few bytes of silver may be many rows: files hold a bounded number, also of one matter and time."""
    work = new_work_dir(spark, "rows")
    layout = P.current_layout(spark, f"{work}/out", run_id="r")
    raw = spark.range(0, 2000, 1, 2).selectExpr(
        "concat('T-', id) AS entry_id", "'M-1' AS matter_id", "'U-1' AS user_id", "1.5D AS hours", "true AS billable_flag",
        "100L AS rate_usd", "'2024-01-05' AS date", "'x' AS narrative")
    land_json_batch(raw, f"{work}/landing", "time_entries")
    P._run_source(spark, f"{work}/landing", layout, "time_entries", "r", None, P.LANDING_RETENTION_DAYS)
    C.compact_silver(spark, layout, "silver_time_entries", "c", target_rows=200)
    files = C.read_compacted(spark, layout, "silver_time_entries").selectExpr("_metadata.file_path AS f").groupBy("f").count().collect()
    assert sum(r["count"] for r in files) == 2000 and len(files) >= 8 and max(r["count"] for r in files) < 500
