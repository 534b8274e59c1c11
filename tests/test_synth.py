"""Synthetic landing data: reproducible, in range, and its bad rows are exactly what silver drops."""

import os

import pytest
from pyspark.sql import functions as F

from docketflow.session import new_work_dir
from docketflow.sources import synth as S
from docketflow.streaming.pipeline import run_pipeline


def test_config_validation():
    with pytest.raises(ValueError):
        S.SynthConfig(bad_data_pct=0.6)


def test_pools_and_dimension(spark):
    m = S.matters_master(spark, S.SynthConfig()).collect()
    assert len(m) == 200
    assert all(r.matter_id[:2] == "M-" and len(r.matter_id) == 12 for r in m)
    assert len({r.matter_id for r in m}) == 200
    assert {r.practice_area for r in m} <= {"M&A", "Litigation", "IP", "Real Estate", "Employment", "Tax",
                                           "Regulatory"}
    assert {r.partner_lead_user_id for r in m} <= {f"U-{i:04d}" for i in range(10)}


def test_deterministic_per_batch(spark):
    cfg = S.SynthConfig()
    a = S.time_entries(spark, cfg, "b1").collect()
    b = S.time_entries(spark, cfg, "b1").collect()
    c = S.time_entries(spark, cfg, "b2").collect()
    assert a == b and a != c


def test_ranges(spark):
    cfg = S.SynthConfig(bad_data_pct=0.0, files_per_source=3)
    te = S.time_entries(spark, cfg, "r")
    assert te.rdd.getNumPartitions() == 3
    per_file = te.groupBy(F.spark_partition_id()).count().collect()
    assert all(80 <= r["count"] <= 500 for r in per_file)
    stats = te.agg(F.min("hours").alias("lo"), F.max("hours").alias("hi"),
                   F.avg(F.col("billable_flag").cast("double")).alias("b")).collect()[0]
    assert 0.1 <= stats.lo and stats.hi <= 8.0 and 0.75 < stats.b < 0.95
    assert {r.rate_usd for r in te.select("rate_usd").distinct().collect()} <= {250, 350, 450, 600, 850, 1100}
    ev = S.matter_events(spark, cfg, "r")
    assert {r.event_type for r in ev.select("event_type").distinct().collect()} <= {
        "opened", "status_change", "note_added", "closed"}
    da = S.doc_audit(spark, cfg, "r")
    assert {r.action for r in da.select("action").distinct().collect()} <= {"view", "edit", "share", "download",
                                                                           "delete"}


def test_injected_bad_rows_are_the_dropped_rows(spark):
    cfg = S.SynthConfig(bad_data_pct=0.2, files_per_source=4)
    work = new_work_dir(spark, "synth")
    S.land_synthetic(spark, f"{work}/landing", cfg, batch_id="t1")
    files = [f for f in os.listdir(f"{work}/landing/time_entries") if f.endswith(".json")]
    assert len(files) == 4
    res = run_pipeline(spark, f"{work}/landing", f"{work}/out", register=False)
    te = S.time_entries(spark, cfg, "t1")
    good_te = te.filter((F.col("hours") > 0) & (F.col("hours") <= 24) & F.col("user_id").isNotNull()).count()
    ev = S.matter_events(spark, cfg, "t1")
    good_ev = ev.filter(F.col("event_type").isin("opened", "status_change", "note_added", "closed")
                        & F.col("matter_id").isNotNull()).count()
    from docketflow.plans.layers import TableLayers

    lay = TableLayers(spark, f"{work}/out")
    assert lay.silver("silver_time_entries").count() == good_te
    assert lay.silver("silver_matter_events").count() == good_ev
    assert good_te < te.count() and good_ev < ev.count()
    dropped = {(d, r): f for _, d, r, _, n, f in res.metrics}
    assert dropped[("silver_doc_audit", "valid_action")] == S.doc_audit(spark, cfg, "t1").filter(
        ~F.col("action").isin("view", "edit", "share", "download", "delete")).count()
