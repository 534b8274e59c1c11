"""Windowed streaming aggregate and rejected rows through the real streams."""

import json
import os
import uuid

import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from docketflow.schemas import SOURCES
from docketflow.session import new_work_dir
from docketflow.streaming import pipeline as P
from docketflow.streaming import windows as W
from docketflow.streaming.registry import land_standin


def _land(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{uuid.uuid4().hex}.json", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows))


def _audit(k, ts, doc=None, action="view"):
    return {"audit_id": f"A-{k}", "doc_id": doc or f"D-{k}", "matter_id": "M-1", "action": action, "user_id": "U-1", "timestamp": ts, "client_ip": "::1"}


def _wave(spark, landing, layout, rows):
    _land(f"{landing}/doc_audit", rows)
    P._run_source(spark, landing, layout, "doc_audit", P.new_run_id(), None, P.LANDING_RETENTION_DAYS)
    return W.run_daily_doc_activity(spark, layout)


def test_days_close_once_and_late_rows_are_counted(spark):
    work = new_work_dir(spark, "days")
    layout = P.current_layout(spark, f"{work}/out", run_id="r")
    n = 3000
    _wave(spark, f"{work}/landing", layout, [_audit(k, f"2024-01-01T{k % 24:02d}:00:00Z", f"D-{k % 1000}") for k in range(n)] + [_audit("y", "2024-01-04T12:00:00Z")])
    first = {(str(r.day), r.action): r for r in W.read_daily_doc_activity(spark, layout).collect()}
    assert {k: v.n_events for k, v in first.items()} == {("2024-01-01", "view"): n}  # the 4th less two days: the 1st is closed
    assert abs(first["2024-01-01", "view"].approx_docs - 1000) <= 50  # four standard errors
    # the 1st is closed: late; the 3rd is open: counted; the 9th closes the 3rd and the 4th
    _wave(spark, f"{work}/landing", layout, [_audit("late", "2024-01-01T05:00:00Z"), _audit("late2", "2024-01-01T05:00:00Z", action="edit"), _audit("ok", "2024-01-03T05:00:00Z"), _audit("z", "2024-01-09T00:00:00Z")])
    got = {(str(r.day), r.action): (r.n_events, r.n_late) for r in W.late_rows(P.read_silver(spark, layout, "silver_doc_audit"), W.read_daily_doc_activity(spark, layout)).collect()}
    assert got == {("2024-01-01", "view"): (n, 1), ("2024-01-01", "edit"): (0, 1), ("2024-01-03", "view"): (1, 0), ("2024-01-04", "view"): (1, 0)}


def test_batch_form_equals_exact_counts(spark):
    rows = spark.createDataFrame([(f"2024-01-0{1 + k % 3} 10:00:00", "view", f"D-{k % 50}") for k in range(300)], "t string, action string, doc_id string").withColumn("audit_ts", F.to_timestamp("t"))
    got = W.daily_doc_activity(rows).select("day", "n_events", F.hll_sketch_estimate("docs_sketch").alias("docs")).collect()
    assert {(str(r.day), r.n_events, r.docs) for r in got} == {(f"2024-01-0{d}", 100, 50) for d in (1, 2, 3)}


def _balanced(spark, layout):
    for source, (bronze, silver) in SOURCES.items():
        kept, refused = P.read_silver(spark, layout, silver).count(), P.read_rejected(spark, layout, silver)
        assert kept + refused.count() == P.read_bronze(spark, layout, bronze).count() > 0
        assert refused.where("size(_failed_rules) = 0").count() == 0


def test_silver_and_rejected_rows_are_bronze_also_after_a_crash(spark, monkeypatch):
    work = new_work_dir(spark, "refused")
    land_standin(spark, SF0001, f"{work}/landing", wave=1)
    real = P.run_rejected

    def fail(spark, layout, source, *more):
        if source == "time_entries":
            raise RuntimeError("lost between the two")
        return real(spark, layout, source, *more)

    monkeypatch.setattr(P, "run_rejected", fail)
    with pytest.raises(RuntimeError):
        P.run_pipeline(spark, f"{work}/landing", f"{work}/out", register=False, keep_rejected=True)
    monkeypatch.setattr(P, "run_rejected", real)
    land_standin(spark, SF0001, f"{work}/landing", wave=2)
    res = P.run_pipeline(spark, f"{work}/landing", f"{work}/out", register=False, keep_rejected=True)
    _balanced(spark, res.layout)
    rules = P.read_rejected(spark, res.layout, "silver_time_entries").select(F.explode("_failed_rules").alias("r")).distinct().collect()
    assert {r.r for r in rules} == {"positive_hours", "has_matter"}  # the only ones that fail at this scale
