"""Incremental gold: equal to the full recompute after every wave, and it reads no more than it must."""

import json
import os
import uuid

import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from docketflow.operators.partials import PARTIALS, bucket_of
from docketflow.schemas import GOLD_COLUMNS
from docketflow.session import new_work_dir
from docketflow.streaming import gold_state as S
from docketflow.streaming import pipeline as P
from docketflow.streaming.registry import land_standin


def _land(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{uuid.uuid4().hex}.json", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows))


def _entry(k, matter, user="U-1", hours=1.5, day="2024-01-10"):
    return {"entry_id": f"T-{k}", "matter_id": matter, "user_id": user, "hours": hours, "billable_flag": True, "rate_usd": 450, "date": day, "narrative": "x"}


def _audit(k, matter, doc, ts="2024-01-10T10:00:00Z"):
    return {"audit_id": f"A-{k}", "doc_id": doc, "matter_id": matter, "action": "view", "user_id": "U-2", "timestamp": ts, "client_ip": "::1"}


def _event(k, matter, kind="opened", office="NYC"):
    return {"event_id": f"E-{k}", "matter_id": matter, "event_type": kind, "timestamp": "2024-01-09T10:00:00Z", "user_id": "U-3", "office": office}


def _matter(m):
    return {"matter_id": m, "client_name": m, "practice_area": "Tax", "region": "NA", "opened_at": "2023-05-01T10:00:00Z", "partner_lead_user_id": "U-0", "billing_arrangement": "hourly"}


def same_as_full(spark, layout, paths):
    """Every incremental gold table against a full recompute into versions of its own."""
    full = P.refresh_gold(spark, layout, "full")
    for name in GOLD_COLUMNS:
        a, b = (spark.read.parquet(p[name]) for p in (paths, full))
        assert a.dtypes == b.dtypes
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


@pytest.fixture(scope="module")
def waves(spark):
    """Three waves over hand-made rows: many matters, then one matter in two facts, then a new dimension row."""
    work = new_work_dir(spark, "waves")
    landing, out = f"{work}/landing", f"{work}/out"
    _land(f"{landing}/time_entries", [_entry(k, f"M-{k % 40}", f"U-{k % 3}", day=f"2024-0{k % 3 + 1}-05") for k in range(200)])
    _land(f"{landing}/doc_audit", [_audit(k, None if k % 9 == 0 else f"M-{k % 40}", f"D-{k % 7}") for k in range(100)])
    _land(f"{landing}/matters", [_event(k, f"M-{k % 40}", office=None if k % 5 == 0 else f"O{k % 4}") for k in range(100)])
    _land(f"{landing}/matters_master", [_matter(f"M-{k}") for k in range(35)])
    runs = []
    for wave in range(3):
        if wave == 1:  # a known entry again, a new one, a known document again under another user
            _land(f"{landing}/time_entries", [_entry(3, "M-3", "U-9"), _entry("new", "M-3", day=None)])
            _land(f"{landing}/doc_audit", [_audit("x", "M-3", "D-3", "2023-01-01T00:00:00Z")])
        if wave == 2:
            _land(f"{landing}/matters_master", [_matter("M-38")])
        P.run_pipeline(spark, landing, out, register=False)  # streams; its full gold is not read here
        layout = P.readable_layout(spark, out)
        runs.append(S.refresh_gold_incremental(spark, layout, f"inc{wave}", buckets=16))
    return layout, runs


def test_every_wave_equals_the_full_recompute(spark, waves):
    layout, runs = waves
    same_as_full(spark, layout, runs[-1].paths)


def test_refresh_reads_new_files_and_touched_buckets_only(spark, waves):
    layout, runs = waves
    first, second, third = runs
    mine = spark.createDataFrame([("M-3",), ("M-38",)], "matter_id string").select(bucket_of(16)).collect()
    assert first.files["silver_time_entries"] is None and len(first.touched["time"]) > 10
    assert len(second.files["silver_time_entries"]) == 1 and second.files["silver_matter_events"] == [] == second.files["silver_matters_master"]
    assert second.touched == {"time": [mine[0][0]], "docs": [mine[0][0]], "events": [], "silver_matters_master": []}
    assert third.touched == {"time": [], "docs": [], "events": [], "silver_matters_master": [mine[1][0]]}
    # only the touched bucket was written again
    assert [c for c in P.list_children(spark, f"{layout.table('state', 'time')}/{second.version}") if c.startswith("bucket=")] == [f"bucket={mine[0][0]}"]
    manifest = {(r.partial, r.bucket): r.version for r in spark.read.parquet(f"{layout.table('state', '_manifest')}/{third.version}").collect()}
    schema = PARTIALS["time"].build(P.read_silver(spark, layout, "silver_time_entries")).schema
    read = S.read_partial(spark, layout, PARTIALS["time"], schema, manifest, [mine[0][0]])
    assert {f.split("/state/time/")[1].split("/bucket")[0] for f in read.inputFiles()} == {second.version}


def test_nothing_new_is_no_new_version(spark, waves):
    layout, runs = waves
    again = S.refresh_gold_incremental(spark, layout, "again")
    assert again.paths == runs[-1].paths and not any(again.touched.values())


def test_refresh_that_died_is_repeated(spark, monkeypatch):
    work = new_work_dir(spark, "died")
    landing, out = f"{work}/landing", f"{work}/out"
    _land(f"{landing}/time_entries", [_entry(k, f"M-{k}") for k in range(5)])
    P.run_pipeline(spark, landing, out, register=False, incremental_gold=True)
    _land(f"{landing}/time_entries", [_entry("b", "M-1"), _entry("c", "M-2")])
    real = S.G.contract

    def fail(df, name):
        if name == "gold_matter_summary":
            raise RuntimeError("lost")
        return real(df, name)

    monkeypatch.setattr(S.G, "contract", fail)
    with pytest.raises(RuntimeError):
        P.run_pipeline(spark, landing, out, run_id="r", register=False, incremental_gold=True)
    monkeypatch.setattr(S.G, "contract", real)
    assert P.read_layer_table(spark, out, "gold_billable_hours_by_matter_month").agg(F.sum("entry_count")).first()[0] == 5
    res = P.run_pipeline(spark, landing, out, run_id="r", register=False, incremental_gold=True)
    assert P.read_layer_table(spark, out, "gold_billable_hours_by_matter_month").agg(F.sum("entry_count")).first()[0] == 7
    same_as_full(spark, res.layout, res.gold_paths)


def test_standin_waves(spark):
    work = new_work_dir(spark, "standin-waves")
    for wave in (1, 2):
        land_standin(spark, SF0001, f"{work}/landing", wave=wave)
        res = P.run_pipeline(spark, f"{work}/landing", f"{work}/out", register=False, incremental_gold=True)
    same_as_full(spark, res.layout, res.gold_paths)
