"""Landing fixtures through the real bronze -> silver -> gold streams."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from docketflow.plans.layers import TableLayers
from docketflow.session import new_work_dir
from docketflow.streaming.pipeline import read_layer_table, read_metrics, run_pipeline


def _line(**kw):
    base = {"entry_id": "T-a", "matter_id": "M-1", "user_id": "U-1", "hours": 2.5, "billable_flag": True,
            "rate_usd": 450, "date": "2024-01-10", "narrative": "ok"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


FIXTURE_LINES = {
    "a_clean": _line(entry_id="T-a"),
    "b_negative_hours": _line(entry_id="T-b", hours=-1.5),
    "c_string_hours_unknown_field": _line(entry_id="T-c", hours="abc", surprise=1),
    "d_broken_json": _line(entry_id="T-d")[:-5],
    "e_null_user": _line(entry_id="T-e", user_id=None),
    "f_hours_1000": _line(entry_id="T-f", hours=1000),
    "g_bad_date": _line(entry_id="T-g", date="2024-02-31x"),
    "h_repeat_1": _line(entry_id="T-h", hours=1.0),
    "h_repeat_2": _line(entry_id="T-h", hours=2.0),
    "j_decimal_rate": _line(entry_id="T-j1", rate_usd=250.7),
    "j_string_hours": _line(entry_id="T-j2", hours="3.5"),
    "k_wrong_case_key": _line(entry_id=..., ENTRY_ID="T-k"),
    "l_duplicate_key": '{"entry_id":"T-l","entry_id":"T-l2","matter_id":"M-1","user_id":"U-1","hours":1.0}',
    "m_top_level_array": "[" + _line(entry_id="T-m") + "]",
    "n_blank": "   ",
    "o_object_for_string": _line(entry_id="T-o", narrative={"text": "x"}),
    "p_huge_number": _line(entry_id="T-p").replace('"hours": 2.5', '"hours": 1e400'),
}

MASTER = [{"matter_id": "M-1", "client_name": "Acme", "practice_area": "Tax", "region": "NA",
           "opened_at": "2023-05-01T10:00:00+02:00", "partner_lead_user_id": "U-0", "billing_arrangement": "hourly"},
          {"matter_id": "M-2", "client_name": "Bolt", "practice_area": "Astrology", "region": "EMEA",
           "opened_at": "not a time", "partner_lead_user_id": "U-1", "billing_arrangement": "retainer"}]


def _write(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{uuid.uuid4().hex}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def landed(spark):
    work = new_work_dir(spark, "fixtures")
    landing, out = f"{work}/landing", f"{work}/out"
    _write(f"{landing}/time_entries", list(FIXTURE_LINES.values()))
    _write(f"{landing}/matters_master", [json.dumps(m) for m in MASTER])
    first = run_pipeline(spark, landing, out, register=False)
    return work, landing, out, first


def test_bronze_keeps_every_nonblank_line(spark, landed):
    _, _, out, first = landed
    bronze = read_layer_table(spark, out, "bronze_time_entries")
    assert bronze.count() == len(FIXTURE_LINES) - 1
    assert first.bronze_input_lines["bronze_time_entries"] == len(FIXTURE_LINES)  # blank line read, not kept
    assert bronze.filter(F.col("_source_file").isNull() | F.col("_ingested_at").isNull()).count() == 0


def test_rescue_column(spark, landed):
    _, _, out, _ = landed
    b = {r.entry_id: r for r in read_layer_table(spark, out, "bronze_time_entries").collect() if r.entry_id}
    assert b["T-a"]._rescued_data is None
    assert b["T-c"].hours is None and json.loads(b["T-c"]._rescued_data) == {"hours": "abc", "surprise": 1}
    assert b["T-j1"].rate_usd is None and json.loads(b["T-j1"]._rescued_data) == {"rate_usd": 250.7}
    assert b["T-j2"].hours is None and json.loads(b["T-j2"]._rescued_data) == {"hours": "3.5"}
    assert b["T-e"].user_id is None and b["T-e"]._rescued_data is None
    assert b["T-o"].narrative is None and json.loads(b["T-o"]._rescued_data) == {"narrative": {"text": "x"}}
    assert b["T-p"].hours is None and "hours" in b["T-p"]._rescued_data  # beyond a double's range
    rows = read_layer_table(spark, out, "bronze_time_entries").collect()
    whole = [r._rescued_data for r in rows if r.entry_id is None]
    # wrong-case key keeps the line parsed; broken, duplicate-key and array lines are rescued whole
    assert any(w and '"ENTRY_ID"' in w and w.startswith('{"ENTRY_ID"') for w in whole)
    assert any(w and w.startswith("[") for w in whole)
    assert sum(1 for w in whole if w and '"T-l2"' in w) == 1
    assert sum(1 for w in whole if w and '"T-d"' in w) == 1


def test_silver_rules(spark, landed):
    _, _, out, first = landed
    s = {r.entry_id: r for r in TableLayers(spark, out).silver("silver_time_entries").collect()}
    assert set(s) == {"T-a", "T-g", "T-h", "T-j1", "T-o", None}
    assert s["T-g"].entry_date is None
    assert s["T-j1"].rate_tier == "unknown" and s["T-j1"].billable_amount_usd is None
    assert str(s["T-a"].billable_amount_usd) == "1125.00" and s["T-a"].rate_tier == "associate"
    m = {(d, r): f for _, d, r, _, _, f in first.metrics}
    assert m[("silver_time_entries", "positive_hours")] == 8  # b c d f j2 l m p
    assert m[("silver_time_entries", "has_user")] == 4        # d e l m
    assert m[("silver_matters_master", "known_practice_area")] == 1


def test_dimension_and_gold(spark, landed):
    _, _, out, _ = landed
    lay = TableLayers(spark, out)
    dim = {r.matter_id: r for r in lay.silver("silver_matters_master").collect()}
    assert str(dim["M-1"].opened_ts) == "2023-05-01 08:00:00" and dim["M-2"].opened_ts is None
    monthly = lay.gold("gold_billable_hours_by_matter_month").collect()
    h = [r for r in monthly if r.entry_month is not None and str(r.entry_month) == "2024-01-01"][0]
    assert h.entry_count == 4  # T-a, T-h (twice, counted once), T-j1, T-o -> distinct ids among 5 rows
    summary = {r.matter_id: r for r in lay.gold("gold_matter_summary").collect()}
    assert summary["M-2"].total_billable_hours == 0 and summary["M-2"].last_billed_date is None
    assert summary["M-2"].is_closed is False


def test_incremental_second_file_and_noop_restart(spark, landed):
    _, landing, out, first = landed
    _write(f"{landing}/time_entries", [_line(entry_id="T-i1"), _line(entry_id="T-i2", hours=-3)])
    second = run_pipeline(spark, landing, out, register=False)
    assert second.bronze_input_lines["bronze_time_entries"] == 2
    assert read_layer_table(spark, out, "bronze_time_entries").count() == len(FIXTURE_LINES) + 1
    ids = {r.entry_id for r in TableLayers(spark, out).silver("silver_time_entries").collect()}
    assert "T-i1" in ids and "T-i2" not in ids
    third = run_pipeline(spark, landing, out, register=False)
    assert third.bronze_input_lines["bronze_time_entries"] == 0
    assert read_layer_table(spark, out, "bronze_time_entries").count() == len(FIXTURE_LINES) + 1
    metrics = read_metrics(spark, out)
    # counters belong to micro-batches: the run without new files has none
    assert {r.run_id for r in metrics.select("run_id").distinct().collect()} == {first.run_id, second.run_id}


def test_full_refresh_replays_everything(spark, landed):
    _, landing, out, _ = landed
    before = TableLayers(spark, out).gold("gold_billable_hours_by_matter_month")
    rows_before = sorted(map(tuple, before.collect()), key=repr)
    refreshed = run_pipeline(spark, landing, out, full_refresh=True, register=False)
    assert refreshed.bronze_input_lines["bronze_time_entries"] == len(FIXTURE_LINES) + 2
    after = TableLayers(spark, out).gold("gold_billable_hours_by_matter_month")
    assert sorted(map(tuple, after.collect()), key=repr) == rows_before


def test_readers_skip_uncommitted_versions_and_generations(spark, landed):
    """A half-written gold version or an unfinished generation is never read."""
    from docketflow.streaming.pipeline import readable_layout

    _, _, out, _ = landed
    layout = readable_layout(spark, out)
    good = read_layer_table(spark, out, "gold_matter_summary").count()
    # a newer gold version without the committer's _SUCCESS marker (e.g. a crashed refresh)
    os.makedirs(f"{layout.table('gold', 'gold_matter_summary')}/v=99999999T999999999999/_temporary")
    assert read_layer_table(spark, out, "gold_matter_summary").count() == good
    # a refresh that committed only some tables is not read either (snapshot across gold tables)
    before = read_layer_table(spark, out, "gold_matter_lifecycle").count()
    partial = f"{layout.table('gold', 'gold_matter_lifecycle')}/v=99999999T999999999999"
    os.makedirs(partial)
    open(f"{partial}/_SUCCESS", "w").close()  # committed, but empty and alone in its refresh
    assert read_layer_table(spark, out, "gold_matter_lifecycle").count() == before
    assert read_layer_table(spark, out, "gold_matter_summary").count() == good
    # a newer generation that never completed (e.g. a crashed full refresh)
    os.makedirs(f"{out}/gen=99999999T999999999999/silver")
    assert readable_layout(spark, out).generation == layout.generation


def test_rescue_query_keeps_every_entry(spark):
    from conftest import SF0001
    from docketflow.sources.standin import time_entries
    from docketflow.streaming.registry import rescue_json_query

    out = rescue_json_query(spark, SF0001)
    assert out.count() == time_entries(spark, SF0001).count()
    clean = out.filter(F.col("_rescued_data").isNull())
    assert 0 < clean.count() < out.count()
    assert out.filter(F.col("_rescued_data").isNotNull() & F.col("entry_id").isNotNull()).count() > 0


def test_bounded_micro_batches_give_same_result(spark):
    """Many small micro-batches: same silver rows and the same summed counters as one batch."""
    from conftest import SF0001
    from docketflow.streaming.registry import land_standin

    work = new_work_dir(spark, "bounded")
    land_standin(spark, SF0001, f"{work}/landing", files_per_source=5)
    one = run_pipeline(spark, f"{work}/landing", f"{work}/one", register=False)
    many = run_pipeline(spark, f"{work}/landing", f"{work}/many", register=False, max_files_per_trigger=1)
    assert sorted(one.metrics, key=lambda r: r[1:3]) != [] and \
        sorted(m[1:] for m in one.metrics) == sorted(m[1:] for m in many.metrics)
    a = TableLayers(spark, f"{work}/one").gold("gold_matter_summary")
    b = TableLayers(spark, f"{work}/many").gold("gold_matter_summary")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _age(path, days):
    import time

    for f in os.listdir(path):
        os.utime(os.path.join(path, f), (time.time() - days * 86_400,) * 2)


def test_older_file_that_lands_later_is_read(spark):
    work = new_work_dir(spark, "older")
    landing, out = f"{work}/landing", f"{work}/out"
    _write(f"{landing}/time_entries", [_line(entry_id="T-new")])
    run_pipeline(spark, landing, out, register=False)
    _write(f"{work}/copy", [_line(entry_id="T-old1"), _line(entry_id="T-old2")])
    _age(f"{work}/copy", 40)
    for f in os.listdir(f"{work}/copy"):
        os.rename(f"{work}/copy/{f}", f"{landing}/time_entries/{f}")
    run_pipeline(spark, landing, out, register=False)
    assert {r.entry_id for r in TableLayers(spark, out).silver("silver_time_entries").collect()} == {"T-new", "T-old1", "T-old2"}
    with pytest.raises(ValueError, match="retention"):
        run_pipeline(spark, landing, f"{work}/short", register=False, retention_days=30)


def test_old_file_that_was_read_does_not_stop_later_runs(spark):
    """Retention compares unseen files only: a file read long ago may lie as far back as it likes."""
    work = new_work_dir(spark, "retained")
    landing, out = f"{work}/landing", f"{work}/out"
    _write(f"{landing}/time_entries", [_line(entry_id="T-old")])
    _age(f"{landing}/time_entries", 40)
    run_pipeline(spark, landing, out, register=False, retention_days=30)
    _write(f"{landing}/time_entries", [_line(entry_id="T-new")])
    run_pipeline(spark, landing, out, register=False, retention_days=30)
    assert {r.entry_id for r in TableLayers(spark, out).silver("silver_time_entries").collect()} == {"T-old", "T-new"}
    _write(f"{work}/copy", [_line(entry_id="T-unseen")])
    _age(f"{work}/copy", 40)
    for f in os.listdir(f"{work}/copy"):
        os.rename(f"{work}/copy/{f}", f"{landing}/time_entries/{f}")
    with pytest.raises(ValueError, match="retention"):
        run_pipeline(spark, landing, out, register=False, retention_days=30)


def test_failed_gold_refresh_loses_no_counters(spark, monkeypatch):
    from docketflow.streaming import pipeline as P

    work = new_work_dir(spark, "failing")
    landing, out = f"{work}/landing", f"{work}/out"
    _write(f"{landing}/time_entries", [_line(entry_id="T-1"), _line(entry_id="T-2", hours=-1)])

    def fail(*_, **__):
        raise RuntimeError("no gold")

    real, record = P.refresh_gold, P.record_metrics
    # the run fails before the counters are stored: the next one counts the batch again
    monkeypatch.setattr(P, "record_metrics", fail)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, landing, out, register=False)
    monkeypatch.setattr(P, "record_metrics", record)
    _write(f"{landing}/time_entries", [_line(entry_id="T-3", hours=-1)])
    monkeypatch.setattr(P, "refresh_gold", fail)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, landing, out, register=False)
    monkeypatch.setattr(P, "refresh_gold", real)
    run_pipeline(spark, landing, out, register=False)
    total = read_metrics(spark, out).where("rule = 'positive_hours'").agg(F.sum("n_rows"), F.sum("n_failed")).first()
    assert tuple(total) == (3, 2)


def test_gold_follows_commit_order_not_names(spark):
    work = new_work_dir(spark, "names")
    landing, out = f"{work}/landing", f"{work}/out"
    for run_id in ("run-9", "run-10", "run-10"):
        _write(f"{landing}/time_entries", [_line(entry_id=f"T-{uuid.uuid4().hex}")])
        run_pipeline(spark, landing, out, run_id=run_id, register=False)
    assert [r.entry_count for r in TableLayers(spark, out).gold("gold_billable_hours_by_matter_month").collect()] == [3]
    assert len(os.listdir(f"{out.removeprefix('file:')}/{os.listdir(out.removeprefix('file:'))[0]}/gold/gold_matter_summary")) == 3


def test_default_run_with_two_sources_registers_what_exists(spark):
    work = new_work_dir(spark, "two")
    landing = f"{work}/landing"
    _write(f"{landing}/time_entries", [_line()])
    _write(f"{landing}/matters_master", [json.dumps(m) for m in MASTER])
    database = "two_" + uuid.uuid4().hex[:8]
    run_pipeline(spark, landing, f"{work}/out", database=database)
    assert {t.name for t in spark.catalog.listTables(database)} >= {"bronze_time_entries", "silver_time_entries", "gold_matter_summary"}
    assert read_layer_table(spark, f"{work}/out", "bronze_doc_audit").count() == 0


def test_crashed_dimension_write_is_repeated(spark):
    from docketflow.sources.landing import land_master_once

    landing = f"{new_work_dir(spark, 'crashed')}/landing"
    os.makedirs(f"{landing}/matters_master/_temporary")
    df = spark.createDataFrame([(m["matter_id"],) for m in MASTER], "matter_id string")
    land_master_once(df, landing)
    land_master_once(df.limit(1), landing)
    assert spark.read.json(f"{landing}/matters_master").count() == 2


def test_refuses_other_time_zones(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run_pipeline(spark, "/none", "/none")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_counters_of_more_batches_than_spark_keeps(spark):
    """Spark purges commits and progress after 100 micro-batches; every batch has its counters all the same."""
    from docketflow.streaming import pipeline as P

    work = new_work_dir(spark, "batches")
    landing, n = f"{work}/landing", 104
    for k in range(n):
        _write(f"{landing}/matters_master", [json.dumps(MASTER[k % 2])])
    layout = P.current_layout(spark, f"{work}/out", run_id="r")
    rows = P._run_source(spark, landing, layout, "matters_master", "r", 1, P.LANDING_RETENTION_DAYS)[2]
    assert sorted({r[-1] for r in rows}) == list(range(n))
    assert {rule: sum(r[4] for r in rows if r[2] == rule) for rule in {r[2] for r in rows}} == dict.fromkeys({r[2] for r in rows}, n)
    assert P.record_metrics(spark, layout, "matters_master", "r", []) == []
