"""Business-rule cases (rate tier, valid action, valid event type) through the Spark expressions."""

import math

import pytest

from docketflow.functions.rules import is_valid_doc_action, is_valid_event_type, rate_tier

RATE_CASES = [
    (None, "unknown"), (0, "junior"), (100, "junior"), (299, "junior"), (300, "associate"), (500, "associate"),
    (599, "associate"), (600, "senior"), (800, "senior"), (899, "senior"), (900, "partner"), (1500, "partner"),
    (450.5, "associate"),
    # beyond the reference's table: negatives are junior, NaN falls through to partner, 299.999 is junior
    (-5, "junior"), (299.999, "junior"), (float("nan"), "partner"),
]


def test_rate_tier(spark):
    df = spark.createDataFrame([(None if r is None else float(r),) for r, _ in RATE_CASES], "rate double")
    got = [row.t for row in df.select(rate_tier("rate").alias("t")).collect()]
    assert got == [t for _, t in RATE_CASES]


def test_rate_tier_uses_raw_rate_not_rounded(spark):
    from docketflow.operators.silver import shape_time_entries

    raw = spark.createDataFrame(
        [("e1", "M-1", "U-1", 1.0, True, 299.999, "2024-01-02", "x")],
        "entry_id string, matter_id string, user_id string, hours double, billable_flag boolean, rate_usd double, "
        "date string, narrative string",
    )
    row = shape_time_entries(raw).collect()[0]
    assert str(row.rate_usd) == "300.00" and row.rate_tier == "junior"


@pytest.mark.parametrize("action,ok", [
    ("view", True), ("edit", True), ("share", True), ("download", True), ("delete", True),
    ("", False), ("VIEW", False), ("print", False), (None, False), ("create", False),
])
def test_valid_doc_action(spark, action, ok):
    df = spark.createDataFrame([(action,)], "a string")
    assert df.select(is_valid_doc_action("a").alias("v")).collect()[0].v is ok


@pytest.mark.parametrize("event_type,ok", [
    ("opened", True), ("status_change", True), ("note_added", True), ("closed", True),
    ("", False), ("OPENED", False), ("deleted", False), (None, False),
])
def test_valid_event_type(spark, event_type, ok):
    df = spark.createDataFrame([(event_type,)], "e string")
    assert df.select(is_valid_event_type("e").alias("v")).collect()[0].v is ok


def test_expectations_see_output_columns(spark):
    """hours is checked after the decimal(5,2) cast: 24.004 -> 24.00 passes, 0.004 fails, 0.005 -> 0.01 passes."""
    from docketflow.operators.silver import silver_time_entries

    rows = [(f"e{i}", "M-1", "U-1", h, True, 250, "2024-01-02", "x") for i, h in
            enumerate([24.004, 0.004, 0.005, 24.005, -1.0, 1000.0, float("inf"), float("nan")])]
    raw = spark.createDataFrame(rows, "entry_id string, matter_id string, user_id string, hours double, "
                                      "billable_flag boolean, rate_usd bigint, date string, narrative string")
    kept = sorted(r.entry_id for r in silver_time_entries(raw).collect())
    assert kept == ["e0", "e2"]


def test_bad_strings_become_null_not_errors(spark):
    from docketflow.operators.silver import shape_matter_events, shape_time_entries

    ev = spark.createDataFrame([("1", "M-1", "opened", "zzz", "U", "NYC"),
                                ("2", "M-1", "opened", "2024-03-01T23:30:00-02:00", "U", "NYC")],
                               "event_id string, matter_id string, event_type string, timestamp string, "
                               "user_id string, office string")
    got = {r.event_id: (r.event_ts, r.event_date) for r in shape_matter_events(ev).collect()}
    assert got["1"] == (None, None)
    assert str(got["2"][1]) == "2024-03-02"  # offset normalised to UTC
    te = spark.createDataFrame([("e", "M", "U", 1.0, True, 250, "2024-13-45", "x")],
                               "entry_id string, matter_id string, user_id string, hours double, "
                               "billable_flag boolean, rate_usd bigint, date string, narrative string")
    assert shape_time_entries(te).collect()[0].entry_date is None


def test_amount_overflow_is_null(spark):
    from docketflow.operators.silver import shape_time_entries

    te = spark.createDataFrame([("e", "M", "U", 999.99, True, 99999999, "2024-01-01", "x")],
                               "entry_id string, matter_id string, user_id string, hours double, "
                               "billable_flag boolean, rate_usd bigint, date string, narrative string")
    row = shape_time_entries(te).collect()[0]
    assert row.billable_amount_usd is None and not math.isnan(float(row.hours))
