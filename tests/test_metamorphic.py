"""Relations that must hold between layers and reports."""

from pyspark.sql import functions as F

from conftest import SF001
from docketflow.operators.silver import SILVER
from docketflow.plans import questions as Q
from docketflow.plans import reports as R
from docketflow.plans.layers import StandinLayers


def _one(df):
    return df.collect()[0]


def test_reports_reconcile(spark):
    lay = StandinLayers(spark, SF001)
    summary = lay.gold("gold_matter_summary")
    kpi = _one(R.kpis(summary))
    by_practice = R.revenue_by_practice(summary)
    assert _one(by_practice.agg(F.sum("matter_count").alias("n"))).n == kpi.total_matters
    assert abs(_one(by_practice.agg(F.sum("revenue_usd").alias("r"))).r - kpi.total_revenue_usd) < 1e-3
    docs = _one(R.doc_actions(lay.gold("gold_doc_activity_by_matter")).agg(F.sum("event_count").alias("n"))).n
    assert docs == lay.silver("silver_doc_audit").count()
    monthly = _one(R.monthly_revenue(lay.gold("gold_billable_hours_by_matter_month"))
                   .agg(F.sum("revenue_usd").alias("r"))).r
    silver_total = _one(lay.silver("silver_time_entries").filter("billable_flag")
                        .agg(F.sum("billable_amount_usd").cast("double").alias("r"))).r
    assert abs(monthly - silver_total) < 1e-3
    shares = _one(Q.revenue_share_by_practice(summary).agg(F.sum("revenue_share").alias("s"))).s
    assert abs(shares - 1.0) < 1e-9


def test_semi_anti_equals_counter_form(spark):
    lay = StandinLayers(spark, SF001)
    a = {r.matter_id for r in Q.opened_never_closed(lay.gold("gold_matter_lifecycle")).collect()}
    b = {r.matter_id for r in Q.opened_never_closed_anti(lay.silver("silver_matter_events")).collect()}
    assert a == b and len(a) > 0


def test_silver_plus_dropped_equals_typed(spark):
    lay = StandinLayers(spark, SF001)
    for name, spec in SILVER.items():
        typed = lay.typed(name)
        kept = lay.silver(name).count()
        dropped = typed.filter(~F.coalesce(
            F.expr(" AND ".join(f"({r.predicate})" for r in spec.rules if r.action == "drop")), F.lit(False))).count()
        assert kept + dropped == typed.count(), name


def test_summary_edge_cases_present(spark):
    """The mapping leaves matters without events, billing or documents; zero-fill applies, timestamps stay NULL."""
    s = StandinLayers(spark, SF001).gold("gold_matter_summary")
    no_events = s.filter("total_lifecycle_events = 0")
    assert no_events.count() > 0
    assert no_events.filter("first_event_ts IS NOT NULL OR is_closed").count() == 0
    no_billing = s.filter("total_billable_hours = 0")
    assert no_billing.count() > 0 and no_billing.filter("last_billed_date IS NOT NULL").count() == 0
    assert s.filter("total_doc_events = 0").count() > 0
    assert s.count() == s.select("matter_id").distinct().count()


def test_widget_feeds_are_projections(spark):
    lay = StandinLayers(spark, SF001)
    summary = lay.gold("gold_matter_summary")
    datasets = {
        "kpis": R.kpis(summary),
        "monthly_revenue": R.monthly_revenue(lay.gold("gold_billable_hours_by_matter_month")),
        "by_practice": R.revenue_by_practice(summary),
        "top_matters": R.top_matters(summary),
        "doc_actions": R.doc_actions(lay.gold("gold_doc_activity_by_matter")),
    }
    for name, (dataset, cols) in R.WIDGETS.items():
        feed = R.widget(datasets, name)
        assert feed.columns == list(cols)
        assert feed.count() == datasets[dataset].count(), name
