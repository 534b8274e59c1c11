"""Independent SQL definitions (DuckDB dialect) of the registered batch queries.

Written from the stated semantics, not generated from the Spark plans: the stand-in
mapping, silver typing and rules, gold aggregates, dashboard datasets and questions
are spelled out as plain SQL over the given tables.  Used as the correctness oracle.
"""

from __future__ import annotations

_TS = "TIMESTAMP '2024-01-17 00:00:00'"
_EVENT_TYPES = "('opened', 'status_change', 'note_added', 'closed')"
_ACTIONS = "('view', 'edit', 'share', 'download', 'delete')"
_AREAS = "('M&A', 'Litigation', 'IP', 'Real Estate', 'Employment', 'Tax', 'Regulatory')"

PREAMBLE = f"""
WITH
typed_matters_master AS (
  SELECT CASE WHEN c.c_custkey % 101 <> 100 THEN 'M-' || CAST(c.c_custkey AS VARCHAR) END AS matter_id,
         c.c_name AS client_name,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Real Estate' WHEN 'AUTOMOBILE' THEN 'Litigation'
              WHEN 'MACHINERY' THEN 'M&A' WHEN 'HOUSEHOLD' THEN 'Employment' WHEN 'FURNITURE' THEN 'Furniture' END
           AS practice_area,
         CASE r.r_name WHEN 'AMERICA' THEN 'NA' WHEN 'ASIA' THEN 'APAC' WHEN 'EUROPE' THEN 'EMEA' ELSE 'LATAM' END
           AS region,
         CAST(DATE '1994-01-01' + CAST(c.c_custkey % 900 AS INTEGER) AS TIMESTAMP) AS opened_ts,
         CAST(DATE '1994-01-01' + CAST(c.c_custkey % 900 AS INTEGER) AS DATE) AS opened_date,
         'U-' || CAST(c.c_custkey % 10 AS VARCHAR) AS partner_lead_user_id,
         CASE c.c_custkey % 4 WHEN 0 THEN 'hourly' WHEN 1 THEN 'fixed_fee' WHEN 2 THEN 'retainer'
              ELSE 'contingency' END AS billing_arrangement,
         'standin/customer' AS _source_file,
         {_TS} AS _ingested_at
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
silver_matters_master AS (
  SELECT * FROM typed_matters_master WHERE matter_id IS NOT NULL
),
typed_matter_events AS (
  SELECT CASE WHEN o_orderkey % 89 <> 5 THEN 'E-' || CAST(o_orderkey AS VARCHAR) END AS event_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 97 = 1 THEN ''
              WHEN o_custkey % 40 = 7 THEN 'X-' || CAST(o_custkey AS VARCHAR)
              ELSE 'M-' || CAST(o_custkey AS VARCHAR) END AS matter_id,
         CASE WHEN o_orderstatus = 'O' THEN 'opened'
              WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'closed'
              WHEN o_orderpriority = '5-LOW' THEN 'status_change'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'EVENT'
              ELSE 'note_added' END AS event_type,
         o_orderdate AS event_ts,
         CAST(o_orderdate AS DATE) AS event_date,
         'U-' || CAST(o_custkey % 50 AS VARCHAR) AS user_id,
         CASE o_orderkey % 5 WHEN 0 THEN 'NYC' WHEN 1 THEN 'LON' WHEN 2 THEN 'CHI' WHEN 3 THEN 'SFO' ELSE 'BLR' END
           AS office,
         'standin/orders' AS _source_file,
         {_TS} AS _ingested_at
  FROM orders
),
silver_matter_events AS (
  SELECT * FROM typed_matter_events
  WHERE event_type IN {_EVENT_TYPES}
    AND matter_id IS NOT NULL AND matter_id <> ''
    AND event_id IS NOT NULL
),
time_entry_base_raw AS (
  SELECT l.l_quantity, 'T-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS entry_id,
         CASE WHEN l.l_orderkey % 83 = 2 THEN NULL WHEN o.o_custkey % 60 = 11 THEN 'X-' || CAST(o.o_custkey AS VARCHAR)
              ELSE 'M-' || CAST(o.o_custkey AS VARCHAR) END AS matter_id,
         CASE WHEN l.l_suppkey % 20 = 19 THEN NULL ELSE 'U-' || CAST(l.l_suppkey % 50 AS VARCHAR) END AS user_id,
         TRY_CAST(l.l_quantity * CAST(0.75 AS DOUBLE) - 2 AS DECIMAL(5,2)) AS hours_dec,
         CASE WHEN l.l_linenumber <> 7 THEN l.l_returnflag <> 'R' END AS billable_flag,
         CASE WHEN l.l_suppkey % 23 <> 4 THEN CAST(floor(l.l_extendedprice / 100) AS BIGINT) END AS raw_rate,
         CAST(l.l_shipdate AS DATE) AS entry_date,
         'order ' || CAST(l.l_orderkey AS VARCHAR) || ' line ' || CAST(l.l_linenumber AS VARCHAR) AS narrative
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
),
time_entry_base AS (SELECT * EXCLUDE (l_quantity) FROM time_entry_base_raw),
typed_time_entries AS (
  SELECT entry_id, matter_id, user_id,
         hours_dec AS hours,
         billable_flag,
         TRY_CAST(raw_rate AS DECIMAL(10,2)) AS rate_usd,
         TRY_CAST(hours_dec * TRY_CAST(raw_rate AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS billable_amount_usd,
         CASE WHEN raw_rate IS NULL THEN 'unknown' WHEN raw_rate < 300 THEN 'junior'
              WHEN raw_rate < 600 THEN 'associate' WHEN raw_rate < 900 THEN 'senior' ELSE 'partner' END AS rate_tier,
         entry_date, narrative,
         'standin/lineitem' AS _source_file,
         {_TS} AS _ingested_at
  FROM time_entry_base
),
silver_time_entries AS (
  SELECT * FROM typed_time_entries
  WHERE hours > 0 AND hours <= 24 AND user_id IS NOT NULL AND matter_id IS NOT NULL
),
typed_doc_audit AS (
  SELECT 'A-' || CAST(event_id AS VARCHAR) AS audit_id,
         CASE WHEN event_id % 33 = 0 THEN NULL ELSE 'D-' || CAST(event_id % 600 AS VARCHAR) END AS doc_id,
         CASE WHEN event_id % 71 = 0 THEN NULL ELSE 'M-' || CAST(user_id AS VARCHAR) END AS matter_id,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'edit' WHEN 'purchase' THEN 'download'
              WHEN 'signup' THEN 'share' WHEN 'error' THEN 'READ' END AS action,
         'U-' || CAST(event_id % 50 AS VARCHAR) AS user_id,
         ts AS audit_ts,
         CAST(ts AS DATE) AS audit_date,
         '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS client_ip,
         'standin/events' AS _source_file,
         {_TS} AS _ingested_at
  FROM events
),
silver_doc_audit AS (
  SELECT * FROM typed_doc_audit WHERE action IN {_ACTIONS} AND doc_id IS NOT NULL
),
raw_matter_events AS (
  SELECT event_id, matter_id, event_type,
         strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         user_id, office
  FROM typed_matter_events
),
raw_time_entries AS (
  SELECT entry_id, matter_id, user_id,
         l_quantity * CAST(0.75 AS DOUBLE) - 2 AS hours,
         billable_flag, raw_rate AS rate_usd,
         strftime(entry_date, '%Y-%m-%d') AS "date",
         narrative
  FROM time_entry_base_raw
),
raw_doc_audit AS (
  SELECT audit_id, doc_id, matter_id, action, user_id,
         strftime(audit_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         client_ip
  FROM typed_doc_audit
),
raw_matters_master AS (
  SELECT matter_id, client_name, practice_area, region,
         strftime(opened_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS opened_at,
         partner_lead_user_id, billing_arrangement
  FROM typed_matters_master
),
gold_billable_hours_by_matter_month AS (
  SELECT matter_id,
         CAST(date_trunc('month', entry_date) AS DATE) AS entry_month,
         CAST(SUM(hours) AS DECIMAL(15,2)) AS total_hours,
         CAST(SUM(billable_amount_usd) AS DECIMAL(22,2)) AS total_revenue_usd,
         COUNT(DISTINCT user_id) AS distinct_users,
         COUNT(DISTINCT entry_id) AS entry_count
  FROM silver_time_entries WHERE billable_flag
  GROUP BY matter_id, CAST(date_trunc('month', entry_date) AS DATE)
),
gold_doc_activity_by_matter AS (
  SELECT matter_id, action,
         COUNT(*) AS event_count,
         COUNT(DISTINCT doc_id) AS distinct_docs,
         COUNT(DISTINCT user_id) AS distinct_users,
         MIN(audit_ts) AS first_seen,
         MAX(audit_ts) AS last_seen
  FROM silver_doc_audit GROUP BY matter_id, action
),
gold_matter_lifecycle AS (
  SELECT matter_id,
         MIN(event_ts) AS first_event_ts,
         MAX(event_ts) AS last_event_ts,
         COUNT(*) AS total_events,
         CAST(SUM(CASE WHEN event_type = 'opened' THEN 1 ELSE 0 END) AS BIGINT) AS opened_events,
         CAST(SUM(CASE WHEN event_type = 'closed' THEN 1 ELSE 0 END) AS BIGINT) AS closed_events,
         COALESCE(list_sort(list(DISTINCT office) FILTER (WHERE office IS NOT NULL)), CAST([] AS VARCHAR[]))
           AS offices_touched
  FROM silver_matter_events GROUP BY matter_id
),
summary_revenue AS (
  SELECT matter_id,
         CAST(SUM(hours) AS DECIMAL(15,2)) AS total_billable_hours,
         CAST(SUM(billable_amount_usd) AS DECIMAL(22,2)) AS total_revenue_usd,
         COUNT(DISTINCT user_id) AS distinct_timekeepers,
         MAX(entry_date) AS last_billed_date
  FROM silver_time_entries WHERE billable_flag GROUP BY matter_id
),
summary_lifecycle AS (
  SELECT matter_id,
         MIN(event_ts) AS first_event_ts,
         MAX(event_ts) AS last_event_ts,
         COUNT(*) AS total_events,
         CAST(SUM(CASE WHEN event_type = 'closed' THEN 1 ELSE 0 END) AS BIGINT) AS close_count
  FROM silver_matter_events GROUP BY matter_id
),
summary_doc_activity AS (
  SELECT matter_id, COUNT(*) AS total_doc_events, COUNT(DISTINCT doc_id) AS distinct_docs
  FROM silver_doc_audit GROUP BY matter_id
),
gold_matter_summary AS (
  SELECT m.matter_id, m.client_name, m.practice_area, m.region, m.billing_arrangement, m.partner_lead_user_id,
         m.opened_ts, l.first_event_ts, l.last_event_ts,
         COALESCE(l.close_count > 0, false) AS is_closed,
         COALESCE(r.total_billable_hours, CAST(0 AS DECIMAL(15,2))) AS total_billable_hours,
         COALESCE(r.total_revenue_usd, CAST(0 AS DECIMAL(22,2))) AS total_revenue_usd,
         COALESCE(r.distinct_timekeepers, 0) AS distinct_timekeepers,
         r.last_billed_date,
         COALESCE(d.total_doc_events, 0) AS total_doc_events,
         COALESCE(d.distinct_docs, 0) AS distinct_docs,
         COALESCE(l.total_events, 0) AS total_lifecycle_events
  FROM silver_matters_master m
  LEFT JOIN summary_revenue r ON m.matter_id = r.matter_id
  LEFT JOIN summary_lifecycle l ON m.matter_id = l.matter_id
  LEFT JOIN summary_doc_activity d ON m.matter_id = d.matter_id
)
"""

_SILVER_COLS = {
    "silver_matter_events": "event_id, matter_id, event_type, event_ts, event_date, user_id, office, "
                            "_source_file, _ingested_at",
    "silver_time_entries": "entry_id, matter_id, user_id, hours, billable_flag, rate_usd, billable_amount_usd, "
                           "rate_tier, entry_date, narrative, _source_file, _ingested_at",
    "silver_doc_audit": "audit_id, doc_id, matter_id, action, user_id, audit_ts, audit_date, client_ip, "
                        "_source_file, _ingested_at",
    "silver_matters_master": "matter_id, client_name, practice_area, region, opened_ts, opened_date, "
                             "partner_lead_user_id, billing_arrangement, _source_file, _ingested_at",
}


def _metric(dataset: str, source: str, rule: str, action: str, predicate: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{action}' AS action, COUNT(*) AS n_rows, "
        f"COUNT(*) FILTER (WHERE NOT COALESCE({predicate}, false)) AS n_failed FROM {source}"
    )


_METRICS = " UNION ALL ".join([
    _metric("silver_matter_events", "typed_matter_events", "valid_event_type", "drop", f"event_type IN {_EVENT_TYPES}"),
    _metric("silver_matter_events", "typed_matter_events", "has_matter_id", "drop",
            "matter_id IS NOT NULL AND matter_id <> ''"),
    _metric("silver_matter_events", "typed_matter_events", "has_event_id", "drop", "event_id IS NOT NULL"),
    _metric("silver_time_entries", "typed_time_entries", "positive_hours", "drop", "hours > 0 AND hours <= 24"),
    _metric("silver_time_entries", "typed_time_entries", "has_user", "drop", "user_id IS NOT NULL"),
    _metric("silver_time_entries", "typed_time_entries", "has_matter", "drop", "matter_id IS NOT NULL"),
    _metric("silver_doc_audit", "typed_doc_audit", "valid_action", "drop", f"action IN {_ACTIONS}"),
    _metric("silver_doc_audit", "typed_doc_audit", "has_doc", "drop", "doc_id IS NOT NULL"),
    _metric("silver_matters_master", "typed_matters_master", "has_matter_id", "drop", "matter_id IS NOT NULL"),
    _metric("silver_matters_master", "typed_matters_master", "known_practice_area", "warn",
            f"practice_area IN {_AREAS}"),
])

FINAL: dict[str, str] = {
    **{name: f"SELECT {cols} FROM {name}" for name, cols in _SILVER_COLS.items()},
    "gold_billable_hours_by_matter_month": "SELECT * FROM gold_billable_hours_by_matter_month",
    "gold_doc_activity_by_matter": "SELECT * FROM gold_doc_activity_by_matter",
    "gold_matter_lifecycle": "SELECT * FROM gold_matter_lifecycle",
    "gold_matter_summary": "SELECT * FROM gold_matter_summary",
    "summary_revenue": "SELECT * FROM summary_revenue",
    "summary_lifecycle": "SELECT * FROM summary_lifecycle",
    "summary_doc_activity": "SELECT * FROM summary_doc_activity",
    "expectation_metrics": _METRICS,
    "warn_practice_area": f"""
        SELECT practice_area, COUNT(*) AS n_rows FROM silver_matters_master
        WHERE NOT COALESCE(practice_area IN {_AREAS}, false) GROUP BY practice_area""",
    "parse_timestamps": """
        SELECT event_id,
               strftime(ts + to_hours(CAST(event_id % 5 - 2 AS INTEGER)), '%Y-%m-%dT%H:%M:%S.%f')
                 || CASE event_id % 5 WHEN 0 THEN '-02:00' WHEN 1 THEN '-01:00' WHEN 2 THEN '+00:00'
                                      WHEN 3 THEN '+01:00' ELSE '+02:00' END AS timestamp_text,
               ts AS parsed_ts, CAST(ts AS DATE) AS parsed_date
        FROM events""",
    "billable_amount": "SELECT entry_id, hours, rate_usd, billable_amount_usd, rate_tier FROM typed_time_entries",
    "rate_tier_distribution": """
        SELECT rate_tier, COUNT(*) AS entries, MIN(rate_usd) AS min_rate, MAX(rate_usd) AS max_rate
        FROM silver_time_entries GROUP BY rate_tier""",
    "doc_action_validity": f"""
        SELECT action, COALESCE(action IN {_ACTIONS}, false) AS is_valid, COUNT(*) AS n_rows
        FROM typed_doc_audit GROUP BY 1, 2""",
    "event_type_validity": f"""
        SELECT event_type, COALESCE(event_type IN {_EVENT_TYPES}, false) AS is_valid, COUNT(*) AS n_rows
        FROM typed_matter_events GROUP BY 1, 2""",
    "dash_kpis": """
        SELECT COUNT(*) AS total_matters,
               CAST(SUM(total_revenue_usd) AS DOUBLE) AS total_revenue_usd,
               CAST(SUM(total_lifecycle_events) AS BIGINT) AS total_events,
               CAST(SUM(total_doc_events) AS BIGINT) AS total_doc_events
        FROM gold_matter_summary""",
    "dash_monthly_revenue": """
        SELECT entry_month, CAST(SUM(total_revenue_usd) AS DOUBLE) AS revenue_usd,
               CAST(SUM(total_hours) AS DECIMAL(25,2)) AS hours
        FROM gold_billable_hours_by_matter_month GROUP BY entry_month ORDER BY entry_month""",
    "dash_by_practice": """
        SELECT practice_area, CAST(SUM(total_revenue_usd) AS DOUBLE) AS revenue_usd, COUNT(*) AS matter_count
        FROM gold_matter_summary GROUP BY practice_area ORDER BY revenue_usd DESC""",
    "dash_top_matters": """
        SELECT matter_id, client_name, practice_area, region, CAST(total_revenue_usd AS DOUBLE) AS revenue_usd,
               total_billable_hours, total_doc_events, is_closed
        FROM gold_matter_summary ORDER BY revenue_usd DESC NULLS LAST, matter_id LIMIT 25""",
    "dash_doc_actions": """
        SELECT action, CAST(SUM(event_count) AS BIGINT) AS event_count
        FROM gold_doc_activity_by_matter GROUP BY action ORDER BY event_count DESC""",
    "dash_kpis_extended": """
        SELECT COUNT(*) AS total_matters,
               CAST(SUM(total_billable_hours) AS DECIMAL(25,2)) AS total_billable_hours,
               CAST(SUM(total_revenue_usd) AS DOUBLE) AS total_revenue_usd,
               CAST(SUM(total_revenue_usd) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_revenue_per_matter
        FROM gold_matter_summary""",
    "q_top10_matters": """
        SELECT matter_id, client_name, practice_area, CAST(total_revenue_usd AS DOUBLE) AS revenue_usd
        FROM gold_matter_summary ORDER BY revenue_usd DESC NULLS LAST, matter_id LIMIT 10""",
    "q_revenue_share_by_practice": """
        SELECT practice_area, CAST(SUM(total_revenue_usd) AS DOUBLE) AS revenue_usd, COUNT(*) AS matter_count,
               CAST(SUM(total_revenue_usd) AS DOUBLE)
                 / (SELECT CAST(SUM(total_revenue_usd) AS DOUBLE) FROM gold_matter_summary) AS revenue_share
        FROM gold_matter_summary GROUP BY practice_area ORDER BY revenue_usd DESC""",
    "q_doc_events_last_week": """
        SELECT DATE '2024-01-08' AS week_start, DATE '2024-01-14' AS week_end, COUNT(*) AS doc_events
        FROM silver_doc_audit WHERE audit_date >= DATE '2024-01-08' AND audit_date < DATE '2024-01-15'""",
    "q_opened_never_closed": """
        SELECT matter_id, first_event_ts, last_event_ts, total_events, opened_events
        FROM gold_matter_lifecycle WHERE opened_events > 0 AND closed_events = 0""",
    "q_opened_never_closed_anti": """
        SELECT DISTINCT e.matter_id FROM silver_matter_events e
        WHERE e.event_type = 'opened'
          AND NOT EXISTS (SELECT 1 FROM silver_matter_events c
                          WHERE c.event_type = 'closed' AND c.matter_id = e.matter_id)""",
    "q_avg_hours_by_practice": """
        SELECT practice_area, COUNT(*) AS matter_count,
               CAST(SUM(total_billable_hours) AS DECIMAL(25,2)) AS total_billable_hours,
               CAST(SUM(total_billable_hours) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_billable_hours
        FROM gold_matter_summary WHERE practice_area IN ('M&A', 'Litigation')
        GROUP BY practice_area ORDER BY practice_area""",
    "q_top_timekeepers": """
        SELECT user_id, CAST(SUM(billable_amount_usd) AS DOUBLE) AS revenue_usd,
               CAST(SUM(hours) AS DECIMAL(15,2)) AS total_hours, COUNT(*) AS entries
        FROM silver_time_entries WHERE billable_flag
        GROUP BY user_id ORDER BY revenue_usd DESC NULLS LAST, user_id LIMIT 10""",
    "q_clients_by_doc_activity": """
        SELECT client_name, CAST(SUM(total_doc_events) AS BIGINT) AS total_doc_events, COUNT(*) AS matter_count
        FROM gold_matter_summary GROUP BY client_name ORDER BY total_doc_events DESC, client_name LIMIT 10""",
    "q_monthly_revenue_by_region": """
        SELECT m.region, g.entry_month, CAST(SUM(g.total_revenue_usd) AS DOUBLE) AS revenue_usd,
               CAST(SUM(g.total_hours) AS DECIMAL(25,2)) AS hours
        FROM gold_billable_hours_by_matter_month g
        JOIN silver_matters_master m ON g.matter_id = m.matter_id
        GROUP BY m.region, g.entry_month ORDER BY m.region, g.entry_month""",
}

_NO_LINEAGE = {
    name: ", ".join(c.strip() for c in cols.split(",") if c.strip() not in ("_source_file", "_ingested_at"))
    for name, cols in _SILVER_COLS.items()
}

FINAL.update({
    "bronze_matter_events": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_matter_events",
    "bronze_time_entries": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_time_entries",
    "bronze_doc_audit": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_doc_audit",
    "bronze_matters_master": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_matters_master",
    "land_json_batch": "SELECT * FROM raw_time_entries",
    "land_master_once": "SELECT * FROM raw_matters_master",
    "ingest_incremental": f"SELECT {_NO_LINEAGE['silver_time_entries']} FROM silver_time_entries",
    "compacted_silver": f"SELECT {_NO_LINEAGE['silver_time_entries']} FROM silver_time_entries",
    "run_pipeline": "SELECT * FROM gold_matter_summary",
    "full_refresh_equivalence": "SELECT * FROM gold_billable_hours_by_matter_month",
    "refresh_gold": "SELECT * FROM gold_doc_activity_by_matter",
    "incremental_gold_monthly": "SELECT * FROM gold_billable_hours_by_matter_month",
    "incremental_gold_activity": "SELECT * FROM gold_doc_activity_by_matter",
    "incremental_gold_summary": "SELECT * FROM gold_matter_summary",
    "stream_expectation_metrics": FINAL["expectation_metrics"],
    "rejected_rows": " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, {key} AS row_key, matter_id, failed_rules FROM ("
        f"SELECT *, concat_ws(',', {', '.join(f'CASE WHEN NOT COALESCE({p}, false) THEN {chr(39)}{r}{chr(39)} END' for r, p in rules)}) AS failed_rules FROM {typed}) "
        "WHERE failed_rules <> ''"
        for dataset, typed, key, rules in (
            ("silver_matter_events", "typed_matter_events", "event_id",
             (("valid_event_type", f"event_type IN {_EVENT_TYPES}"), ("has_matter_id", "matter_id IS NOT NULL AND matter_id <> ''"), ("has_event_id", "event_id IS NOT NULL"))),
            ("silver_time_entries", "typed_time_entries", "entry_id",
             (("positive_hours", "hours > 0 AND hours <= 24"), ("has_user", "user_id IS NOT NULL"), ("has_matter", "matter_id IS NOT NULL"))),
            ("silver_doc_audit", "typed_doc_audit", "audit_id", (("valid_action", f"action IN {_ACTIONS}"), ("has_doc", "doc_id IS NOT NULL"))),
            ("silver_matters_master", "typed_matters_master", "client_name", (("has_matter_id", "matter_id IS NOT NULL"),)),
        )),
    # a day is closed when the greatest time of a wave has passed its end by two days; second-wave rows of such days are late
    "stream_daily_doc_activity": """
        SELECT day, action, CAST(COUNT(*) FILTER (WHERE NOT late) AS BIGINT) AS n_events, CAST(COUNT(*) FILTER (WHERE late) AS BIGINT) AS n_late
        FROM (SELECT CAST(audit_ts AS DATE) AS day, action, second AND CAST(audit_ts AS DATE) + INTERVAL 1 DAY <= first_mark AS late, last_mark
              FROM (SELECT *, MAX(audit_ts) FILTER (WHERE NOT second) OVER () - INTERVAL 2 DAY AS first_mark, MAX(audit_ts) OVER () - INTERVAL 2 DAY AS last_mark
                    FROM (SELECT *, audit_ts >= TIMESTAMP '2024-01-16' OR CAST(split_part(audit_id, '-', 2) AS BIGINT) % 10 = 3 AS second FROM silver_doc_audit)))
        WHERE day + INTERVAL 1 DAY <= last_mark GROUP BY day, action""",
})


# Widget feeds: columns of a dashboard dataset.
FINAL.update({
    f"widget_{name}": f"SELECT {', '.join(columns)} FROM ({FINAL['dash_' + dataset]})"
    for name, dataset, columns in (
        ("counter_total_matters", "kpis", ("total_matters",)),
        ("counter_total_revenue", "kpis", ("total_revenue_usd",)),
        ("counter_total_events", "kpis", ("total_events",)),
        ("counter_total_doc_events", "kpis", ("total_doc_events",)),
        ("line_monthly_revenue", "monthly_revenue", ("entry_month", "revenue_usd")),
        ("bar_revenue_by_practice", "by_practice", ("practice_area", "revenue_usd")),
        ("pie_doc_actions", "doc_actions", ("action", "event_count")),
        ("table_top_matters", "top_matters", ("matter_id", "client_name", "practice_area", "region", "revenue_usd", "total_billable_hours", "total_doc_events", "is_closed")),
    )
})


# Dirty variants of the landed lines: the line is spelled out, each variant's values and rescued text stated.
_LINE = """
lines AS (
  SELECT r.*, (CAST(split_part(entry_id, '-', 2) AS BIGINT) * 7 + CAST(split_part(entry_id, '-', 3) AS BIGINT)) % 8 AS v,
         '{"entry_id":"' || entry_id || '","matter_id":' || coalesce('"' || matter_id || '"', 'null') || ',"user_id":' || coalesce('"' || user_id || '"', 'null')
           || ',"hours":' || CAST(hours AS VARCHAR) || ',"billable_flag":' || coalesce(CAST(billable_flag AS VARCHAR), 'null')
           || ',"rate_usd":' || coalesce(CAST(rate_usd AS VARCHAR), 'null') || ',"date":"' || "date" || '","narrative":"' || narrative || '"}' AS line
  FROM raw_time_entries r
)"""
FINAL.update({
    "rescue_json": """
        SELECT CASE WHEN v IN (2, 3, 4) THEN NULL ELSE entry_id END AS entry_id,
               CASE WHEN v IN (3, 4) THEN NULL ELSE matter_id END AS matter_id,
               CASE WHEN v IN (3, 4) THEN NULL ELSE user_id END AS user_id,
               CASE WHEN v IN (3, 4, 6) THEN NULL ELSE hours END AS hours,
               CASE WHEN v IN (3, 4) THEN NULL ELSE billable_flag END AS billable_flag,
               CASE WHEN v IN (3, 4, 5) THEN NULL ELSE rate_usd END AS rate_usd,
               CASE WHEN v IN (3, 4) THEN NULL ELSE "date" END AS "date",
               CASE WHEN v IN (3, 4) THEN NULL ELSE narrative END AS narrative,
               CASE WHEN v = 1 THEN '{"extra_field":1}'
                    WHEN v = 2 THEN '{"ENTRY_ID":"' || entry_id || '"}'
                    WHEN v = 3 THEN left(line, length(line) - 3)
                    WHEN v = 4 THEN '[' || line || ']'
                    WHEN v = 5 AND rate_usd IS NOT NULL THEN '{"rate_usd":' || CAST(rate_usd AS VARCHAR) || '.7}'
                    WHEN v = 6 THEN '{"hours":"' || CAST(hours AS VARCHAR) || '"}' END AS _rescued_data
        FROM lines""",
    "rows_per_source_file": """
        SELECT source, n_rows, CAST(0 AS BIGINT) AS n_unknown, true AS all_in_landing, true AS several_files FROM (
          SELECT 'matters_master' AS source, COUNT(*) AS n_rows FROM raw_matters_master UNION ALL
          SELECT 'matters', COUNT(*) FROM raw_matter_events UNION ALL
          SELECT 'time_entries', COUNT(*) FROM raw_time_entries UNION ALL
          SELECT 'doc_audit', COUNT(*) FROM raw_doc_audit)""",
    # fixed: the schema that inference must find, and the catalog's entries
    "infer_raw_schema": """
        SELECT * FROM (VALUES
          ('matters_master', 'billing_arrangement', 'string'), ('matters_master', 'client_name', 'string'),
          ('matters_master', 'matter_id', 'string'), ('matters_master', 'opened_at', 'string'),
          ('matters_master', 'partner_lead_user_id', 'string'), ('matters_master', 'practice_area', 'string'),
          ('matters_master', 'region', 'string'),
          ('matters', 'event_id', 'string'), ('matters', 'event_type', 'string'), ('matters', 'matter_id', 'string'),
          ('matters', 'office', 'string'), ('matters', 'timestamp', 'string'), ('matters', 'user_id', 'string'),
          ('time_entries', 'billable_flag', 'boolean'), ('time_entries', 'date', 'string'),
          ('time_entries', 'entry_id', 'string'), ('time_entries', 'hours', 'double'),
          ('time_entries', 'matter_id', 'string'), ('time_entries', 'narrative', 'string'),
          ('time_entries', 'rate_usd', 'bigint'), ('time_entries', 'user_id', 'string'),
          ('doc_audit', 'action', 'string'), ('doc_audit', 'audit_id', 'string'), ('doc_audit', 'client_ip', 'string'),
          ('doc_audit', 'doc_id', 'string'), ('doc_audit', 'matter_id', 'string'), ('doc_audit', 'timestamp', 'string'),
          ('doc_audit', 'user_id', 'string')) t(source, field, type)""",
    "table_catalog": """
        SELECT * FROM (VALUES
          ('bronze_matter_events', 'Landed matter event lines as read, with rescued fields, file and time of ingestion.', 'bronze'),
          ('bronze_time_entries', 'Landed time entry lines as read, with rescued fields, file and time of ingestion.', 'bronze'),
          ('bronze_doc_audit', 'Landed document audit lines as read, with rescued fields, file and time of ingestion.', 'bronze'),
          ('bronze_matters_master', 'Landed matter dimension lines as read; the dimension lands a single time.', 'bronze'),
          ('silver_matter_events', 'Matter events that pass every drop rule, time of the event typed.', 'silver'),
          ('silver_time_entries', 'Time entries that pass every drop rule, with decimal hours, rate and amount, and the rate tier.', 'silver'),
          ('silver_doc_audit', 'Document audit rows with a known action and a document, time typed.', 'silver'),
          ('silver_matters_master', 'Matters with an id, opening time typed; unknown practice areas are kept and counted.', 'silver'),
          ('gold_billable_hours_by_matter_month', 'Sums of billable hours and amounts, users and entries, by matter and month of the entry.', 'gold'),
          ('gold_doc_activity_by_matter', 'Number of audit rows, documents and users, first and last time, by matter and action.', 'gold'),
          ('gold_matter_lifecycle', 'Events of each matter: first, last, how many in all and of each kind, offices.', 'gold'),
          ('gold_matter_summary', 'A row for each matter of the dimension with its revenue, lifecycle and document totals.', 'gold')
        ) t("table", comment, quality)""",
})


def oracle_queries() -> dict[str, str]:
    extra = {"rescue_json": "," + _LINE}
    return {name: PREAMBLE + extra.get(name, "") + final for name, final in FINAL.items()}
