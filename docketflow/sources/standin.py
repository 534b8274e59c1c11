"""Stand-in mapping: the given TPC-H-style tables -> the four raw source shapes.

The pipeline's real input is JSON-lines landing files; for checks against an
independent SQL engine we derive rows of the same shape from the given tables
(whole tables, every row).  Some rows are given other keys or NULLs on purpose: facts
whose matter has no dimension row (``X-...``), matters that are left without events or
billing, and rows that each data-quality rule must fail.

Columns are raw-shaped (same names as the landing schema).  Time fields stay typed
(TIMESTAMP / DATE) here; the silver typing accepts both typed values and ISO strings,
and :func:`docketflow.sources.landing.to_landing_shape` renders strings for files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.sources.tables import read_table

# Fixed values of the mapping (see FIXTURES.md §2).
PRACTICE_BY_SEGMENT = (
    ("BUILDING", "Real Estate"),
    ("AUTOMOBILE", "Litigation"),
    ("MACHINERY", "M&A"),
    ("HOUSEHOLD", "Employment"),
    ("FURNITURE", "Furniture"),  # deliberately unknown: exercises the warn rule
)
REGION_BY_NAME = (("AMERICA", "NA"), ("ASIA", "APAC"), ("EUROPE", "EMEA"))
REGION_DEFAULT = "LATAM"
BILLING_ARRANGEMENTS = ("hourly", "fixed_fee", "retainer", "contingency")
OFFICES = ("NYC", "LON", "CHI", "SFO", "BLR")
ACTION_BY_EVENT_TYPE = (
    ("view", "view"),
    ("click", "edit"),
    ("purchase", "download"),
    ("signup", "share"),
    ("error", "READ"),  # invalid action: exercises valid_action
)
STANDIN_INGESTED_AT = "2024-01-17 00:00:00"


def _case(col: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _prefixed(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def _lineage(table: str) -> list[Column]:
    return [
        F.lit(f"standin/{table}").alias("_source_file"),
        F.to_timestamp(F.lit(STANDIN_INGESTED_AT)).alias("_ingested_at"),
    ]


def matters_master(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("c_custkey")
    return j.select(
        F.when(key % 101 != 100, _prefixed("M-", key)).alias("matter_id"),
        F.col("c_name").alias("client_name"),
        _case(F.col("c_mktsegment"), PRACTICE_BY_SEGMENT).alias("practice_area"),
        _case(F.col("r_name"), REGION_BY_NAME, REGION_DEFAULT).alias("region"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 900).cast("int")).cast("timestamp").alias("opened_at"),
        _prefixed("U-", key % 10).alias("partner_lead_user_id"),
        _pick(BILLING_ARRANGEMENTS, key % 4).alias("billing_arrangement"),
        *(_lineage("customer") if lineage else []),
    )


def matter_events(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    event_type = (
        F.when(F.col("o_orderstatus") == "O", F.lit("opened"))
        .when((F.col("o_orderstatus") == "F") & (okey % 3 == 0), F.lit("closed"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("status_change"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("EVENT"))  # invalid type
        .otherwise(F.lit("note_added"))
    )
    return o.select(
        F.when(okey % 89 != 5, _prefixed("E-", okey)).alias("event_id"),
        F.when(okey % 97 == 0, F.lit(None).cast("string"))
        .when(okey % 97 == 1, F.lit(""))
        .when(F.col("o_custkey") % 40 == 7, _prefixed("X-", F.col("o_custkey")))
        .otherwise(_prefixed("M-", F.col("o_custkey"))).alias("matter_id"),
        event_type.alias("event_type"),
        F.col("o_orderdate").alias("timestamp"),
        _prefixed("U-", F.col("o_custkey") % 50).alias("user_id"),
        _pick(OFFICES, okey % 5).alias("office"),
        *(_lineage("orders") if lineage else []),
    )


def time_entries(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    supp = F.col("l_suppkey")
    # shaped before the join: short numbers are shuffled instead of the prices and times that they come from
    li = li.select(
        "l_orderkey", "l_linenumber",
        F.when(supp % 20 == 19, F.lit(None).cast("bigint")).otherwise(supp % 50).alias("user"),
        (F.col("l_quantity") * F.lit(0.75).cast("double") - F.lit(2)).alias("hours"),
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag") != "R").alias("billable_flag"),
        F.when(supp % 23 != 4, F.floor(F.col("l_extendedprice") / 100).cast("bigint")).alias("rate_usd"),
        F.to_date(F.col("l_shipdate")).alias("date"),
    )
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat(F.lit("T-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("entry_id"),
        F.when(F.col("l_orderkey") % 83 == 2, F.lit(None).cast("string"))
        .when(F.col("o_custkey") % 60 == 11, _prefixed("X-", F.col("o_custkey")))
        .otherwise(_prefixed("M-", F.col("o_custkey"))).alias("matter_id"),
        _prefixed("U-", F.col("user")).alias("user_id"),
        "hours", "billable_flag", "rate_usd", "date",
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string"), F.lit(" line "),
                 F.col("l_linenumber").cast("string")).alias("narrative"),
        *(_lineage("lineitem") if lineage else []),
    )


def doc_audit(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        _prefixed("A-", eid).alias("audit_id"),
        F.when(eid % 33 == 0, F.lit(None).cast("string")).otherwise(_prefixed("D-", eid % 600)).alias("doc_id"),
        F.when(eid % 71 == 0, F.lit(None).cast("string")).otherwise(_prefixed("M-", F.col("user_id"))).alias("matter_id"),
        _case(F.col("event_type"), ACTION_BY_EVENT_TYPE).alias("action"),
        _prefixed("U-", eid % 50).alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (eid % 256).cast("string")).alias("client_ip"),
        *(_lineage("events") if lineage else []),
    )


STANDIN = {
    "matters_master": matters_master,
    "matters": matter_events,
    "time_entries": time_entries,
    "doc_audit": doc_audit,
}


def standin_source(spark: SparkSession, sf_dir: str, source: str, lineage: bool = True) -> DataFrame:
    return STANDIN[source](spark, sf_dir, lineage)
