"""Synthetic landing data as a Spark job (reproducible: seed + batch id, no wall clock).

Every random draw is a pure function of (seed, source, batch, file, row, salt)
through ``xxhash64``, so a batch regenerates identically anywhere and any number
of executors can produce it.  A fact batch is built from
``spark.range(files, numPartitions=files)``: one partition per output file, rows
exploded inside it (narrow), so writing yields exactly one JSON-lines file per
planned file with no shuffle.  Id pools are formulas of the pool index, never
materialised lists.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.sources.landing import land_json_batch, land_master_once

# Fixed values of the generator (domain vocabulary and weights).
PRACTICE_AREAS = (("M&A", 3), ("Litigation", 5), ("IP", 2), ("Real Estate", 2), ("Employment", 3), ("Tax", 1),
                  ("Regulatory", 2))
REGIONS = (("NA", 5), ("EMEA", 3), ("APAC", 2), ("LATAM", 1))
BILLING = (("hourly", 1), ("fixed_fee", 1), ("retainer", 1), ("contingency", 1))
EVENT_TYPES = (("opened", 1), ("status_change", 5), ("note_added", 4), ("closed", 1))
BAD_EVENT_TYPES = (("deleted_event", 1), ("EVENT", 1), ("", 1), ("completed", 1))
DOC_ACTIONS = (("view", 60), ("edit", 20), ("share", 8), ("download", 10), ("delete", 2))
BAD_DOC_ACTIONS = (("modify", 1), ("READ", 1), ("duplicate", 1), ("", 1))
OFFICES = (("NYC", 1), ("LON", 1), ("CHI", 1), ("SFO", 1), ("BLR", 1))
RATES = ((250, 1), (350, 1), (450, 1), (600, 1), (850, 1), (1100, 1))
ROWS_PER_FILE = {"matters": (50, 500), "time_entries": (80, 500), "doc_audit": (100, 500)}
NAME_WORDS = ("Apex", "Birch", "Cobalt", "Delta", "Ember", "Fulton", "Granite", "Harbor", "Iris", "Juniper",
              "Keystone", "Lumen", "Meridian", "Northwind", "Orchid", "Pioneer", "Quarry", "Redwood", "Summit",
              "Tidewater")
NAME_SUFFIXES = ("LLC", "Inc", "Group", "Partners", "Holdings", "Ltd")
SENTENCE_WORDS = ("review", "draft", "motion", "client", "call", "contract", "memo", "research", "filing",
                  "discovery", "meeting", "revise", "agreement", "analysis", "court", "deposition", "email",
                  "strategy", "notes", "summary")


@dataclass(frozen=True)
class SynthConfig:
    seed: int = 42
    files_per_source: int = 5
    bad_data_pct: float = 0.05
    as_of: str = "2024-01-17T00:00:00"
    matters: int = 200
    users: int = 50
    docs: int = 600

    def __post_init__(self) -> None:
        if not 0.0 <= self.bad_data_pct <= 0.5:
            raise ValueError("bad_data_pct must be in [0.0, 0.5]")
        if self.files_per_source < 1:
            raise ValueError("files_per_source must be >= 1")


class _Draw:
    """Uniform draws keyed by (seed, source, batch, file, row, salt)."""

    def __init__(self, cfg: SynthConfig, source: str, batch_id: str, keys: list[Column]) -> None:
        self.base = [F.lit(cfg.seed), F.lit(source), F.lit(batch_id), *keys]

    def u(self, salt: str) -> Column:
        h = F.xxhash64(*self.base, F.lit(salt))
        return F.pmod(h, F.lit(1 << 52)).cast("double") / float(1 << 52)

    def int_between(self, salt: str, lo: int, hi: int) -> Column:
        return (F.lit(lo) + F.floor(self.u(salt) * (hi - lo + 1))).cast("bigint")

    def uniform(self, salt: str, lo: float, hi: float) -> Column:
        return F.lit(lo) + self.u(salt) * (hi - lo)

    def weighted(self, salt: str, choices) -> Column:
        total = float(sum(w for _, w in choices))
        u = self.u(salt)
        acc, expr = 0.0, None
        for value, w in choices[:-1]:
            acc += w / total
            expr = F.when(u < acc, F.lit(value)) if expr is None else expr.when(u < acc, F.lit(value))
        last = F.lit(choices[-1][0])
        return expr.otherwise(last) if expr is not None else last


def _pool_id(cfg: SynthConfig, kind: str, idx: Column) -> Column:
    h = F.pmod(F.xxhash64(F.lit(cfg.seed), F.lit(f"pool-{kind}"), idx), F.lit(1 << 40))
    if kind == "matter":
        return F.format_string("M-%05d-%04d", (F.lit(10000) + h % 90000).cast("int"), idx.cast("int"))
    if kind == "doc":
        return F.format_string("D-%06d-%05d", (F.lit(100000) + h % 900000).cast("int"), idx.cast("int"))
    return F.format_string("U-%04d", idx.cast("int"))


def _as_of(cfg: SynthConfig) -> Column:
    return F.to_timestamp(F.lit(cfg.as_of))


def matters_master(spark: SparkSession, cfg: SynthConfig = SynthConfig()) -> DataFrame:
    rows = spark.range(cfg.matters).withColumnRenamed("id", "idx")
    d = _Draw(cfg, "matters_master", "once", [F.col("idx")])
    name = F.concat_ws(" ", F.element_at(F.array(*map(F.lit, NAME_WORDS)),
                                         d.int_between("name1", 1, len(NAME_WORDS)).cast("int")),
                       F.element_at(F.array(*map(F.lit, NAME_SUFFIXES)),
                                    d.int_between("name2", 1, len(NAME_SUFFIXES)).cast("int")))
    days = d.int_between("opened", 30, 720)
    return rows.select(
        _pool_id(cfg, "matter", F.col("idx")).alias("matter_id"),
        name.alias("client_name"),
        d.weighted("area", PRACTICE_AREAS).alias("practice_area"),
        d.weighted("region", REGIONS).alias("region"),
        (_as_of(cfg) - F.make_interval(days=days.cast("int"))).alias("opened_at"),
        _pool_id(cfg, "user", d.int_between("partner", 0, min(10, cfg.users) - 1)).alias("partner_lead_user_id"),
        d.weighted("billing", BILLING).alias("billing_arrangement"),
    )


def _file_rows(spark: SparkSession, cfg: SynthConfig, source: str, batch_id: str) -> tuple[DataFrame, _Draw]:
    lo, hi = ROWS_PER_FILE[source]
    files = spark.range(0, cfg.files_per_source, 1, cfg.files_per_source).withColumnRenamed("id", "file")
    n = _Draw(cfg, source, batch_id, [F.col("file")]).int_between("n_rows", lo, hi)
    rows = files.select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("row"))
    return rows, _Draw(cfg, source, batch_id, [F.col("file"), F.col("row")])


def _row_id(prefix: str, batch_id: str) -> Column:
    return F.format_string(f"{prefix}-{batch_id}-%d-%d", F.col("file"), F.col("row"))


def matter_events(spark: SparkSession, cfg: SynthConfig, batch_id: str) -> DataFrame:
    rows, d = _file_rows(spark, cfg, "matters", batch_id)
    bad = d.u("bad") < cfg.bad_data_pct
    seconds = d.int_between("days", 0, 90) * 86400 + d.int_between("secs", 0, 86400)
    return rows.select(
        _row_id("EV", batch_id).alias("event_id"),
        F.when(bad & (d.u("null_matter") < 0.5), F.lit(None).cast("string"))
        .otherwise(_pool_id(cfg, "matter", d.int_between("matter", 0, cfg.matters - 1))).alias("matter_id"),
        F.when(bad, d.weighted("bad_type", BAD_EVENT_TYPES)).otherwise(d.weighted("type", EVENT_TYPES))
        .alias("event_type"),
        (_as_of(cfg) - F.make_interval(secs=seconds.cast("int"))).alias("timestamp"),
        _pool_id(cfg, "user", d.int_between("user", 0, cfg.users - 1)).alias("user_id"),
        d.weighted("office", OFFICES).alias("office"),
    )


def time_entries(spark: SparkSession, cfg: SynthConfig, batch_id: str) -> DataFrame:
    rows, d = _file_rows(spark, cfg, "time_entries", batch_id)
    bad = d.u("bad") < cfg.bad_data_pct
    r = d.u("variant")
    good_hours = d.uniform("hours", 0.1, 8.0)
    hours = (
        F.when(bad & (r < 0.4), -d.uniform("neg", 0.5, 4.0))
        .when(bad & (r < 0.7), d.uniform("long", 25.0, 72.0))
        .otherwise(good_hours)
    )
    words = F.transform(
        F.sequence(F.lit(1), F.lit(8)),
        lambda i: F.element_at(
            F.array(*map(F.lit, SENTENCE_WORDS)),
            (F.pmod(F.xxhash64(F.lit(cfg.seed), F.lit(batch_id), F.col("file"), F.col("row"), i),
                    F.lit(len(SENTENCE_WORDS))) + 1).cast("int"),
        ),
    )
    return rows.select(
        _row_id("TE", batch_id).alias("entry_id"),
        _pool_id(cfg, "matter", d.int_between("matter", 0, cfg.matters - 1)).alias("matter_id"),
        F.when(bad & (r >= 0.7), F.lit(None).cast("string"))
        .otherwise(_pool_id(cfg, "user", d.int_between("user", 0, cfg.users - 1))).alias("user_id"),
        F.round(hours, 2).alias("hours"),
        (d.u("billable") < 0.85).alias("billable_flag"),
        d.weighted("rate", RATES).cast("bigint").alias("rate_usd"),
        F.date_sub(F.to_date(_as_of(cfg)), d.int_between("days", 0, 60).cast("int")).alias("date"),
        F.concat(F.initcap(F.array_join(words, " ")), F.lit(".")).alias("narrative"),
    )


def doc_audit(spark: SparkSession, cfg: SynthConfig, batch_id: str) -> DataFrame:
    rows, d = _file_rows(spark, cfg, "doc_audit", batch_id)
    bad = d.u("bad") < cfg.bad_data_pct
    seconds = d.int_between("secs", 0, 90 * 86400)
    ip = F.format_string("%d.%d.%d.%d", d.int_between("ip1", 1, 223), d.int_between("ip2", 0, 255),
                         d.int_between("ip3", 0, 255), d.int_between("ip4", 1, 254))
    return rows.select(
        _row_id("DA", batch_id).alias("audit_id"),
        F.when(bad & (d.u("null_doc") < 0.4), F.lit(None).cast("string"))
        .otherwise(_pool_id(cfg, "doc", d.int_between("doc", 0, cfg.docs - 1))).alias("doc_id"),
        _pool_id(cfg, "matter", d.int_between("matter", 0, cfg.matters - 1)).alias("matter_id"),
        F.when(bad, d.weighted("bad_action", BAD_DOC_ACTIONS)).otherwise(d.weighted("action", DOC_ACTIONS))
        .alias("action"),
        _pool_id(cfg, "user", d.int_between("user", 0, cfg.users - 1)).alias("user_id"),
        (_as_of(cfg) - F.make_interval(secs=seconds.cast("int"))).alias("timestamp"),
        ip.alias("client_ip"),
    )


FACT_GENERATORS = {"matters": matter_events, "time_entries": time_entries, "doc_audit": doc_audit}


def land_synthetic(spark: SparkSession, landing: str, cfg: SynthConfig = SynthConfig(),
                   batch_id: str | None = None) -> str:
    """Dimension once (write-once) plus one new batch of ``files_per_source`` files per fact source."""
    batch_id = batch_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    land_master_once(matters_master(spark, cfg), landing)
    for source, gen in FACT_GENERATORS.items():
        land_json_batch(gen(spark, cfg, batch_id), landing, source)
    return batch_id
