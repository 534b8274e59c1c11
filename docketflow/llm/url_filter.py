"""Operator 4: URL filter rules behind a blocked Bloom filter.

The listed canonical URLs are the rules' ``host + path`` (the host and all its subdomains,
every path with that beginning).  A page's URL has one key for each ending of its host
and each listed path length; keys that pass the filter meet the list in an exact hash
join, which removes the false positives, and the longest rule that fits wins.  The
filter has a fixed size, so what is sent to the executors is bounded; a longer list only
lets more keys through to the join.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule;
a URL that no rule fits isn't listed, so it is allowed; a rule that is given twice
counts once (block before allow); rules with a null part never fit;
URLs of any length are judged whole; repeated rows are judged each; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The rules as (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: 2**15 blocks of 512 bits: 2 MB, whatever the length of the list.
BLOCKS, WORDS, PROBES = 1 << 15, 8, 6
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url):
    """(host, path) columns: the host is lower-cased in A-Z, the path is without query and fragment."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)"))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, *LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def bits_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block of each 64-bit hash and its PROBES bits in that block's 512."""
    u = h.astype(np.int64).view(np.uint64)
    block = (u >> np.uint64(49)).astype(np.int64) % BLOCKS
    probes = np.stack([((u >> np.uint64(9 * (k % 5))) + np.uint64(k // 5) * (u >> np.uint64(45))) % np.uint64(512) for k in range(PROBES)], 1)
    return block, probes.astype(np.int64)


def bloom(keys: DataFrame) -> np.ndarray:
    """The filter of the 64-bit ``h`` of ``keys``: filled per block by the executors, one row per used block comes back."""

    def fill(batches):
        for rows in batches:
            block, probes = bits_of(rows["h"].to_numpy())
            at = pd.DataFrame({"block": np.repeat(block, PROBES), "word": (probes >> 6).ravel(), "bit": (np.uint64(1) << (probes & 63).astype(np.uint64)).ravel().view(np.int64)})
            yield at.drop_duplicates()

    used = keys.mapInPandas(fill, "block long, word long, bit long").groupBy("block", "word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros((BLOCKS, WORDS), np.int64)
    for r in used.toLocalIterator():
        out[r["block"], r["word"]] = r["bits"]
    return out


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, url, host, path, rule, verdict.  ``rules`` has host, path and verdict."""
    spark = pages.sparkSession
    listed = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("h", F.xxhash64("host", "path"))
    lengths = [r[0] for r in listed.select(F.length("path")).distinct().collect()]  # at most as many as a path has characters
    shared = spark.sparkContext.broadcast(bloom(listed.select("h")))

    @F.pandas_udf("boolean")
    def may_be_listed(h: pd.Series) -> pd.Series:
        block, probes = bits_of(h.to_numpy())
        words = shared.value[block[:, None], probes >> 6].view(np.uint64)
        return pd.Series((((words >> (probes & 63).astype(np.uint64)) & np.uint64(1)) == 1).all(1))

    host, path = split_url(F.col("_u"))
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("_u")).withColumn("host", host).withColumn("path", path)
    endings = F.expr(r"transform(sequence(1, size(split(host, '[.]'))), k -> substring_index(host, '.', -k))")
    starts = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)] or [F.lit(None).cast("int")]), lambda n: n <= F.length("path"))
    keys = src.select("host", "path").where("host != '' or path != ''").distinct().withColumn("end", F.explode(endings)).withColumn("n", F.explode(starts)).withColumn("start", F.expr("substring(path, 1, n)"))
    passed = keys.withColumn("h", F.xxhash64("end", "start")).where(may_be_listed("h"))
    fits = passed.join(listed.select(F.col("host").alias("end"), F.col("path").alias("start"), "verdict"), ["end", "start"])
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length(F.concat("end", "start")).alias("n"), F.concat("end", "start").alias("rule"), "verdict")).alias("best"))
    found = src.join(best, ["host", "path"], "left")
    return found.select("id", F.col("_u").alias("url"), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "verdict string, host string, path string")


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``pages``: page_id, host, path, rule, verdict."""
    found = filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_table(spark))
    return found.withColumnRenamed("id", "page_id").select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
with u as (select page_id, case when url like '%://%' then substr(url, instr(url, '://') + 3) end as rest from pages),
p as (select page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
r as (select * from (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(verdict, rhost, rpath)),
m as (select p.page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(verdict, length(rhost || rpath)) as verdict
      from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by p.page_id)
select p.page_id, host, path, m.rule, coalesce(m.verdict, 'allow') as verdict from p left join m using (page_id)
"""
