"""Readers for the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; zone-less timestamps (TIMESTAMP_NTZ) become session-zone TIMESTAMPs."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if not ntz:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns])
