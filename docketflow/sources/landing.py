"""Landing-zone writers and readers: JSON-lines files, one sub-folder per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.schemas import RAW_SCHEMAS

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def to_landing_shape(df: DataFrame, source: str) -> DataFrame:
    """Project to the raw schema; timestamps/dates become the ISO-8601 text found in landing files."""
    out = []
    for f in RAW_SCHEMAS[source].fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        dt = df.schema[f.name].dataType
        c = F.col(f.name)
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c.cast("timestamp"), ISO_TS)
        elif isinstance(dt, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


#: Rows of a landed file; fewer if compressed, as readers can't split it.
MAX_RECORDS, MAX_RECORDS_COMPRESSED = 1_000_000, 250_000


def _json_writer(df: DataFrame, compression: str | None) -> DataFrameWriter:
    writer = df.write.option("ignoreNullFields", "false")
    if compression:
        writer = writer.option("compression", compression)
    return writer


def land_json_batch(df: DataFrame, landing: str, source: str, files: int | None = None,
                    max_records_per_file: int | None = None, compression: str | None = None) -> str:
    """Append one batch of JSON-lines files (explicit nulls kept) under ``landing/source``.

    ``files`` fixes the number of files (round-robin repartition, for small test
    batches); by default the input partitioning is kept -- no shuffle, one writer per
    partition -- and ``max_records_per_file`` caps file size without a shuffle (fewer
    by default if compressed).
    """
    max_records_per_file = max_records_per_file or (MAX_RECORDS_COMPRESSED if compression else MAX_RECORDS)
    out = to_landing_shape(df, source)
    if files:
        out = out.repartition(files)
    path = f"{landing.rstrip('/')}/{source}"
    _json_writer(out, compression).mode("append").option("maxRecordsPerFile", str(max_records_per_file)).json(path)
    return path


def land_master_once(df: DataFrame, landing: str, source: str = "matters_master", compression: str | None = None) -> str:
    """Write the dimension files unless an earlier write was committed (write-once).

    A folder without Spark's ``_SUCCESS`` marker is what a crashed write left: it is
    written anew.  Keeps the input partitioning: a large dimension is written by many
    tasks, not funnelled through one to get a single file.
    """
    path = f"{landing.rstrip('/')}/{source}"
    spark = df.sparkSession
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        _json_writer(to_landing_shape(df, source), compression).mode("overwrite").json(path)
    return path


def infer_raw_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """One-off batch inference over landed files, to freeze as a StructType.

    Streaming sources take this frozen schema; inference over dirty data widens
    columns and adds unknown keys, so review it before adopting.
    """
    return spark.read.option("samplingRatio", sampling_ratio).json(path).schema
