"""SparkSession construction and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "docketflow", cpus: int | str = "*", shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, driver_memory: str = "8g") -> SparkSession:
    """Local session with the settings the engine assumes (UTC, AQE, no UI).

    On a cluster, build the session with the cluster's own master/resources and keep
    only the SQL settings; ``shuffle_partitions`` should then be sized so one partition
    holds ~128-256 MB of shuffle data (AQE coalesces small ones at runtime).
    """
    n = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for landing files, checkpoints and layer tables.

    Uses the cluster's ``spark.checkpoint.dir``.  A session in this one process
    (``local[n]``, as in tests) may do without: it gets a folder of its own.
    """
    conf = spark.sparkContext.getConf()
    conf_dir = conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        master = conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docketflow-"))
        conf_dir = spark.sparkContext.getCheckpointDir()
    return conf_dir.rstrip("/") + "/docketflow"


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A never-before-used sub-folder of the shared work root."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
