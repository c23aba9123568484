"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "inkwell") -> SparkSession:
    """Local session with the settings the library assumes (UTC, AQE, no UI).

    On a cluster, build the session with the cluster's own settings instead; the
    library only relies on ``spark.sql.session.timeZone=UTC`` for the ISO time
    columns.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("INKWELL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(SPREAD_CONF, str(shuffle_partitions or int(cpus)))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and round-trip tables.

    Uses the cluster's ``spark.checkpoint.dir`` when the session names one; only
    when it is unset (local tests) a private temporary folder is created.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="inkwell-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tasks that a scan of single-file tables is dealt to; unset on a cluster, where scans have many splits.
SPREAD_CONF = "spark.inkwell.spreadPartitions"


def spread(df: DataFrame, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Deal the rows of a scan to ``partitions`` tasks by ``key`` (default: the first column, the row id).

    Single-file inputs are one task; CPU-heavy text expressions then run on one core. Without the
    parameter the session's ``spark.inkwell.spreadPartitions`` holds, and without that the scan stays
    as it is: no shuffle is added, and the plan is not looked at. Hash partitioning is
    deterministic on recomputation without the sort that a round-robin repartition needs.
    """
    n = partitions or int(df.sparkSession.conf.get(SPREAD_CONF, "0"))
    return df.repartition(n, F.col(key or df.columns[0])) if n else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared scratch folder (survives executor loss)."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left in the driver: Spark drops the shuffles, broadcasts and plans of
    frames that nobody holds any more when the driver's JVM collects its garbage."""
    gc.collect()
    spark._jvm.java.lang.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of the scratch folder: compressed, and of a size that the planner knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
