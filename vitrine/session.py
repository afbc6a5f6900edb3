"""Spark session and shared scratch locations.

Every job that needs intermediate files (checkpoints, landed JSON, warehouse
tables written by a query, streaming checkpoints) puts them below the folder
the cluster names in ``spark.checkpoint.dir``.  Only when that setting is
absent (unit tests, a laptop) do we pick a local folder ourselves.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int) -> dict:
    """Settings for a large cluster (e.g. 1000 executors, 100 TB input).

    Shuffle partitions start high (about 3 per core) and AQE coalesces them to
    ~256 MB each at run time, so one value fits every stage; scan splits of
    512 MB keep the task count of a 100 TB scan near 200 000; skewed join
    partitions are split at run time; window state lives in RocksDB.
    """
    return {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vitrine", extra: dict | None = None) -> SparkSession:
    """A session for tests, the bench (both name a local master) and the command line.

    Without ``master`` the launcher's one counts (``spark-submit --master``), and the
    settings of ``cluster_conf`` are defaults: whatever was given to spark-submit
    or in spark-defaults.conf stays.
    """
    builder = SparkSession.builder.appName(app_name)
    given = dict(extra or {})
    if master:
        builder = builder.master(master)
        given = {**SESSION_CONF, **given}
    if shuffle_partitions:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not master:
        explicit = dict(spark.sparkContext.getConf().getAll())
        for key, value in default_settings(spark.sparkContext.defaultParallelism, explicit).items():
            spark.conf.set(key, value)
    ensure_session_settings(spark)
    return spark


def default_settings(total_cores: int, explicit: dict) -> dict:
    """The SQL settings of ``cluster_conf`` that nobody has given."""
    return {k: v for k, v in cluster_conf(total_cores).items() if k.startswith("spark.sql.") and k not in explicit}


def ensure_session_settings(spark: SparkSession) -> None:
    """UTC is part of the semantics (epoch-ms <-> dates); pin it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    scratch_root(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate data: ``spark.checkpoint.dir``.

    Read from the session; only when unset, and only under a local master, do we
    create a local one (tests) and register it, so ``DataFrame.checkpoint()``
    writes there too.  On a cluster a local folder would be lost data: refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        refuse_local_scratch(spark.sparkContext.master)
        root = tempfile.mkdtemp(prefix="vitrine-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def refuse_local_scratch(master: str) -> None:
    """Raises where executors do not share the driver's disk."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared scratch root."""
    return f"{scratch_root(spark)}/vitrine/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a Parquet table below the shared scratch folder.

    Preferred over ``checkpoint()`` for wide rows read by several branches:
    columnar and compressed, and each branch reads back only its columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
