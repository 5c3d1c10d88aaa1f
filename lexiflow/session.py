"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lexiflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and benchmarks. On a cluster, use the cluster's own session."""
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEXIFLOW_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, reading ``spark.checkpoint.dir`` from the session.

    A directory of our own is set only when none is configured and Spark runs in
    local mode (tests, the benchmark); on a cluster an unset directory is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running lexiflow on a cluster")
    local_dir = tempfile.mkdtemp(prefix="lexiflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialises ``df`` in the checkpoint folder and drops its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_folder(spark: SparkSession) -> str:
    """Folder of this session's intermediate tables, inside the checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored"


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table into the checkpoint directory and read it back: cuts the
    lineage, several branches read one result with column pruning, and the planner knows
    its size. ``by``: columns whose values have files of their own."""
    spark = df.sparkSession
    path = f"{stored_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_stored(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session, once the results that read them are written."""
    delete_path(spark, stored_folder(spark))
