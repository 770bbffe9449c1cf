"""Spark session helpers.

The library never hard-codes a scratch location: lineage cuts and staged
writes go under ``spark.checkpoint.dir`` (a shared folder on a cluster). Only
when that setting is absent -- local runs and tests -- do we pick one.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session options the library relies on. AQE re-plans joins from measured
# sizes, coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(app_name: str = "marginlens", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # an existing session keeps its launch config; apply the runtime options,
    # caller-supplied values last so they win over the defaults
    for k, v in {**DEFAULT_CONF, **{k: v for k, v in (extra or {}).items() if k.startswith("spark.sql.")}}.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Local/test sessions only: no cluster-wide folder was named.
        configured = tempfile.mkdtemp(prefix="marginlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


#: Layers and staged tables are written with it whatever the session's codec is.
CODEC = "zstd"
RUN_ID = uuid.uuid4().hex  # one scratch folder per process


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/marginlens-scratch/{RUN_ID}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a staged/scratch table under the checkpoint folder."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def cleanup_scratch(spark: SparkSession) -> None:
    """Delete this process's scratch tables (call when their DataFrames are no
    longer needed, e.g. before stopping the session)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


__all__ = ["get_spark", "checkpoint_dir", "ensure_checkpoint_dir", "scratch_path", "cleanup_scratch"]
