"""Joins against derived small tables whose size is known before the join.

A derived table (per-cohort medians, per-group bounds) has no file size that
Catalyst can see at planning time, so a plain join would shuffle the big side
even when the small side has a handful of rows. ``staged`` writes the table
under the session's checkpoint folder and reads it back: it is computed once,
a lost executor re-reads files, and Catalyst broadcasts it exactly when its
bytes are under ``spark.sql.autoBroadcastJoinThreshold``. No hint is forced.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginlens.session import CODEC, scratch_path


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """``df`` written to a fresh scratch table and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", CODEC).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of finished jobs: Spark deletes them
    when it collects their references, which a short run with much memory never
    does by itself."""
    spark.sparkContext._jvm.System.gc()


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join after staging ``small``; the planner sees its real size."""
    return big.join(staged(small, "join_side"), on, how)
