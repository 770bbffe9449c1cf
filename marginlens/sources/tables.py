"""Path-based Parquet tables (the lakehouse layers)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a committed table: a ``_SUCCESS`` marker, or
    (partitioned tables written in dynamic-overwrite mode leave none) at
    least one visible file or partition directory."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")):
        return True
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def source_state(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple:
    """Names, sizes and change times of the tables' files: differs once a source changes."""
    out = []
    for name in names:
        fs, p = _fs(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        for s in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p}{{,/*}}")) or []:
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def table_state(spark: SparkSession, path: str, names: str = "*.parquet") -> str:
    """A fingerprint of a table's files (number, bytes, names, sizes, change
    times); ``absent`` without a table. Listed by Spark, folded to one row."""
    if not table_exists(spark, path):
        return "absent"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names)
             .load(path).select("path", "length", "modificationTime"))
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                    F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("files")).first()
    return f"{row['n']}:{row['bytes'] or 0}:{(row['files'] or 0) & (1 << 64) - 1:x}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``lineitem``, ``supplier`` ...)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, cols: list[str] | None = None, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores.

    A Parquet split cannot be smaller than a row group, so a small table
    written as one row group scans in one task and everything fused after it
    (projections, broadcast joins) runs single-threaded. Large inputs already
    have at least this many splits and pass through untouched (no shuffle).
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *cols) if cols else df.repartition(want)
