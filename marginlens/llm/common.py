"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.session import scratch_path
from marginlens.sources.tables import driver_table


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage so a lost executor re-reads files instead of recomputing
    the upstream stages, and gives Catalyst real file sizes for its join
    choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more (what was made from it
    is written), and drop the shuffle files of finished jobs."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    drop_shuffles(spark)


def drop_shuffles(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of finished jobs: Spark deletes them
    when it collects their references, which a short run with much memory never
    does by itself."""
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``addPyFile``), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "marginlens-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def file_uri(path: str) -> str:
    """``path`` as a URI that pyarrow's filesystems accept."""
    if re.match(r"file:/[^/]", path):
        return "file://" + path[len("file:"):]
    return path if "://" in path else "file://" + path


def open_fs(path: str):
    """``(filesystem, path)`` for a shared folder, from inside a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(file_uri(path))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str) -> F.Column:
    return F.coalesce(F.col(col), F.lit(""))


__all__ = ["staged", "release", "drop_shuffles", "open_fs", "file_uri", "text_or_empty", "fresh", "ship_package", "driver_table", "DataFrame", "SparkSession"]
