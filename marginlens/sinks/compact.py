"""Compaction and joint clustering of a stored, partitioned Parquet table.

Many small files per partition (left by loads, streams and partial rewrites)
become ``ceil(bytes / target)`` files of even size, and the rows of every file
are close in *all* cluster columns: each column is replaced by its rank in
``2 ** bits`` buckets, the buckets' bits are interleaved, and the rows are
sorted by that number (the open-format stand-in for ``OPTIMIZE ... ZORDER``).
A file then spans a narrow range of every cluster column, not of the first
only, so min/max statistics skip files on either.

What has been laid out is recorded beside the data (``_layout``: partition,
layout, fingerprint of its files). A partition whose files are still those is
left alone, so a second run writes nothing, and after a load only the
partitions that it touched are rewritten.

File names and sizes come from Spark's own listing; the driver holds one row
per partition directory. No task gets more than one output file's rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.functions.joins import staged
from marginlens.functions.ranks import interleaved, numbered, rank_buckets
from marginlens.sinks.upsert import in_partitions
from marginlens.sources.tables import _fs, table_exists

TARGET_BYTES = 256 * 1024 * 1024
BITS = 8


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per partition directory: ``dir, files, bytes, fingerprint``."""
    fs, root = _fs(spark, path)
    prefix = fs.makeQualified(root).toString().rstrip("/") + "/"
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
              .load(path).select("path", "length", "modificationTime"))
    name = F.substr(F.regexp_replace("path", "^file:/+", "file:/"), F.lit(len(prefix.replace("file:///", "file:/")) + 1))
    file_id = F.xxhash64(name, "length", "modificationTime")
    return (listed.withColumn("_name", name).withColumn("_file", file_id)
            .filter(~F.col("_name").rlike(r"(^|/)[_.][^=/]*(/|$)"))
            .groupBy(F.regexp_extract("_name", "^(.*)/[^/]*$", 1).alias("dir"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor("_file").alias("fingerprint")))


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}/_layout"


def _stale(spark: SparkSession, path: str, layout: str) -> dict[str, tuple[int, int]]:
    """Partition directory -> (files, bytes) of those not laid out as asked."""
    now = partition_files(spark, path)
    if table_exists(spark, _layout_path(path)):
        known = spark.read.parquet(_layout_path(path)).filter(F.col("layout") == layout)
        now = now.join(known, ["dir", "fingerprint"], "left_anti")
    return {r["dir"]: (r["files"], r["bytes"]) for r in now.collect()}


def _record(spark: SparkSession, path: str, layout: str) -> None:
    """Write the layout table anew; losing it costs one more compaction, no data."""
    now = staged(partition_files(spark, path).select("dir", "fingerprint", F.lit(layout).alias("layout")), "layout")
    now.write.mode("overwrite").parquet(_layout_path(path))


def compact(spark: SparkSession, path: str, contract, partition_by: Sequence[str], cluster_by: Sequence[str],
            tie_break: Sequence[str], target_bytes: int = TARGET_BYTES, bits: int = BITS) -> list[str]:
    """Compact and cluster the table at ``path`` (schema ``contract``); returns
    the partition directories it rewrote. ``tie_break`` should make the order
    of rows total, so that a lost task writes the same file again."""
    parts, cluster = list(partition_by), list(cluster_by)
    layout = f"{','.join(cluster)};{','.join(tie_break)};{bits};{target_bytes}"
    stale = _stale(spark, path, layout)
    if not stale:
        return []
    table = spark.read.schema(contract).parquet(path).select(*contract.names)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString

    def folder(row) -> str:
        return "/".join(escape(c, row[c]) for c in parts)

    # the partitions to rewrite, with their rows, files to make and the number of their first file
    text = [F.col(c).cast("string").alias(c) for c in parts]
    per = [(r, r["_n"]) for r in table.groupBy(*text).agg(F.count(F.lit(1)).alias("_n")).collect() if folder(r) in stale]
    plan, first = [], 0
    for row, n in sorted(per, key=lambda x: folder(x[0])):
        k = min(n, -(-stale[folder(row)][1] // target_bytes))
        plan.append((*[row[c] for c in parts], n, k, first))
        first += k
    types = {f.name: f.dataType for f in contract.fields}
    todo = spark.createDataFrame(plan, ", ".join([f"`{c}` string" for c in parts] + ["_n long", "_k long", "_first long"]))
    todo = staged(todo.select(*[F.col(c).cast(types[c]).alias(c) for c in parts], "_n", "_k", "_first"), "compaction_plan")
    rows = in_partitions(table, todo, parts)

    # joint order: interleaved rank buckets of the cluster columns
    for i, c in enumerate(cluster):
        buckets = staged(rank_buckets(rows, c, bits, f"_b{i}").withColumnRenamed(c, f"_v{i}"), "rank_buckets")
        rows = rows.join(buckets, F.col(c).eqNullSafe(F.col(f"_v{i}"))).drop(f"_v{i}")
    rows = rows.withColumn("_z", interleaved([f"_b{i}" for i in range(len(cluster))], bits))
    order = [*parts, "_z", *cluster, *tie_break]
    laid = staged(numbered(rows.drop(*[f"_b{i}" for i in range(len(cluster))])
                           .repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)), "clustered")

    # a row's file: its share of the partition's rows
    starts = laid.groupBy(*parts).agg(F.min("_pos").alias("_start"))
    both = starts.join(todo.withColumnsRenamed({c: f"_t_{c}" for c in parts}),
                       [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts])
    both = staged(both.select(*[F.col(f"_t_{c}") for c in parts], "_start", "_n", "_k", "_first"), "file_plan")
    filed = laid.join(both, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts])
    number = F.col("_first") + F.floor((F.col("_pos") - F.col("_start")) * F.col("_k") / F.col("_n")).cast("long")
    out = (filed.withColumn("_file", F.least(number, F.col("_first") + F.col("_k") - 1).cast("int"))
           .repartitionById(first, "_file").sortWithinPartitions(*parts, "_pos").select(*contract.names))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 0)
     .partitionBy(*parts).parquet(path))
    _record(spark, path, layout)
    return sorted(stale)


__all__ = ["compact", "partition_files", "TARGET_BYTES", "BITS"]
