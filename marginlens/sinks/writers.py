"""Overwrite, partitioned + clustered, and CSV report writers."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.session import CODEC


def overwrite(df: DataFrame, path: str) -> None:
    """Full reload (Bronze, quarantine): replace data and schema."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def clustered_layout(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str],
                     tie_break: Sequence[str] = (), num_ranges: int | None = None) -> DataFrame:
    """Rows laid out for a partitioned write clustered on ``cluster_by``.

    ``repartitionByRange`` samples the data to cut (partition, cluster,
    tie_break) into ranges of similar size. Without ``num_ranges`` there are as
    many as shuffle partitions at most, and AQE merges ranges that are small in
    bytes, so the number of files follows the data; ``tie_break`` (e.g. the table key)
    lets one hot (partition, cluster) value span several ranges, and so
    several writer tasks, instead of landing in one. Sorting on the partition
    columns first satisfies the partitioned writer's required ordering, so it
    adds no sort of its own that would scramble the order inside each file.
    """
    range_cols = list(partition_by) + list(cluster_by) + list(tie_break)
    cols = [F.col(c) for c in range_cols]
    ranges = df.repartitionByRange(num_ranges, *cols) if num_ranges else df.repartitionByRange(*cols)
    return ranges.sortWithinPartitions(*range_cols)


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str],
                    cluster_by: Sequence[str], tie_break: Sequence[str] = (),
                    num_ranges: int | None = None) -> None:
    """Partitioned overwrite with rows clustered on ``cluster_by`` inside each
    partition, so Parquet min/max statistics skip row groups on those columns
    (the open-format stand-in for Z-ordering)."""
    laid = clustered_layout(df, partition_by, cluster_by, tie_break, num_ranges)
    laid.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False, compression: str = "none") -> None:
    """Report export with a header row. ``single_file`` only for small reports;
    ``compression`` for exports that grow with the data."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
