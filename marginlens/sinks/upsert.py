"""Keyed idempotent upsert on plain Parquet tables.

Semantics of a ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``
without deletes: target rows whose key appears in ``updates`` are replaced,
new keys are inserted, everything else is kept. NULL keys never match (SQL
equality), so they are always inserted. Running the same upsert twice gives
the same table.

Plan: ``target ⋈ left_anti updates(keys)`` ∪ ``updates`` -- one shuffle on
the key for the anti-join, no per-row Python.

* Unpartitioned table: the merged table is written to a sibling staging
  directory and swapped in (a table being read cannot be overwritten in
  place). Between the swap's two renames readers find no table; on an object
  store a rename is a copy. A catalog with row-level operations should use
  ``DataFrame.mergeInto`` instead.
* Partitioned table: the partitions that hold an updated key or receive an
  update are read, merged and replaced (dynamic partition overwrite); the rest
  is not rewritten. A key whose partition changed leaves the old one, and a
  partition that becomes empty is removed. Partition values keep the type of
  the update batch, so ``01`` stays text, and NULL is a partition like others.

  Where an updated key is stored now is found in one of three ways: the caller
  knows (``known``); a key never changes its partition (``moves=False``), so
  only the batch's own partitions can hold it and no other is opened; else the
  key and partition columns of the table are searched, nothing wider.

The update batch is staged once; check, merge and partition search read that.

:func:`upsert_latest` also returns the old and new image of every changed row,
so that what is derived from the table can follow without reading it again.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.functions.joins import release, staged
from marginlens.session import CODEC, scratch_path
from marginlens.sinks.writers import clustered_layout
from marginlens.sources.tables import _fs, table_exists


OPEN_FILES = 40  # partitions of gathered rows that a task writes without sorting by partition


class DuplicateKeyError(ValueError):
    """The update batch holds a key more than once (ambiguous merge)."""


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])  # NULL keys never match
    dup = (df.filter(keyed)
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"update batch has duplicate keys, e.g. {dup[0].asDict()}")


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The post-merge rows: unmatched target rows plus every update row."""
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def recover(spark: SparkSession, path: str) -> None:
    """Finish an interrupted swap: if ``path`` is gone but a moved-aside copy
    (``<path>__old_*``) exists, the new table never landed -- put the old one
    back so the next upsert merges into it instead of starting empty."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return
    parent, base = p.getParent(), p.getName()
    if parent is None or not fs.exists(parent):
        return
    olds = sorted((st for st in fs.listStatus(parent) if st.getPath().getName().startswith(base + "__old_")),
                  key=lambda st: st.getModificationTime())
    if olds:
        fs.rename(olds[-1].getPath(), p)


def swap(spark: SparkSession, staged: str, path: str) -> None:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    old = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + f"__old_{uuid.uuid4().hex}")
    if fs.exists(p) and not fs.rename(p, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), p):
        fs.rename(old, p)
        raise OSError(f"could not move staged table into {path}")
    fs.delete(old, True)


def _partition_dirs(spark: SparkSession, rows: DataFrame, parts: Sequence[str]) -> set[str]:
    """Relative directories (``a=1/b=x``) of the distinct partitions of ``rows``."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    found = rows.select(*[F.col(c).cast("string").alias(c) for c in parts]).distinct().collect()
    return {"/".join(escape(c, r[c]) for c in parts) for r in found}


def _one_of(rows: list[tuple], parts: Sequence[str]):
    """The predicate that holds for the listed partitions only, nested by column."""
    first, rest = parts[0], parts[1:]
    if not rest:
        values = {r[0] for r in rows}
        some = F.col(first).isin(sorted(v for v in values if v is not None))
        return some | F.col(first).isNull() if None in values else some
    below: dict = {}
    for r in rows:
        below.setdefault(r[0], []).append(r[1:])
    return reduce(or_, [F.col(first).eqNullSafe(F.lit(v)) & _one_of(some, rest) for v, some in below.items()], F.lit(False))


def in_partitions(df: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of ``df`` in the listed partitions; the scan opens no other.

    The list is one row per partition directory, as in the file listing the
    driver does for any scan, so it may become literal predicates.
    """
    return df.filter(_one_of([tuple(r) for r in touched.select(*parts).distinct().collect()], list(parts)))


def _stored_at(target: DataFrame, keyed: DataFrame, keys: Sequence[str], parts: Sequence[str], moves: bool,
               more: Sequence[str] = ()) -> DataFrame:
    """Key, partition (and ``more``) of the stored rows whose key is in ``keyed``."""
    where = target if moves else in_partitions(target, keyed, parts)
    cols = dict.fromkeys([*keys, *parts, *more])
    return where.select(*cols).join(keyed.select(*keys).distinct(), list(keys), "left_semi")


def _overwrite_partitions(spark: SparkSession, out: DataFrame, path: str, touched: DataFrame, keys: Sequence[str],
                          parts: Sequence[str], cluster_by: Sequence[str] | None) -> None:
    """``out`` (written) replaces the touched partitions; those left empty are removed."""
    emptied = _partition_dirs(spark, touched, parts) - _partition_dirs(spark, out, parts)
    write_partitions(out, path, keys, parts, cluster_by, "dynamic")
    fs, _ = _fs(spark, path)
    for folder in emptied:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{folder}"), True)


def write_partitions(out: DataFrame, path: str, keys: Sequence[str], parts: Sequence[str],
                     cluster_by: Sequence[str] | None, mode: str = "static", gathered: bool = False) -> None:
    """Write ``out`` by partition: clustered, or each partition's rows gathered in
    a few tasks of even size (a large partition is split over several), unless
    they are ``gathered`` already. Gathered rows go to the files of the few
    partitions a task has all at once, so full-width rows are not sorted either."""
    if cluster_by:
        laid = clustered_layout(out, parts, cluster_by, [k for k in keys if k not in parts])
    else:
        laid = out if gathered else out.hint("rebalance", *parts)
    writer = laid.write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", mode)
    with _open_files(out.sparkSession, OPEN_FILES if gathered and not cluster_by else 0):
        writer.partitionBy(*parts).parquet(path)


@contextmanager
def _open_files(spark: SparkSession, number: int):
    """A write inside keeps up to ``number`` files of a task open (0: the session's setting)."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if number:
        spark.conf.set(name, str(number))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def replace_rows(spark: SparkSession, path: str, keys: Sequence[str], doomed: DataFrame, rows: DataFrame,
                 partition_by: Sequence[str], cluster_by: Sequence[str] | None = None, moves: bool = True,
                 known: DataFrame | None = None) -> DataFrame:
    """In a partitioned table, the rows whose key is in ``doomed`` leave and
    ``rows`` (written) enter. Returns the rewritten partitions.

    ``known``: the partitions of the stored rows that leave, if the caller has them.
    """
    parts = list(partition_by)
    target = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    touched = rows.select(*parts)
    if known is not None or moves:
        stored = known if known is not None else _stored_at(target, doomed, keys, parts, moves)
        touched = touched.unionByName(stored.select(*parts))
    touched = staged(touched.distinct(), "touched_partitions")
    kept = in_partitions(target, touched, parts).join(doomed.select(*keys), list(keys), "left_anti")
    out = staged(kept.unionByName(rows), "merged")
    _overwrite_partitions(spark, out, path, touched, keys, parts, cluster_by)
    release(out)
    return touched


def upsert(spark: SparkSession, updates: DataFrame, path: str, keys: Sequence[str],
           partition_by: Sequence[str] | None = None, check_unique: bool = True,
           cluster_by: Sequence[str] | None = None, moves: bool = True, known: DataFrame | None = None,
           gathered: bool = False) -> None:
    """Merge ``updates`` into the table at ``path`` on ``keys`` (see module doc).
    With ``partition_by`` and ``cluster_by`` the rewritten partitions keep the
    clustered layout of :func:`clustered_layout` (the key breaks ties). With
    ``gathered`` a first load is written as its rows come (see :func:`write_partitions`)."""
    keys = list(keys)
    recover(spark, path)
    exists = table_exists(spark, path)
    batch = staged(updates, "updates") if exists or check_unique else updates
    if check_unique:
        assert_unique_keys(batch, keys)
    if not exists and partition_by:
        write_partitions(batch, path, keys, list(partition_by), cluster_by, gathered=gathered)
    elif not exists:
        batch.write.mode("overwrite").option("compression", CODEC).parquet(path)
    elif partition_by:
        replace_rows(spark, path, keys, batch, batch, partition_by, cluster_by, moves, known)
    else:
        new = path.rstrip("/") + f"__staging_{uuid.uuid4().hex}"
        merged(spark.read.parquet(path), batch, keys).write.mode("overwrite").option("compression", CODEC).parquet(new)
        swap(spark, new, path)
    if batch is not updates:
        release(batch)


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


@dataclass(frozen=True)
class Changes:
    """What a load changed: the rows that left, those that entered (by key, the
    old and the new image), and the incoming rows that were older."""
    old: DataFrame
    new: DataFrame
    late: DataFrame


def _marker(spark: SparkSession, path: str, batch: str):
    return _fs(spark, f"{path.rstrip('/')}/_batch_{batch}")


def _plan_folder(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}__batch_{batch}"


def forget_batch(spark: SparkSession, path: str, batch: str) -> None:
    """Delete the written plan of a batch that has landed everywhere."""
    fs, folder = _fs(spark, _plan_folder(path, batch))
    if fs.exists(folder):
        fs.delete(folder, True)


def upsert_latest(spark: SparkSession, updates: DataFrame, path: str, key: str, order_cols: Sequence[str],
                  on_losers: Callable[[DataFrame], None] | None = None, batch: str | None = None,
                  partition_by: Sequence[str] = (), moves: bool = True) -> Changes | None:
    """Upsert where a stored row is replaced only by a *newer* row of its key
    (by ``order_cols``; the stored row wins a tie): incremental loads then give
    the same table as one batch over all the data.

    ``updates`` holds a key at most once; rows without a key are left out. Only
    key, order and partition columns are compared; full rows are read from the
    partitions that change. What is to happen -- rows that leave, rows that
    enter, late rows, the new partitions -- is written first, and only then
    applied. ``batch`` names the load: its plan is kept until
    :func:`forget_batch`, and a marker in the table says that it has landed. A
    replay of a load that broke half-way applies the written plan again, with
    the same result; a replay of one that landed returns its plan, or None once
    that is forgotten.

    Rows that lose -- a stored row that is superseded, an incoming one that is
    older -- are handed to ``on_losers`` before the table changes (a table that is
    not there yet has none).
    """
    parts = list(partition_by)
    recover(spark, path)
    exists = table_exists(spark, path)
    folder = _plan_folder(path, batch) if batch else scratch_path(spark, "upsert_plan")
    planned = table_exists(spark, f"{folder}/done")

    def part(name):
        return spark.read.schema(updates.schema).parquet(f"{folder}/{name}").select(*updates.columns)

    landed = False
    if batch:
        fs, marker = _marker(spark, path, batch)
        landed = fs.exists(marker)
    if landed and not planned:
        return None
    if not planned:
        fs, p = _fs(spark, folder)
        fs.delete(p, True)  # what a plan that broke half-way has left
        rows = updates.filter(F.col(key).isNotNull())
        _write_plan(spark, rows, path if exists else None, key, order_cols, parts, moves, folder)
    new = "new" if table_exists(spark, f"{folder}/new") else "rows"  # nothing came too late: all rows are new
    changes = Changes(part("old"), part(new), part("late"))
    if landed:
        return changes
    if on_losers and exists:
        on_losers(changes.old.unionByName(changes.late))
    out = part("out" if table_exists(spark, f"{folder}/out") else new)  # all rows of a first load are new
    if parts and exists:
        touched = spark.read.schema(updates.select(*parts).schema).parquet(f"{folder}/touched")
        _overwrite_partitions(spark, out, path, touched, [key], parts, None)
    elif parts:
        write_partitions(out, path, [key], parts, None)
    else:
        new = path.rstrip("/") + f"__staging_{uuid.uuid4().hex}"
        out.write.mode("overwrite").option("compression", CODEC).parquet(new)
        if batch:
            _touch(spark, f"{new}/_batch_{batch}")
        swap(spark, new, path)
    if batch and parts:
        _touch(spark, f"{path.rstrip('/')}/_batch_{batch}")
    return changes


def _write_plan(spark: SparkSession, rows: DataFrame, path: str | None, key: str, order_cols: Sequence[str],
                parts: Sequence[str], moves: bool, folder: str) -> None:
    """Write what an :func:`upsert_latest` is going to do (see there)."""
    def put(df, name):
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = put(rows, "rows")
    if path is None:
        for name in ("old", "late"):
            put(rows.limit(0), name)
        if parts:
            put(rows.select(*parts).distinct(), "touched")
    else:
        target = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
        stored = staged(_stored_at(target, rows, [key], parts, moves or not parts, order_cols), "stored_keys")
        there = stored.select(F.col(key).alias("_key"), F.struct(*order_cols).alias("_there"))
        # a struct compares column by column, NULL as the oldest
        newer = F.struct(*order_cols) > F.col("_there")
        # the keys that are stored: replaced, or their updates came too late
        known = staged(rows.select(key, *order_cols).join(there, F.col(key) == F.col("_key"))
                       .groupBy(key).agg(F.bool_or(newer).alias("_replaces")), "known_keys")
        late, new = staged(known.filter(~F.col("_replaces")).select(key), "late_keys"), rows
        if late.limit(1).count():  # else the rows are the new ones as they are, and not written again
            new = put(rows.join(late, key, "left_anti"), "new")
            put(rows.join(late, key, "left_semi"), "late")
        else:
            put(rows.limit(0), "late")
        replaced = known.filter("_replaces").select(key)
        if parts:
            leaving = stored.join(replaced, key, "left_semi").select(*parts)
            touched = put(leaving.unionByName(new.select(*parts)).distinct(), "touched")
            target = in_partitions(target, touched, parts)
        put(target.join(replaced, key, "left_semi"), "old")
        put(target.join(replaced, key, "left_anti").unionByName(new), "out")
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/done")
