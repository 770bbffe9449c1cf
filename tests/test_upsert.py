import pytest

from marginlens.sinks.upsert import DuplicateKeyError, upsert


def _table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_create_then_merge_is_idempotent(spark, tmp_table):
    path = tmp_table()
    upsert(spark, spark.createDataFrame([(1, "a"), (2, "b")], "id long, val string"), path, ["id"])
    updates = spark.createDataFrame([(2, "B"), (3, "c")], "id long, val string")
    upsert(spark, updates, path, ["id"])
    assert _table(spark, path) == [(1, "a"), (2, "B"), (3, "c")]
    upsert(spark, updates, path, ["id"])
    assert _table(spark, path) == [(1, "a"), (2, "B"), (3, "c")]


def test_null_keys_always_insert(spark, tmp_table):
    path = tmp_table()
    upsert(spark, spark.createDataFrame([(None, "x")], "id long, val string"), path, ["id"])
    upsert(spark, spark.createDataFrame([(None, "y")], "id long, val string"), path, ["id"])
    assert len(_table(spark, path)) == 2


def test_duplicate_update_keys_rejected(spark, tmp_table):
    path = tmp_table()
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "id long, val string")
    with pytest.raises(DuplicateKeyError):
        upsert(spark, dup, path, ["id"])


def test_partitioned_touches_only_updated_partitions(spark, tmp_table):
    path = tmp_table()
    first = spark.createDataFrame([(1, "EU", "a"), (2, "US", "b"), (3, "US", "c")], "id long, region string, val string")
    upsert(spark, first, path, ["id"], partition_by=["region"])
    upsert(spark, spark.createDataFrame([(2, "US", "B"), (4, "US", "d")], first.schema), path, ["id"],
           partition_by=["region"])
    got = sorted((r["id"], r["region"], r["val"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "EU", "a"), (2, "US", "B"), (3, "US", "c"), (4, "US", "d")]


def test_interrupted_swap_is_recovered(spark, tmp_table):
    import os
    path = tmp_table()
    upsert(spark, spark.createDataFrame([(1, "a"), (2, "b")], "id long, val string"), path, ["id"])
    os.rename(path, path + "__old_deadbeef")  # crash after moving the old table aside
    upsert(spark, spark.createDataFrame([(3, "c")], "id long, val string"), path, ["id"])
    assert _table(spark, path) == [(1, "a"), (2, "b"), (3, "c")]


REGIONED = "id long, region string, val string"


def _regions(spark, path):
    return sorted(map(tuple, spark.read.schema(REGIONED).parquet(path).select("id", "region", "val").collect()), key=str)


def test_null_partition_keeps_its_rows(spark, tmp_table):
    path = tmp_table()
    upsert(spark, spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "N", "c")], REGIONED), path, ["id"],
           partition_by=["region"])
    upsert(spark, spark.createDataFrame([(9, None, "z")], REGIONED), path, ["id"], partition_by=["region"])
    assert _regions(spark, path) == sorted([(1, None, "a"), (2, None, "b"), (3, "N", "c"), (9, None, "z")], key=str)


def test_number_like_partitions_stay_text(spark, tmp_table):
    path = tmp_table()
    rows = [(1, "01", "a"), (2, "01", "b"), (3, "1", "c")]
    upsert(spark, spark.createDataFrame(rows, REGIONED), path, ["id"], partition_by=["region"])
    upsert(spark, spark.createDataFrame([(1, "01", "A")], REGIONED), path, ["id"], partition_by=["region"])
    assert _regions(spark, path) == [(1, "01", "A"), (2, "01", "b"), (3, "1", "c")]


def test_a_key_that_moves_leaves_its_old_partition(spark, tmp_table):
    path = tmp_table()
    upsert(spark, spark.createDataFrame([(1, "N", "a"), (2, "S", "b"), (4, "x=y/z", "d")], REGIONED), path, ["id"],
           partition_by=["region"])
    upsert(spark, spark.createDataFrame([(1, "S", "A"), (4, None, "D")], REGIONED), path, ["id"], partition_by=["region"])
    assert _regions(spark, path) == sorted([(1, "S", "A"), (2, "S", "b"), (4, None, "D")], key=str)
