import glob
import math
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from marginlens.functions.ranks import interleaved, numbered, rank_buckets, ranked_sums
from marginlens.sinks.compact import compact, partition_files
from marginlens.sinks.upsert import upsert

SCHEMA = StructType([StructField("id", IntegerType())] + [StructField(c, StringType()) for c in ("region", "bu", "area", "val")])


def _rows(n=4000):
    return [(i, ["N", "S EAST", "a=b/c", None][i % 4], f"BU{(i * 7919) % 97:02d}", f"A{(i * 104729) % 89:02d}", f"v{i}" * 5)
            for i in range(n)]


def _small_files(spark, path, rows, tasks=20):
    spark.createDataFrame(rows, SCHEMA).repartition(tasks).write.partitionBy("region").parquet(path)


def _files(path):
    return sorted(glob.glob(f"{path}/region=*/*.parquet"))


def _table(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).select(*SCHEMA.names).collect()), key=str)


def _run(spark, path, target, bits=6):
    return compact(spark, path, SCHEMA, ["region"], ["bu", "area"], ["id"], target, bits)


def test_small_files_become_even_files(spark, tmp_table):
    path, rows = tmp_table(), _rows()
    _small_files(spark, path, rows)
    before = {d: [os.path.getsize(f) for f in glob.glob(f"{d}/*.parquet")] for d in glob.glob(f"{path}/region=*")}
    assert all(len(v) == 20 for v in before.values())
    target = 12_000
    assert len(_run(spark, path, target)) == 4
    for folder, sizes in before.items():
        files = glob.glob(f"{folder}/*.parquet")
        assert len(files) == math.ceil(sum(sizes) / target) > 1
        counts = [pq.ParquetFile(f).metadata.num_rows for f in files]
        assert max(counts) - min(counts) <= 1
    assert _table(spark, path) == sorted(rows, key=str)


def test_files_are_narrow_in_both_columns(spark, tmp_table):
    path = tmp_table()
    _small_files(spark, path, [(i, "N", b, a, v) for i, _, b, a, v in _rows(4000)])
    size = sum(map(os.path.getsize, _files(path)))
    _run(spark, path, size // 16 + 1)
    files = _files(path)
    assert len(files) == 16
    spans = {"bu": [], "area": []}
    for f in files:
        t = pq.read_table(f, columns=["bu", "area"])
        for c, out in spans.items():
            v = sorted(t.column(c).to_pylist())
            out.append(int(v[-1].lstrip("BUA")) - int(v[0].lstrip("BUA")) + 1)
    # a 4 x 4 grid of files would span a quarter of each column; before, every file spans all of both
    assert sum(spans["bu"]) / 16 < 0.5 * 97 and sum(spans["area"]) / 16 < 0.5 * 89


def test_a_second_run_writes_nothing(spark, tmp_table):
    path = tmp_table()
    _small_files(spark, path, _rows(400))
    _run(spark, path, 10_000)
    state = [(f, os.stat(f).st_mtime_ns) for f in _files(path)]
    assert _run(spark, path, 10_000) == []
    assert [(f, os.stat(f).st_mtime_ns) for f in _files(path)] == state
    assert len(_run(spark, path, 20_000)) == 4  # another layout


def test_only_partitions_of_a_load_are_rewritten(spark, tmp_table):
    path, rows = tmp_table(), _rows(400)
    _small_files(spark, path, rows)
    _run(spark, path, 10_000)
    upsert(spark, spark.createDataFrame([(0, "N", "BU00", "A00", "new"), (9999, "N", "BU1", "A1", "x")], SCHEMA), path, ["id"],
           partition_by=["region"])
    state = {f: os.stat(f).st_mtime_ns for f in _files(path)}
    assert _run(spark, path, 10_000) == ["region=N"]
    after = {f: os.stat(f).st_mtime_ns for f in _files(path)}
    assert {f for f in state if "region=N/" not in f} == {f for f in after if after[f] == state.get(f)}
    assert _table(spark, path) == sorted([(0, "N", "BU00", "A00", "new"), (9999, "N", "BU1", "A1", "x"), *rows[1:]], key=str)


def test_null_cluster_values_and_hot_values(spark, tmp_table):
    path = tmp_table()
    rows = [(i, "N", None if i % 3 else "B", "A" if i % 2 else None, "v") for i in range(300)]
    _small_files(spark, path, rows, 5)
    _run(spark, path, 1500)
    assert _table(spark, path) == sorted(rows, key=str) and len(_files(path)) > 1


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_numbered_and_ranked_sums(spark, n):
    df = spark.range(n).select(((F.col("id") * 7919) % 1009).alias("k"), F.col("id").alias("w")).repartition(7)
    got = [tuple(r) for r in numbered(df.orderBy("k")).orderBy("_pos").collect()]
    want = sorted((i * 7919 % 1009, i) for i in range(n))
    assert got == [(*r, p) for p, r in enumerate(want)]
    sums = {r["k"]: r["_below"] for r in ranked_sums(df, ["k"], "w").collect()}
    below = 0
    for k, w in want:
        assert sums[k] == below
        below += w


def test_rank_buckets_are_even_and_ordered(spark):
    df = spark.createDataFrame([(f"v{i % 100:03d}",) for i in range(1000)] + [(None,)] * 10, "c string")
    got = {r["c"]: r["b"] for r in rank_buckets(df, "c", 3, "b").collect()}
    assert got[None] == 0 and set(got.values()) == set(range(8))
    values = sorted(v for v in got if v)
    assert [got[v] for v in values] == sorted(got[v] for v in values)


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in df.select("a", "b", interleaved(["a", "b"], 3).alias("z")).collect():
        want = sum(((r.a >> i & 1) << (2 * i + 1)) | ((r.b >> i & 1) << (2 * i)) for i in range(3))
        assert r.z == want
