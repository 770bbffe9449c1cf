import glob

import pyarrow.parquet as pq

from marginlens.sinks.writers import write_clustered
from marginlens.sources.tables import spread


def test_clustered_write_sorts_each_file(spark, tmp_table):
    rows = [(f"R{i % 3}", f"BU{(i * 7) % 5}", f"A{(i * 11) % 4}", f"r{i}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "region string, bu string, area string, route_id string, month_key int")
    path = tmp_table("clustered")
    write_clustered(df, path, ["region"], ["bu", "area"], tie_break=["route_id", "month_key"], num_ranges=6)
    files = glob.glob(f"{path}/region=*/*.parquet")
    assert files
    for f in files:
        t = pq.read_table(f, columns=["bu", "area"]).to_pylist()
        seq = [(r["bu"], r["area"]) for r in t]
        assert seq == sorted(seq), f  # min/max statistics on (bu, area) can skip row groups
    assert spark.read.parquet(path).count() == 400


def test_spread_only_when_scan_is_narrow(spark, tmp_table):
    path = tmp_table("one_file")
    spark.range(1000).coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    assert one.rdd.getNumPartitions() == 1
    wide = spread(one, ["id"])
    assert wide.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    many = spark.range(1000, numPartitions=64)
    assert spread(many) is many  # already parallel: untouched, no shuffle


def test_partitioned_upsert_keeps_cluster_order(spark, tmp_table):
    from marginlens.sinks.upsert import upsert
    rows = [(f"R{i % 2}", f"BU{(i * 7) % 5}", f"A{(i * 11) % 4}", i, "v1") for i in range(300)]
    schema = "region string, bu string, area string, id int, val string"
    path = tmp_table("ups_clustered")
    write_clustered(spark.createDataFrame(rows, schema), path, ["region"], ["bu", "area"], tie_break=["id"])
    upd = spark.createDataFrame([(r[0], r[1], r[2], r[3], "v2") for r in rows if r[3] % 3 == 0], schema)
    upsert(spark, upd, path, ["id"], partition_by=["region"], cluster_by=["bu", "area"])
    for f in glob.glob(f"{path}/region=*/*.parquet"):
        seq = [(r["bu"], r["area"]) for r in pq.read_table(f, columns=["bu", "area"]).to_pylist()]
        assert seq == sorted(seq), f
    got = spark.read.parquet(path)
    assert got.count() == 300 and got.filter("val = 'v2'").count() == 100
