"""Layers on demand, superseded ids as bitmaps, a first load written once."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marginlens.operators import clean
from marginlens.plans import layers, pipeline
from marginlens.sinks import upsert as up
from marginlens.sinks.writers import export_csv, overwrite
from marginlens.sources.tables import driver_table, table_exists
from tests.conftest import bronze_row

TINY = "/root/testdata/sf0.001"


def _written(spark, path, rows):
    """Rows with ids as Bronze has them, from several files."""
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(3, "v")
    df.withColumn(clean.ROW_ID, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("chunks", [clean.MAP_SIDE_CHUNKS, 0])
def test_bitmaps_leave_one_row_a_key(spark, tmp_table, monkeypatch, chunks):
    monkeypatch.setattr(clean, "MAP_SIDE_CHUNKS", chunks)
    rows = [(f"k{i % 700}", i % 5, i) for i in range(5000)] + [(None, 9, -1), (None, 9, -2)]
    table = _written(spark, tmp_table(), rows)
    kept, rejects = clean.split_latest(table, "k", ["at"])
    kept, rejects = kept.collect(), rejects.collect()
    best = {}
    for k, at, _ in rows:
        if k is not None:
            best[k] = max(best.get(k, -1), at)
    assert {r["k"]: r["at"] for r in kept} == best and len(kept) == len(best)
    assert sorted(r["v"] for r in kept + rejects) == sorted(v for *_, v in rows)
    assert {r["v"] for r in rejects if r["_reject_reason"] == clean.REJECT_NULL_KEY} == {-1, -2}


def test_wide_rows_are_not_shuffled_to_drop_superseded_copies(spark, bronze, tmp_table):
    path = tmp_table()
    rows = [bronze_row(route_date_key=f"K-{i % 40}", _source_seq=i) for i in range(80)]
    bronze(*rows).withColumn(clean.ROW_ID, F.monotonically_increasing_id()).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the list of ids were large
    try:
        kept = clean.clean_rows(spark.read.parquet(path), "route_date_key", clean.DEDUP_ORDER)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_a_query_writes_only_the_layers_it_reads(spark):
    lake = layers.Layers(spark, layers.scratch_path(spark, "lazy"), TINY)
    lake.table("bronze").count()
    assert not table_exists(spark, lake.path("silver"))
    lake.table("silver").count()
    assert table_exists(spark, lake.path("quarantine")) and not table_exists(spark, lake.path("dim_route"))
    lake.scorecard().count()
    assert all(table_exists(spark, path) for path in pipeline.table_paths(lake.root).values())


def test_first_load_is_written_once_and_replayed(spark, tmp_table):
    path = tmp_table()
    rows = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "k string, at int, m int")
    up.upsert_latest(spark, rows, path, "k", ["at"], batch="0", partition_by=["m"])
    assert not table_exists(spark, f"{path}__batch_0/out")
    fs, marker = up._marker(spark, path, "0")
    fs.delete(marker, False)  # broke before the marker: the plan is applied again
    up.upsert_latest(spark, rows, path, "k", ["at"], batch="0", partition_by=["m"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "at", "m").collect()) == [("a", 1, 1), ("b", 1, 2)]


def test_csv_export_can_be_compressed(spark, tmp_table, tmp_path):
    path = tmp_table()
    export_csv(spark.range(1000), path, compression="gzip")
    assert spark.read.option("header", True).csv(path).count() == 1000
    assert not list(tmp_path.rglob("*.csv")) and list(tmp_path.rglob("*.csv.gz"))


def test_the_drivers_rows_reach_silver_in_ranges_of_the_day(spark, monkeypatch):
    lake = layers.Layers(spark, layers.scratch_path(spark, "ranges"), TINY)
    months, read = F.year("date") * 12 + F.month("date"), []
    parts = lake.bronze.groupBy(F.input_file_name().alias("f")).agg(F.min(months).alias("a"), F.max(months).alias("b")).orderBy("a").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(parts, parts[1:]))  # a file holds a range of its own
    real = up.write_partitions
    monkeypatch.setattr(up, "write_partitions", lambda out, *a, **k: (read.append(out._jdf.queryExecution().executedPlan().toString()), real(out, *a, **k)))
    assert lake.silver.count() > 0
    assert "Exchange hashpartitioning" not in read[0] and "Exchange RoundRobin" not in read[0]  # full-width rows stay where they are
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_layers_are_written_with_the_library_codec(spark, tmp_table):
    path = tmp_table()
    overwrite(spark.range(100).toDF("x"), path)
    names = [s.getPath().getName() for s in up._fs(spark, path)[0].listStatus(up._fs(spark, path)[1])]
    assert any(n.endswith(".zstd.parquet") for n in names)


def test_loads_bring_every_row_from_the_source(spark, monkeypatch):
    rows = []
    monkeypatch.setattr(layers, "load", lambda spark, root, raw, load_id: rows.append(raw.count()))
    for name in ("append_run", "run_metrics"):
        monkeypatch.setattr(layers, name, lambda *a: None)
    monkeypatch.setattr(layers, "_LOADED", {})
    monkeypatch.setattr(layers, "_LAKEHOUSES", {})
    layers.loaded_lakehouse(spark, TINY)
    assert len(rows) == len(layers.LOADS) and sum(rows) == driver_table(spark, TINY, "lineitem").count()
    assert not layers._LAKEHOUSES  # no second copy of Bronze is written for them
