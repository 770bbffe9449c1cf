"""What a query keeps on disk: Bronze in slices and only as long as it is read, medians without a shuffle for their groups."""
from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marginlens.functions import quantiles
from marginlens.operators import clean
from marginlens.plans import layers, pipeline
from marginlens.sinks.upsert import upsert_latest
from marginlens.sources import driver
from marginlens.sources.tables import _fs, driver_table, table_exists
from tests.conftest import bronze_row

TINY = "/root/testdata/sf0.001"


def _lines(spark, folder, days):
    rows = [(i, datetime(d.year, d.month, d.day, i % 24) if d else None) for i, d in enumerate(days)]
    spark.createDataFrame(rows, "l_orderkey long, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")


def test_slices_of_the_day_hold_every_row_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(driver, "RANGE_ROWS", 2)
    days = [None] * 3 + [date(2020, 1, 1)] * 40 + [date(2020, 1, 1 + i % 28) for i in range(60)]
    _lines(spark, tmp_path, days)
    slices = driver.day_slices(spark, str(tmp_path))
    rows = driver_table(spark, str(tmp_path), "lineitem").withColumn("date", F.col("l_shipdate").cast("date"))
    held = [[r.l_orderkey for r in rows.filter(s).collect()] for s in slices]
    assert 2 < len(slices) <= driver.SLICES and all(held)
    assert sorted(i for h in held for i in h) == list(range(len(days)))


def test_the_same_lines_are_dealt_alike_and_large_days_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(driver, "RANGE_ROWS", 2)
    _lines(spark, tmp_path, [None] * 2 + [date(2020, 1, 1)] * 8 + [date(2020, 1, 2)] * 2)
    assert driver._day_ranges(spark, str(tmp_path)) == [(None, 0, 1), (date(2020, 1, 1), 1, 4), (date(2020, 1, 2), 5, 1)]


def test_bronze_numbers_its_rows_alike_in_every_run(spark, tmp_table):
    def run():
        rows = pipeline.bronze_layer(spark, tmp_table(), driver.route_day_bronze(spark, TINY))
        return sorted(map(str, rows.select(clean.ROW_ID, "route_id", "date", "_source_seq", "total_revenue").collect()))

    assert run() == run()


@pytest.mark.parametrize("days", [[], [None, None], [date(2020, 1, 1)] * 30])
def test_rows_of_one_day_or_none_are_one_slice(spark, tmp_path, monkeypatch, days):
    monkeypatch.setattr(driver, "RANGE_ROWS", 2)
    _lines(spark, tmp_path, days)
    assert len(driver.day_slices(spark, str(tmp_path))) == 1


def test_bronze_in_slices_holds_every_row_under_an_id_of_its_own(spark, bronze, tmp_table):
    rows = [bronze_row(route_date_key=f"K-{i}", date=date(2021, 1 + i % 12, 3)) for i in range(60)]
    day = F.col("date")
    slices = [day.isNull() | (day < "2021-04-01"), (day >= "2021-04-01") & (day < "2021-04-02"), day >= "2021-04-02"]  # the second is empty
    out = tmp_table()
    raw = bronze(*rows).withColumn("date", F.when(F.col("route_date_key") != "K-7", day)).repartition(4, "route_date_key")
    for _ in range(2):  # a reload replaces the table
        got = pipeline.bronze_layer(spark, out, raw, slices)
        assert sorted(r.route_date_key for r in got.collect()) == sorted(r[0] for r in rows)
        assert got.select(clean.ROW_ID).distinct().count() == len(rows)
    fs, folder = _fs(spark, f"{out}/bronze")
    assert [s.getPath().getName() for s in fs.listStatus(folder)] == ["route_day"]  # nothing is left beside it


def test_bronze_is_kept_for_those_who_read_it_only(spark):
    lake = layers.Layers(spark, layers.scratch_path(spark, "lazy"), TINY)
    lake.fact_day.count()
    assert not table_exists(spark, lake.path("bronze")) and not table_exists(spark, lake.path("fact_route_month"))
    total = lake.silver.count() + lake.quarantine.count()
    assert lake.bronze.count() == total == driver_table(spark, TINY, "lineitem").count()
    lake.scorecard().count()
    assert all(table_exists(spark, path) for path in pipeline.table_paths(lake.root).values())


def test_rows_that_are_all_new_are_not_written_again(spark, tmp_table):
    def planned(path, rows, batch):
        got = upsert_latest(spark, spark.createDataFrame(rows, "k string, at int, m int"), path, "k", ["at"], batch=batch, partition_by=["m"])
        return [sorted(tuple(r) for r in df.collect()) for df in (got.old, got.new, got.late)]

    path = tmp_table()
    assert planned(path, [("a", 1, 1), ("b", 5, 2)], "0") == [[], [("a", 1, 1), ("b", 5, 2)], []]
    assert planned(path, [("a", 2, 2), ("c", 1, 1)], "1") == [[("a", 1, 1)], [("a", 2, 2), ("c", 1, 1)], []]
    assert not table_exists(spark, f"{path}__batch_1/new")
    assert planned(path, [("b", 4, 2), ("d", 1, 1)], "2") == [[], [("d", 1, 1)], [("b", 4, 2)]]
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "at", "m").collect()) == [("a", 2, 2), ("b", 5, 2), ("c", 1, 1), ("d", 1, 1)]


def _medians(spark, rows, max_ranked):
    long = spark.createDataFrame(rows, "k string, _m string, _v double").repartition(3)
    return {r["k"]: r["_med"] for r in quantiles.medians_of_long(long, ["k"], max_ranked=max_ranked).collect()}


def _groups():
    sizes = {"small": 7, "one": 1, None: 4, "large": 300, "many ties": 200, "ties": 5}
    return [(k, "m", 1.0 if "ties" in (k or "") else float(-i * 7 % 11)) for k, n in sizes.items() for i in range(n)]


@pytest.mark.parametrize("share", [False, True])
def test_groups_are_told_apart_by_a_hash_or_by_number(spark, monkeypatch, share):
    if share:  # all groups share a hash
        monkeypatch.setattr(quantiles.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    want = {}
    for k in {r[0] for r in _groups()}:
        vs = sorted(v for g, _, v in _groups() if g == k)
        want[k] = vs[(len(vs) - 1) // 2]
    assert _medians(spark, _groups(), 20) == want


def test_rows_are_joined_with_the_large_groups_only(spark, monkeypatch):
    seen, real = [], quantiles._with_state
    monkeypatch.setattr(quantiles, "_with_state", lambda long, state, keys: (seen.append({r["k"] for r in state.collect()}), real(long, state, keys))[1])
    _medians(spark, _groups(), 20)
    assert seen and all(s <= {"large"} for s in seen)
