"""Resumable runs, run history and drift, published files, catalog contract."""
import os
import re
from datetime import date

import pytest

from marginlens.operators import clean
from marginlens.operators.history import RunExists, Tolerance, append_run, drift, history
from marginlens.plans import pipeline
from marginlens.plans.runs import RunLog
from marginlens.sinks.publish import publish_csv, published_number, published_rows
from marginlens.sources import catalog
from marginlens.sources.schemas import BRONZE_SCHEMA_NULLABLE, PARTITIONS, SOURCE_COLUMNS
from tests.conftest import bronze_row

SF = "/root/testdata/sf0.001"
LAYERS = ["bronze", "silver", "dims", "facts", "scorecard"]


def _values(spark, out):
    got = {}
    for name in pipeline.TABLES:
        df = pipeline.read_layer(spark, out, name)
        cols = sorted(df.columns)
        got[name] = sorted((tuple(str(r[c]) for c in cols) for r in df.collect()))
    return got


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("whole") / "lake")
    pipeline.run(spark, out, sf_dir=SF)
    return out


@pytest.mark.parametrize("broken", ["silver", "facts"])
def test_a_run_that_broke_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, whole, broken):
    out, built = str(tmp_path / "lake"), []
    for layer in LAYERS:
        fn = getattr(pipeline, f"{layer}_layer")

        def noted(*args, _fn=fn, _layer=layer, **kw):
            built.append(_layer)
            return _fn(*args, **kw)
        monkeypatch.setattr(pipeline, f"{layer}_layer", noted)
    with monkeypatch.context() as m:
        m.setattr(pipeline, f"{broken}_layer", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pipeline.run(spark, out, sf_dir=SF)
    first, built[:] = list(built), []
    assert first == LAYERS[:LAYERS.index(broken)]
    pipeline.run(spark, out, sf_dir=SF, resume=True)
    assert built == LAYERS[LAYERS.index(broken):]
    if broken == "facts":
        assert _values(spark, out) == _values(spark, whole)


def test_a_finished_run_is_resumed_without_work_until_something_changes(spark, tmp_path, monkeypatch):
    src, out, built = str(tmp_path / "in.csv"), str(tmp_path / "lake"), []
    rows = [bronze_row(route_date_key=f"K-{i}", route_id=f"R-{i % 3}", date=date(2023, 1 + i % 3, 5)) for i in range(9)]

    def write(n):
        df = spark.createDataFrame(rows[:n], BRONZE_SCHEMA_NULLABLE).select(*SOURCE_COLUMNS)
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(src)

    for layer in LAYERS:
        fn = getattr(pipeline, f"{layer}_layer")
        monkeypatch.setattr(pipeline, f"{layer}_layer", lambda *a, _f=fn, _l=layer, **k: (built.append(_l), _f(*a, **k))[1])
    write(8)
    pipeline.run(spark, out, csv=src)
    built.clear()
    pipeline.run(spark, out, csv=src, resume=True)
    assert built == []
    write(9)  # the source changed: everything follows
    counts = pipeline.run(spark, out, csv=src, resume=True)
    assert built == LAYERS and counts["silver"] == 9
    built.clear()
    os.remove(next(os.path.join(d, f) for d, _, fs in os.walk(f"{out}/gold/dim_date") for f in fs if f.endswith(".parquet")))
    pipeline.run(spark, out, csv=src, resume=True)  # a table was damaged: its layer is built again
    assert "dims" in built and "bronze" not in built and "silver" not in built


def test_a_record_is_read_as_written(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    assert log.read("silver") is None and not log.is_done("silver", "", [], [])
    log.record("silver", "x", [], [])
    log.record("silver", "y", [], [])
    assert log.is_done("silver", "y", [], []) and not log.is_done("silver", "x", [], [])
    assert os.listdir(tmp_path / "_runs") and not [f for f in os.listdir(tmp_path / "_runs") if f.endswith(".new")]


# --- Silver without a window over whole rows ---
def test_winners_are_found_on_narrow_rows(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.range(50).selectExpr("concat('k', id % 20) as k", "id as at", "id as _row_id", "repeat('x', 50) as wide").write.parquet(path)
    out = clean.clean_rows(spark.read.parquet(path), "k", ["at"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "LeftAnti" in plan
    assert sorted(r.at for r in out.collect()) == list(range(30, 50))


# --- history ---
def _run(spark, **figures):
    return spark.createDataFrame([(k, None if v is None else float(v)) for k, v in figures.items()], "metric string, value double")


def test_drift_against_the_run_before(spark, tmp_path):
    path = str(tmp_path / "history")
    assert append_run(spark, path, 0, _run(spark, rows=100, routes=10, rate=0.5))
    assert append_run(spark, path, 1, _run(spark, rows=109, routes=10, rate=0.5, late=3))
    assert append_run(spark, path, 2, _run(spark, rows=130, routes=9, rate=None, late=3))
    out = drift(history(spark, path), {"rows": Tolerance(relative=0.1), "routes": Tolerance(absolute=2)}, {"routes": 120, "rows": 100})
    got = {(r.run_no, r.metric): (r.previous, r.drifted) for r in out.collect()}
    assert got == {(0, "rows"): (100.0, False), (0, "routes"): (120.0, True), (0, "rate"): (None, None),
                   (1, "rows"): (100.0, False), (1, "routes"): (10.0, False), (1, "rate"): (0.5, False), (1, "late"): (None, None),
                   (2, "rows"): (109.0, True), (2, "routes"): (10.0, False), (2, "rate"): (0.5, True), (2, "late"): (3.0, False)}


def test_a_run_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "history")
    assert append_run(spark, path, 0, _run(spark, rows=100))
    assert not append_run(spark, path, 0, _run(spark, rows=100))
    with pytest.raises(RunExists):
        append_run(spark, path, 0, _run(spark, rows=101))
    assert history(spark, path).count() == 1


# --- published files ---
HEADERS = {  # fixed values: headers of the published files
    "waste_stream_margins.csv": "primary_waste_stream,median_margin_pct,route_days",
    "cohort_margins.csv": "cohort_key,cohort_median_margin,route_days",
    "cost_drivers.csv": "cost_component,loss_day_share_pct,profit_day_share_pct,loss_day_avg_gbp,profit_day_avg_gbp",
    "margin_trend.csv": "period_type,period,margin_pct,loss_day_rate_pct",
    "route_scorecard.csv": "route_id,cohort_key,median_margin_pct,cohort_median_margin,pct_days_below_peer,loss_day_rate,tier,tier_code",
    "underperforming_routes.csv": "route_id,cohort_key,median_margin_pct,cohort_median_margin,pct_days_below_peer,loss_day_rate,tier,tier_code",
}
FORMATS = {
    "waste_stream_margins.csv": r"[A-Za-z ]+,-?\d+\.\d{1,2},\d+",
    "cohort_margins.csv": r"[A-Za-z |&]+,-?\d+\.\d{1,2},\d+",
    "cost_drivers.csv": r"[a-z_]+,\d+\.\d,\d+\.\d,\d+,\d+",
    "margin_trend.csv": r"(year,\d{4}|quarter,\d{4} Q[1-4]),-?\d+\.\d,\d+\.\d",
    "route_scorecard.csv": r"\w+,[A-Za-z |&]+,-?\d+\.\d{1,2},-?\d+\.\d{1,2},\d\.\d{1,3},\d\.\d{1,3},[A-Za-z0-9 -]+,[012]",
    "underperforming_routes.csv": r"\w+,[A-Za-z |&]+,-?\d+\.\d{1,2},-?\d+\.\d{1,2},\d\.\d{1,3},\d\.\d{1,3},Tier [A-Za-z0-9 -]+,[12]",
}


def _lines(folder, name):
    with open(os.path.join(folder, name)) as f:
        return f.read().splitlines()


def test_six_files_with_header_order_and_format(spark, whole, tmp_path):
    folder = str(tmp_path / "output")
    for _ in range(2):
        names = pipeline.publish_reports(spark, whole, folder)
        assert sorted(names) == sorted(HEADERS) == sorted(f for f in os.listdir(folder) if not f.startswith("."))
    for name, header in HEADERS.items():
        first, *lines = _lines(folder, name)
        assert first == header and lines, name
        assert all(re.fullmatch(FORMATS[name], x) for x in lines), (name, lines[:3])
    rows = [x.split(",") for x in _lines(folder, "underperforming_routes.csv")[1:]]
    assert [float(r[5]) for r in rows] == sorted((float(r[5]) for r in rows), reverse=True)
    assert [r[0] for r in (x.split(",") for x in _lines(folder, "cost_drivers.csv")[1:])][0] == "disposal_cost"


def test_parts_sort_by_name_and_replace_earlier_ones(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.range(1000).selectExpr("id").repartitionByRange(5, "id").sortWithinPartitions("id")
    names = publish_csv(df, folder, "list")
    assert names == [f"list-{k:05d}.csv" for k in range(len(names))] and len(names) > 1
    body = [int(x) for n in sorted(names) for x in _lines(folder, n)[1:]]
    assert body == list(range(1000))
    publish_csv(df, folder, "list2")
    assert publish_csv(df.limit(0), folder, "list") == ["list.csv"]
    assert _lines(folder, "list.csv") == ["id"]
    assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == ["list.csv"] + [f"list2-{k:05d}.csv" for k in range(len(names))]


def test_published_numbers(spark):
    df = spark.createDataFrame([(35.6,), (0.0,), (-0.004,), (12345678.125,), (None,), (2.675,), (100.0,)], "x double")
    assert [r[0] for r in df.select(published_number("x", 2)).collect()] == ["35.6", "0.0", "0.0", "12345678.13", None, "2.68", "100.0"]
    assert [r.x for r in published_rows(df, {"x": 0}).collect()] == ["36", "0", "0", "12345678", None, "3", "100"]


# --- catalog ---
def test_catalog_holds_for_written_tables_and_finds_faults(spark, whole, tmp_path):
    paths = pipeline.table_paths(whole)
    catalog.register(spark, "marginlens_test", paths, pipeline.CONTRACTS)
    rows = catalog.check(spark, "marginlens_test", paths, pipeline.CONTRACTS).collect()
    assert rows and all(r.holds for r in rows)
    assert {(r.table_name, r.column_name) for r in rows if r.is_partition} == {
        (t, c) for t, cs in PARTITIONS.items() if t in pipeline.CONTRACTS for c in cs}
    assert spark.table("marginlens_test.fact_route_month").count() == spark.read.parquet(paths["fact_route_month"]).count()
    bad = dict(paths, dim_date=str(tmp_path / "dim_date"))
    (spark.read.parquet(paths["dim_date"]).selectExpr("cast(date_key as long) date_key", "date", "year", "quarter", "month",
                                                      "if(month = 1, null, day_of_week) day_of_week", "1 as extra")
     .write.parquet(bad["dim_date"]))
    only = {"dim_date": pipeline.CONTRACTS["dim_date"]}
    catalog.register(spark, "marginlens_test", paths, only)
    found = {r.column_name for r in catalog.check(spark, "marginlens_test", bad, only).collect() if not r.holds}
    assert found == {"date_key", "extra"}
    nulls = str(tmp_path / "nulls")
    spark.read.parquet(paths["dim_date"]).selectExpr("date_key", "date", "year", "quarter", "month", "if(month = 1, null, day_of_week) day_of_week").write.parquet(nulls)
    catalog.register(spark, "marginlens_test", {"dim_date": nulls}, only)
    got = {r.column_name: r.nulls for r in catalog.check(spark, "marginlens_test", {"dim_date": nulls}, only).collect() if not r.holds}
    assert set(got) == {"day_of_week"} and got["day_of_week"] > 0
