"""Driver contract: entry smoke run, registry/oracle parity, a few oracle
comparisons on the smallest driver tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "supplier", "part", "lineitem"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["route_id", "cohort_key", "n_days"]


def test_every_query_has_oracle_sql():
    from marginlens.plans.queries import REGISTRY
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.mark.parametrize("name", ["scorecard", "fact_month", "margin_trend", "cost_drivers", "quarantine",
                                  "quality_report", "upsert_partitioned", "hierarchy_violations", "order_margin_trend",
                                  "incremental_ingest", "load_quarantine", "load_scorecard", "run_drift", "published_reports",
                                  "catalog_contract"])
def test_matches_oracle_on_smallest_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_the_rest_stands_without_the_training_data_part(tmp_path):
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(root, "marginlens"), tmp_path / "marginlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = set(e.queries()); assert len(q) > 40 and q == set(e.oracle_sql()), q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_positions_need_no_single_task(spark):
    from pyspark.sql import functions as F

    from marginlens.plans.queries import _positions
    df = spark.range(0, 2000, 1, 8).select((F.col("id") * 7919 % 2000).alias("v"), F.lit("x").alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _positions(df.orderBy(F.desc("v")))
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.position, r.v) for r in rows) == [(k + 1, 1999 - k) for k in range(2000)]
    assert got.columns == ["v", "name", "position"] and dict(got.dtypes)["position"] == "int"
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert _positions(df.limit(0).orderBy("v")).count() == 0
