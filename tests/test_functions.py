from datetime import date

from pyspark.sql import functions as F

from marginlens.functions.exprs import (
    date_key, exact_avg, exact_sum, key_month, key_year, month_key, quarter_label, safe_div, weekday_name,
)


def test_safe_div_table(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, None), (0.0, 5.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_div("n", "d")).collect()]
    assert got == [5.0, None, None, 0.0]


def test_date_key_and_back(spark):
    df = spark.createDataFrame([(date(2023, 3, 15),), (date(1999, 12, 31),)], "d date")
    rows = (df.select(date_key("d").alias("k"), quarter_label("d").alias("q"), weekday_name("d").alias("w"))
              .select("k", key_year("k").alias("y"), key_month("k").alias("m"), "q", "w",
                      month_key(key_year("k"), key_month("k")).alias("mk")).collect())
    assert [tuple(r) for r in rows] == [(20230315, 2023, 3, "Q1", "Wednesday", 202303),
                                        (19991231, 1999, 12, "Q4", "Friday", 199912)]


def test_exact_sums_are_order_free(spark):
    vals = [0.1] * 10 + [1e6, -1e6, 0.2, 0.3]
    a = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").coalesce(1)
    ra = a.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    rb = b.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert ra == rb
    assert ra["s"] == 1.5


def test_exact_sum_survives_bigint_scale(spark):
    # 4 * 3e16 cents would overflow a bigint sum; the decimal sum does not
    df = spark.createDataFrame([(3e14,)] * 40, "x double")
    assert df.agg(exact_sum("x")).first()[0] == 1.2e16
    assert df.agg(F.count("x")).first()[0] == 40


def test_sums_keep_small_values_and_show_nan(spark):
    import math
    df = spark.createDataFrame([("a", 0.004)] * 3 + [("b", 1.0), ("b", float("nan"))] + [("c", float("inf")), ("c", 1.0)]
                               + [("d", None)], "k string, x double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert got["a"] == 0.012 and math.isnan(got["b"]) and got["c"] == float("inf") and got["d"] is None


def test_join_checked_lets_bytes_decide(spark):
    from marginlens.functions.joins import join_checked
    big = spark.range(20_000).withColumn("k", F.col("id") % 50)
    small = spark.range(50).withColumnRenamed("id", "k").groupBy("k").agg(F.max("k").alias("w"))
    joined = join_checked(big, small, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        over = join_checked(big, small, "k")
        assert "SortMergeJoin" in over._jdf.queryExecution().executedPlan().toString()
        assert over.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from marginlens.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
