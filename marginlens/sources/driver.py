"""The driver's star-schema tables re-read as raw route-day rows.

``lineitem ⋈ supplier ⋈ nation ⋈ region ⋈ part`` gives one Bronze-shaped row
per line item: the supplier plays the route, the ship date the day, the
line's money the revenue and cost components. Keys ``(l_orderkey,
l_linenumber)`` repeat naturally, which exercises the dedup/quarantine path.
A few faults are injected deterministically so every guard has work to do:

* NULL key when ``l_orderkey % 1000 = 0``;
* ``completed_stops = 0`` when ``l_linenumber = 7``;
* source ``total_cost`` off by 1.0 when ``l_orderkey % 97 = 0``;
* NULL ``fuel_cost`` when ``l_partkey % 211 = 0``.
"""
from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.functions.exprs import quarter_label, weekday_name
from marginlens.sources.schemas import BRONZE_SCHEMA
from marginlens.sources.tables import driver_table

SOURCE_TABLES = ["lineitem", "supplier", "nation", "region", "part"]

# --- fixed values: category names by ``s_suppkey % 4`` and ``s_nationkey % 2`` ---
WASTE_STREAMS = ["General Waste", "Recycling", "Organics", "Cardboard"]
CUSTOMER_SEGMENTS = ["Office & Commercial", "Retail"]


def _pick(idx, names) -> F.Column:
    expr = None
    for i, name in enumerate(names):
        expr = (F.when(idx == i, F.lit(name)) if expr is None else expr.when(idx == i, F.lit(name)))
    return expr


SMALL_SIDE = 1 << 20   # rows of a narrow dimension (some 64 MB) that are sent to the lines
RANGE_ROWS = 1 << 16   # lines of a range of the day, while there are few lines
SLICES = 8             # slices that Bronze is written in, at most; each has a range for every shuffle partition


def _sent(side: DataFrame) -> DataFrame:
    """A narrow dimension, broadcast while it is small, so that the lines are not shuffled for it."""
    return side.hint("broadcast") if side.count() <= SMALL_SIDE else side


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _day_ranges(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """``(day, first, span)``: the even ranges of the day that a day's lines go to,
    ``span`` of them from ``first`` on. Worked out from a count a day, so the same
    table is always dealt alike; lines without a day come first."""
    days = (driver_table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("day").asc_nulls_first()).collect())
    total = sum(r["n"] for r in days)
    ranges = min(_partitions(spark) * SLICES, -(-total // RANGE_ROWS))
    out, before = [], 0
    for r in days:
        first, last = before * ranges // total, (before + r["n"] - 1) * ranges // total
        out.append((r["day"], first, last - first + 1))
        before += r["n"]
    return out


def day_slices(spark: SparkSession, sf_dir: str) -> list[Column]:
    """Predicates over ``date`` that deal the raw rows into slices of consecutive
    days, of as many ranges as there are shuffle partitions (a day is not split;
    rows without a day are in the first slice)."""
    per, firsts, held = _partitions(spark), [], 0
    for day, first, _ in _day_ranges(spark, sf_dir):
        if first // per > held and day is not None:
            firsts.append(day)
            held = first // per
    if not firsts:
        return [F.lit(True)]
    at = [F.lit(d).cast("date") for d in firsts]
    day = F.col("date")
    return [day.isNull() | (day < at[0]), *[(day >= a) & (day < b) for a, b in pairwise(at)], day >= at[-1]]


def route_day_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped route-day rows (39 source columns + 3 lineage columns), in
    ranges of the day."""
    li = driver_table(spark, sf_dir, "lineitem")
    sup = driver_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nat = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = driver_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = driver_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")

    # Each dimension joins the fact directly: every join side is then a plain
    # scan whose size is known, so small dimensions are broadcast and large ones
    # (beyond SMALL_SIDE rows) get a sort-merge join. Pre-joining
    # the dimensions would hide their size behind a join estimate and force a
    # shuffle of the fact.
    #
    # The rows are dealt into even ranges of the day while they are narrow: all
    # cores then widen them, and Silver is stored by month without a shuffle of
    # full-width rows. The ranges follow from counts, not from a sample, so a
    # repeated run numbers the rows alike.
    days = spark.createDataFrame(_day_ranges(spark, sf_dir), "_day date, _first int, _span int").hint("broadcast")
    held = F.col("_first") + F.pmod(F.xxhash64("l_orderkey"), F.col("_span")).cast("int")
    parts = _partitions(spark)
    lines = (li.join(_sent(sup), li.l_suppkey == sup.s_suppkey)
               .join(_sent(part), li.l_partkey == part.p_partkey)
               .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "s_suppkey",
                       "s_nationkey", "s_acctbal", "p_size", "p_retailprice")
               .join(days, F.col("l_shipdate").cast("date").eqNullSafe(F.col("_day")))
               .repartitionById(parts, F.pmod(held, F.lit(parts)))
               .drop("_day", "_first", "_span"))
    base = (lines.join(nat, lines.s_nationkey == nat.n_nationkey)
                 .join(reg, nat.n_regionkey == reg.r_regionkey))

    q = F.col("l_quantity")
    price = F.col("p_retailprice")
    x = (F.lit(10000.0) - F.col("s_acctbal")) / F.lit(11000.0)
    revenue = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    disposal = q * price * (F.lit(0.1) + F.lit(3.5) * x * x)
    fuel_raw = q * F.col("p_size") * F.lit(2)
    labour = q * F.lit(3.0)
    maintenance = F.col("l_tax") * F.lit(1000.0)
    admin = q * F.lit(1.5)
    sum5 = disposal + fuel_raw + labour + maintenance + admin
    returned = F.col("l_returnflag") == F.lit("R")
    stops = q.cast("int")
    d = F.col("l_shipdate").cast("date")
    incident = returned & (F.col("l_linestatus") == F.lit("F"))
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))

    cols = {
        "route_date_key": F.when(F.col("l_orderkey") % 1000 == 0, F.lit(None).cast("string")).otherwise(key),
        "date": d,
        "year": F.year(d),
        "month": F.month(d),
        "quarter": quarter_label(d),
        "day_of_week": weekday_name(d),
        "region": F.col("r_name"),
        "bu": F.col("n_name"),
        "area": F.concat(F.col("n_name"), F.lit("-"), (F.col("s_suppkey") % 2).cast("string")),
        "route_id": F.col("l_suppkey").cast("string"),
        "primary_waste_stream": _pick(F.col("s_suppkey") % 4, WASTE_STREAMS),
        "primary_customer_segment": _pick(F.col("s_nationkey") % 2, CUSTOMER_SEGMENTS),
        "num_drivers": (F.lit(1) + F.col("l_linenumber") % 2).cast("int"),
        "num_trucks": F.lit(1).cast("int"),
        "total_stops": stops,
        "completed_stops": F.when(F.col("l_linenumber") == 7, F.lit(0))
                            .otherwise(stops - F.when(returned, 1).otherwise(0)).cast("int"),
        "missed_stops": F.when(returned, 1).otherwise(0).cast("int"),
        "total_distance_km": q * F.lit(4.5),
        "total_fuel_used_litres": q * F.lit(1.25),
        "total_labour_hours": F.lit(4.0) + F.col("l_linenumber") * F.lit(0.5),
        "total_yards": q * F.lit(2.0),
        "total_tonnes": q * F.lit(0.75),
        "avg_revenue_per_stop": revenue / q,
        "total_revenue": revenue,
        "disposal_cost": disposal,
        "fuel_cost": F.when(F.col("l_partkey") % 211 == 0, F.lit(None).cast("double")).otherwise(fuel_raw),
        "labour_cost": labour,
        "maintenance_cost": maintenance,
        "admin_cost": admin,
        "total_cost": F.when(F.col("l_orderkey") % 97 == 0, sum5 + F.lit(1.0)).otherwise(sum5),
        "net_revenue": revenue - disposal,
        "gross_profit": revenue - sum5,
        "gross_margin_pct": (revenue - sum5) * F.lit(100) / revenue,
        "scheduled_hours": F.lit(8.0),
        "actual_hours": F.lit(8.0) + F.col("l_linenumber") * F.lit(0.25),
        "delay_minutes": (F.col("l_linenumber") * 5).cast("int"),
        "on_time_flag": F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("int"),
        "incident_flag": F.when(incident, 1).otherwise(0).cast("int"),
        "incident_type": F.when(incident, F.lit("returned load")),
        "_ingested_at": F.col("l_shipdate").cast("timestamp"),
        "_source_file": F.lit("lineitem.parquet"),
        "_source_seq": F.col("l_partkey"),
    }
    return base.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields])
