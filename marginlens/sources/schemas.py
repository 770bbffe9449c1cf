"""Hand-written table contracts (never inferred).

Column names and order of the raw route-day file are fixed values: the file is
positional, so the order below is the contract.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

S, D, I, X, L, B, T = StringType(), DateType(), IntegerType(), DoubleType(), LongType(), BooleanType(), TimestampType()

# --- fixed values: raw route-day columns in file order (name, type, NOT NULL) ---
SOURCE_FIELDS = [
    ("route_date_key", S, True), ("date", D, True), ("year", I, True), ("month", I, True),
    ("quarter", S, True), ("day_of_week", S, True),
    ("region", S, True), ("bu", S, True), ("area", S, True), ("route_id", S, True),
    ("primary_waste_stream", S, True), ("primary_customer_segment", S, True),
    ("num_drivers", I, False), ("num_trucks", I, False), ("total_stops", I, False),
    ("completed_stops", I, False), ("missed_stops", I, False),
    ("total_distance_km", X, False), ("total_fuel_used_litres", X, False),
    ("total_labour_hours", X, False), ("total_yards", X, False), ("total_tonnes", X, False),
    ("avg_revenue_per_stop", X, False), ("total_revenue", X, False),
    ("disposal_cost", X, False), ("fuel_cost", X, False), ("labour_cost", X, False),
    ("maintenance_cost", X, False), ("admin_cost", X, False), ("total_cost", X, False),
    ("net_revenue", X, False), ("gross_profit", X, False), ("gross_margin_pct", X, False),
    ("scheduled_hours", X, False), ("actual_hours", X, False), ("delay_minutes", I, False),
    ("on_time_flag", I, False), ("incident_flag", I, False), ("incident_type", S, False),
]

SOURCE_SCHEMA = StructType([StructField(n, t, not required) for n, t, required in SOURCE_FIELDS])
SOURCE_COLUMNS = [f.name for f in SOURCE_SCHEMA.fields]
KEY_COLUMNS = [n for n, _, required in SOURCE_FIELDS if required]

# Lineage added on ingest: load time, source file, position in the load.
LINEAGE_FIELDS = [
    StructField("_ingested_at", T, True),
    StructField("_source_file", S, True),
    StructField("_source_seq", L, True),
]
BRONZE_SCHEMA = StructType(list(SOURCE_SCHEMA.fields) + LINEAGE_FIELDS)
# A Bronze shape with every field nullable, to land rows with a NULL key.
BRONZE_SCHEMA_NULLABLE = StructType([StructField(f.name, f.dataType, True) for f in BRONZE_SCHEMA.fields])

# Source measures kept as *_src once Silver recomputes them.
SOURCE_RENAMES = {
    "total_cost": "total_cost_src",
    "net_revenue": "net_revenue_src",
    "gross_profit": "gross_profit_src",
    "gross_margin_pct": "gross_margin_pct_src",
}
COST_COMPONENTS = ["disposal_cost", "fuel_cost", "labour_cost", "maintenance_cost", "admin_cost"]

# --- fixed values: the atomic day fact, in column order (name, type, summed into the month fact) ---
FACT_DAY_FIELDS = [
    ("route_date_key", S, False), ("date_key", I, False), ("route_id", S, False),
    ("num_drivers", I, False), ("num_trucks", I, False),
    ("total_stops", I, True), ("completed_stops", I, True), ("missed_stops", I, True),
    ("total_distance_km", X, True), ("total_fuel_used_litres", X, True),
    ("total_labour_hours", X, True), ("total_yards", X, True), ("total_tonnes", X, True),
    ("avg_revenue_per_stop", X, False), ("total_revenue", X, True),
    ("disposal_cost", X, True), ("fuel_cost", X, True), ("labour_cost", X, True),
    ("maintenance_cost", X, True), ("admin_cost", X, True), ("total_cost", X, True),
    ("net_revenue", X, True), ("gross_profit", X, True), ("gross_margin_pct", X, False),
    ("scheduled_hours", X, False), ("actual_hours", X, False), ("delay_minutes", I, False),
    ("profit_per_stop", X, False), ("profit_per_km", X, False), ("cost_per_tonne", X, False),
    ("completion_rate", X, False),
    ("on_time_flag", I, False), ("incident_flag", I, False), ("incident_type", S, False),
    ("metric_null_flag", B, False), ("recon_flag", B, False),
]
FACT_KEYS = ["route_date_key", "date_key", "route_id"]
FACT_DAY_SCHEMA = StructType([StructField(n, t, n not in FACT_KEYS) for n, t, _ in FACT_DAY_FIELDS])
FACT_MEASURES = [n for n, _, _ in FACT_DAY_FIELDS if n not in FACT_KEYS]
SUM_MEASURES = [n for n, _, summed in FACT_DAY_FIELDS if summed]
INT_MEASURES = [n for n, t, summed in FACT_DAY_FIELDS if summed and t is I]
ROUTE_ATTRS = ["region", "bu", "area", "primary_waste_stream", "primary_customer_segment", "cohort_key"]

# --- Gold contracts ---------------------------------------------------------
DIM_DATE_SCHEMA = StructType([
    StructField("date_key", I), StructField("date", D), StructField("year", I),
    StructField("quarter", S), StructField("month", I), StructField("day_of_week", S),
])
DIM_ROUTE_SCHEMA = StructType([StructField(c, S) for c in ["route_id"] + ROUTE_ATTRS])
FACT_MONTH_SCHEMA = StructType(
    [StructField(c, S) for c in ["route_id", "region", "bu", "area"]]
    + [StructField("year", I), StructField("month", I),
       StructField("days_active", L), StructField("loss_days", L)]
    + [StructField(c, L if c in INT_MEASURES else X) for c in SUM_MEASURES]
    + [StructField("gross_margin_pct", X), StructField("month_key", I)]
)
SCORECARD_SCHEMA = StructType([
    StructField("route_id", S), StructField("cohort_key", S), StructField("n_days", L),
    StructField("median_margin_pct", X), StructField("median_profit_per_stop", X),
    StructField("median_gross_profit", X), StructField("loss_day_rate", X),
    StructField("pct_days_below_peer", X), StructField("cohort_median_margin", X),
    StructField("cohort_median_profit_per_stop", X), StructField("below_peer_flag", B),
    StructField("tier", S), StructField("tier_code", I),
])


# --- NOT NULL columns of the Gold contracts ---
NOT_NULL = {
    "dim_date": DIM_DATE_SCHEMA.names,
    "dim_route": DIM_ROUTE_SCHEMA.names,
    "fact_route_day": FACT_KEYS,
    "fact_route_month": ["route_id", "region", "bu", "area", "year", "month"],
    "route_scorecard": ["route_id"],
}

# --- stored layout: partition columns of each table (the others have none) ---
PARTITIONS = {
    "silver": ["year", "month"],
    "fact_route_day": ["month_key"],  # yyyymm of date_key, beside the contract
    "fact_route_month": ["region"],
}


def schema_mismatches(df: DataFrame, contract: StructType) -> list[str]:
    """Differences between ``df``'s schema and a contract (names, order, types)."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    if got == want:
        return []
    problems = []
    gn, wn = [n for n, _ in got], [n for n, _ in want]
    for n in wn:
        if n not in gn:
            problems.append(f"missing column {n}")
    for n in gn:
        if n not in wn:
            problems.append(f"unexpected column {n}")
    gt = dict(got)
    for n, t in want:
        if n in gt and gt[n] != t:
            problems.append(f"{n}: {gt[n]} != {t}")
    if not problems and gn != wn:
        problems.append("column order differs")
    return problems


def assert_not_null(df: DataFrame, contract: StructType) -> DataFrame:
    """``df`` with a check that its NOT NULL columns hold no NULL, raised by the task that meets one."""
    from pyspark.sql import functions as F

    required = [f.name for f in contract.fields if not f.nullable]
    return df.withColumns({
        n: F.coalesce(F.col(n), F.raise_error(F.lit(f"NULL in NOT NULL column {n}")).cast(contract[n].dataType))
        for n in required})


def assert_schema(df: DataFrame, contract: StructType) -> DataFrame:
    problems = schema_mismatches(df, contract)
    if problems:
        raise AssertionError("schema contract violated: " + "; ".join(problems))
    return df
