"""End-to-end run: raw rows -> Bronze -> Silver (+quarantine) -> Gold -> verdict.

Each layer is written as a Parquet table and the next layer reads the written
table back, so every stage starts from a short, file-backed lineage (a lost
executor re-reads files instead of re-running upstream stages). Keyed tables
are maintained with the idempotent upsert, so a rerun leaves row counts as
they were.

    python -m marginlens.plans.pipeline --sf-dir /root/testdata/sf0.01 --out /path/to/lakehouse
    python -m marginlens.plans.pipeline --csv /path/to/route_day.csv --out /path/to/lakehouse
"""
from __future__ import annotations

import argparse
import json
import logging
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from marginlens.functions.joins import free_shuffles
from marginlens.operators import clean, dims, facts, reports
from marginlens.operators.scorecard import scorecard_from_star
from marginlens.session import CODEC, get_spark, scratch_path
from marginlens.sinks.publish import publish_csv, published_rows
from marginlens.sinks.upsert import swap, upsert
from marginlens.sinks.writers import export_csv, overwrite, write_clustered
from marginlens.plans.runs import RunLog
from marginlens.sources.driver import SOURCE_TABLES, day_slices, route_day_bronze
from marginlens.sources.ingest import ingest
from marginlens.sources.schemas import (
    COST_COMPONENTS, DIM_DATE_SCHEMA, DIM_ROUTE_SCHEMA, FACT_DAY_SCHEMA, FACT_MONTH_SCHEMA, KEY_COLUMNS,
    PARTITIONS, SCORECARD_SCHEMA, assert_not_null, assert_schema,
)
from marginlens.sources.tables import source_state, table_state

log = logging.getLogger("marginlens.pipeline")

DEDUP_KEY = "route_date_key"
TABLES = {
    "bronze": "bronze/route_day",
    "silver": "silver/route_day",
    "quarantine": "silver/route_day_quarantine",
    "dim_route": "gold/dim_route",
    "dim_date": "gold/dim_date",
    "fact_route_day": "gold/fact_route_day",
    "fact_route_month": "gold/fact_route_month",
    "route_scorecard": "gold/route_scorecard",
}


CONTRACTS = {
    "dim_route": DIM_ROUTE_SCHEMA,
    "dim_date": DIM_DATE_SCHEMA,
    "fact_route_day": FACT_DAY_SCHEMA,
    "fact_route_month": FACT_MONTH_SCHEMA,
    "route_scorecard": SCORECARD_SCHEMA,
}


def read_layer(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A written table in its contract's columns (a partition column beside the
    contract still prunes the scan: filter on it through ``stored_layer``)."""
    table = stored_layer(spark, out, name)
    return table.select(*CONTRACTS[name].names) if name in CONTRACTS else table


def stored_layer(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A written table with all its stored columns."""
    path = table_paths(out)[name]
    if name not in CONTRACTS:
        return spark.read.parquet(path)
    beside = [c for c in PARTITIONS.get(name, []) if c not in CONTRACTS[name].names]
    schema = StructType(list(CONTRACTS[name].fields) + [StructField(c, IntegerType()) for c in beside])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def export_reports(spark: SparkSession, out: str, reports_dir: str) -> None:
    """The published CSV artefacts. Reports bounded by category counts go to
    one file each; per-route exports stay distributed (they grow with routes)."""
    fact_day, dim_route, dim_date, card = (
        read_layer(spark, out, name) for name in ("fact_route_day", "dim_route", "dim_date", "route_scorecard"))
    days = fact_day.join(dim_route, "route_id")
    dated = days.join(dim_date.select("date_key", "year", "quarter"), "date_key")
    # presentation rounding of the published artefacts (queries stay unrounded)
    bounded = {
        "waste_stream_margins": _rounded(reports.stream_medians(days), {"median_margin_pct": 2}),
        "cohort_margins": _rounded(reports.cohort_medians(days), {"cohort_median_margin": 2}),
        "cost_drivers": _rounded(reports.cost_drivers(days), {
            "loss_day_share_pct": 1, "profit_day_share_pct": 1, "loss_day_avg_gbp": 0, "profit_day_avg_gbp": 0})
        .orderBy(F.array_position(F.array(*[F.lit(c) for c in COST_COMPONENTS]), F.col("cost_component"))),
        "margin_trend": _rounded(reports.margin_trend(dated), {"margin_pct": 1, "loss_day_rate_pct": 1}),
    }
    for name, df in bounded.items():
        export_csv(df, f"{reports_dir}/{name}", single_file=True)
    export_csv(reports.scorecard_export(card), f"{reports_dir}/route_scorecard")
    export_csv(reports.underperforming_export(card), f"{reports_dir}/underperforming_routes")


def publish_reports(spark: SparkSession, out: str, folder: str) -> list[str]:
    """The six published files, each under its name (see :mod:`marginlens.sinks.publish`)."""
    fact_day, dim_route, dim_date, card = (
        read_layer(spark, out, name) for name in ("fact_route_day", "dim_route", "dim_date", "route_scorecard"))
    days = fact_day.join(dim_route, "route_id")
    dated = days.join(dim_date.select("date_key", "year", "quarter"), "date_key")
    in_order = F.array_position(F.array(*[F.lit(c) for c in COST_COMPONENTS]), F.col("cost_component"))
    per_route = {"median_margin_pct": 2, "cohort_median_margin": 2, "pct_days_below_peer": 3, "loss_day_rate": 3}
    # name -> (rows in order, digits, one file)
    files = {
        "waste_stream_margins": (reports.stream_medians(days), {"median_margin_pct": 2}, True),
        "cohort_margins": (reports.cohort_medians(days), {"cohort_median_margin": 2}, True),
        "cost_drivers": (reports.cost_drivers(days).orderBy(in_order), {
            "loss_day_share_pct": 1, "profit_day_share_pct": 1, "loss_day_avg_gbp": 0, "profit_day_avg_gbp": 0}, True),
        "margin_trend": (reports.margin_trend(dated), {"margin_pct": 1, "loss_day_rate_pct": 1}, True),
        "route_scorecard": (reports.scorecard_export(card), per_route, False),
        "underperforming_routes": (reports.underperforming_export(card), per_route, False),
    }
    names = []
    for name, (rows, digits, one) in files.items():
        names += publish_csv(published_rows(rows, digits), folder, name, one)
    return names


def table_paths(out: str) -> dict[str, str]:
    return {k: f"{out.rstrip('/')}/{v}" for k, v in TABLES.items()}


def bronze_layer(spark: SparkSession, out: str, raw: DataFrame, slices: Sequence[Column] = ()) -> DataFrame:
    """Full reload of the raw rows, each with its lineage and a fixed row id.

    ``slices``: predicates that deal the rows out. They are then written one slice
    after the other, and the shuffle files of a slice go before the next one
    begins; the table is moved into place when it is whole.
    """
    path = table_paths(out)["bronze"]
    if len(slices) < 2:
        overwrite(raw.withColumn(clean.ROW_ID, F.monotonically_increasing_id()), path)
        return spark.read.parquet(path)
    new, first = f"{path}__staging_{uuid.uuid4().hex}", 0
    for some in slices:
        rows = raw.filter(some).withColumn(clean.ROW_ID, F.monotonically_increasing_id() + F.lit(first))
        rows.write.mode("append").option("compression", CODEC).parquet(new)
        free_shuffles(spark)
        last = spark.read.parquet(new).agg(F.max(clean.ROW_ID)).first()[0]
        # ids of a task are below 1 << 33: the next slice's begin after those of the last task
        first = 0 if last is None else ((last >> 33) + 1) << 33
    swap(spark, new, path)
    return spark.read.parquet(path)


def silver_layer(spark: SparkSession, out: str, gathered: bool = False) -> None:
    """Clean rows upserted into Silver; every other Bronze row into the quarantine.
    ``gathered``: Bronze is stored in ranges of the day (the driver's tables are)."""
    p = table_paths(out)
    bronze = spark.read.parquet(p["bronze"])
    winners, rejects = clean.split_latest(bronze, DEDUP_KEY, clean.DEDUP_ORDER, required=KEY_COLUMNS)
    # gathered by month as the narrower Bronze rows, before the measures are added
    months = winners if gathered else winners.hint("rebalance", *PARTITIONS["silver"])
    upsert(spark, clean.silver(months), p["silver"], [DEDUP_KEY], PARTITIONS["silver"],
           check_unique=False, gathered=True)  # unique by construction
    overwrite(rejects, p["quarantine"])


def dims_layer(spark: SparkSession, out: str, check_hierarchy: bool = True) -> None:
    """Entity and calendar dimensions, after the hierarchy check."""
    p = table_paths(out)
    silver = spark.read.parquet(p["silver"])
    # one aggregate gives both the stability check and the entity dimension
    dim_route = dims.checked_dim_entity(silver) if check_hierarchy else dims.dim_route(silver)
    upsert(spark, assert_schema(dim_route, DIM_ROUTE_SCHEMA), p["dim_route"], ["route_id"], check_unique=False)
    upsert(spark, assert_schema(dims.dim_date(silver), DIM_DATE_SCHEMA), p["dim_date"], ["date_key"],
           check_unique=False)


def facts_layer(spark: SparkSession, out: str) -> None:
    """The day fact, then the month fact."""
    day_fact(spark, out)
    month_fact(spark, out)


def day_fact(spark: SparkSession, out: str) -> None:
    """The day fact by month."""
    p = table_paths(out)
    day = assert_schema(facts.fact_day(spark.read.parquet(p["silver"])), FACT_DAY_SCHEMA)
    upsert(spark, facts.by_month(assert_not_null(day, FACT_DAY_SCHEMA)), p["fact_route_day"], [DEDUP_KEY],
           PARTITIONS["fact_route_day"], check_unique=False, gathered=True)  # Silver is stored by month


def month_fact(spark: SparkSession, out: str) -> None:
    """The month fact clustered inside its regions."""
    p = table_paths(out)
    month = facts.fact_month(read_layer(spark, out, "fact_route_day"), spark.read.parquet(p["dim_route"]))
    write_clustered(assert_schema(month, FACT_MONTH_SCHEMA), p["fact_route_month"], PARTITIONS["fact_route_month"],
                    ["bu", "area"], tie_break=["route_id", "month_key"])


def scorecard_layer(spark: SparkSession, out: str) -> None:
    p = table_paths(out)
    card = scorecard_from_star(read_layer(spark, out, "fact_route_day"), read_layer(spark, out, "dim_route"))
    upsert(spark, assert_schema(card, SCORECARD_SCHEMA), p["route_scorecard"], ["route_id"], check_unique=False)


#: What each layer reads and writes, by table.
LAYER_TABLES = {
    "bronze": ((), ("bronze",)),
    "silver": (("bronze",), ("silver", "quarantine")),
    "dims": (("silver",), ("dim_route", "dim_date")),
    "facts": (("silver", "dim_route"), ("fact_route_day", "fact_route_month")),
    "scorecard": (("fact_route_day", "dim_route"), ("route_scorecard",)),
    "reports": (("fact_route_day", "dim_route", "dim_date", "route_scorecard"), ()),
}


def _source_fingerprint(spark: SparkSession, sf_dir: str | None, csv: str | None) -> str:
    if csv:
        return f"csv {csv} {table_state(spark, csv, '*')}"
    return f"tables {sf_dir} {source_state(spark, sf_dir, SOURCE_TABLES)}"


def run(spark: SparkSession, out: str | None = None, sf_dir: str | None = None,
        csv: str | None = None, check_hierarchy: bool = True,
        reports_dir: str | None = None, resume: bool = False) -> dict[str, int]:
    """Build every layer under ``out``; returns row counts per table.
    Gold tables are checked against their contracts before they are written.

    Each layer is recorded once it is written (see :mod:`marginlens.plans.runs`).
    With ``resume``, a layer whose inputs, outputs and options are as recorded is
    skipped, so a run that broke goes on where it stopped.
    """
    if (sf_dir is None) == (csv is None):
        raise ValueError("give exactly one source: sf_dir (driver tables) or csv (raw file)")
    out = (out or scratch_path(spark, "lakehouse")).rstrip("/")
    layers = {
        "bronze": lambda: (bronze_layer(spark, out, ingest(spark, csv)) if csv else
                           bronze_layer(spark, out, route_day_bronze(spark, sf_dir), day_slices(spark, sf_dir))),
        "silver": lambda: silver_layer(spark, out, gathered=sf_dir is not None),
        "dims": lambda: dims_layer(spark, out, check_hierarchy),
        "facts": lambda: facts_layer(spark, out),
        "scorecard": lambda: scorecard_layer(spark, out),
    }
    if reports_dir:
        layers["reports"] = lambda: export_reports(spark, out, reports_dir)
    options = {"bronze": lambda: _source_fingerprint(spark, sf_dir, csv),
               "dims": lambda: f"check_hierarchy={check_hierarchy}", "reports": lambda: f"to {reports_dir}"}
    log_ = RunLog(spark, out)
    paths = table_paths(out)
    for name, build in layers.items():
        began = time.perf_counter()
        reads, writes = ([paths[t] for t in side] for side in LAYER_TABLES[name])
        option = options.get(name, str)()
        if resume and log_.is_done(name, option, reads, writes):
            log.info("layer %-12s as recorded", name)
            continue
        build()
        log_.record(name, option, reads, writes)
        free_shuffles(spark)
        log.info("layer %-12s %7.2fs", name, time.perf_counter() - began)

    # every table's row count from one job (a union of per-table counts)
    tallies = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
               for name, path in table_paths(out).items()]
    counts = {r["table"]: r["rows"] for r in reduce(DataFrame.unionByName, tallies).collect()}
    counts = {name: counts[name] for name in TABLES}
    for name, n in counts.items():
        log.info("%-18s %12s rows", name, f"{n:,}")
    return counts


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir")
    ap.add_argument("--csv")
    ap.add_argument("--out")
    ap.add_argument("--reports")
    ap.add_argument("--resume", action="store_true", help="skip layers that are as an earlier run recorded them")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s | %(message)s")
    spark = get_spark("marginlens-pipeline")
    t0 = time.time()
    counts = run(spark, args.out, sf_dir=args.sf_dir, csv=args.csv, reports_dir=args.reports, resume=args.resume)
    print(json.dumps({"seconds": round(time.time() - t0, 2), "rows": counts}))
    spark.stop()


if __name__ == "__main__":
    main()
