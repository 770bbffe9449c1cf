"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

All read the driver's tables through the lakehouse layers
(:func:`marginlens.plans.layers.lakehouse`), i.e. the whole tables.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.functions.exprs import exact_sum, key_month, key_year, month_key
from marginlens.functions.ranks import numbered
from marginlens.operators import clean, dims, facts, reports
from marginlens.operators import quality as qa
from marginlens.session import scratch_path
from marginlens.sinks.upsert import upsert
from marginlens.sinks.writers import export_csv, write_clustered
from marginlens.sources.ingest import ingest
from marginlens.sources.schemas import FACT_MONTH_SCHEMA, KEY_COLUMNS, SOURCE_COLUMNS
from marginlens.sources.tables import driver_table
from marginlens.streaming.incremental import ingest_stream
from marginlens.operators import scorecard as sc
from marginlens.operators.history import Tolerance, drift, history
from marginlens.plans import pipeline
from marginlens.plans.layers import build, history_path, loaded_lakehouse
from marginlens.sinks.compact import compact
from marginlens.sources import catalog

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


# --- Silver ---------------------------------------------------------------
def _winners(spark, sf_dir):
    return clean.clean_rows(build(spark, sf_dir).bronze, "route_date_key", clean.DEDUP_ORDER, KEY_COLUMNS)


@query
def clean_latest_wins(spark, sf_dir):
    return _winners(spark, sf_dir).select(
        "route_date_key", "route_id", "date", "_source_seq", "total_revenue", "disposal_cost", "fuel_cost")


@query
def quarantine(spark, sf_dir):
    rows = clean.quarantine_rows(build(spark, sf_dir).bronze, "route_date_key", clean.DEDUP_ORDER, required=KEY_COLUMNS)
    return rows.select("route_date_key", "route_id", "date", "_source_seq", "total_revenue", "_reject_reason")


@query
def recompute_reconcile(spark, sf_dir):
    return clean.recompute(_winners(spark, sf_dir)).select(
        "route_date_key", "total_cost_src", "total_cost", "net_revenue_src", "net_revenue",
        "gross_profit_src", "gross_profit", "gross_margin_pct_src", "gross_margin_pct", "recon_flag")


@query
def guarded_metrics(spark, sf_dir):
    return clean.guard_metrics(clean.recompute(_winners(spark, sf_dir))).select(
        "route_date_key", "completed_stops", "total_stops", "profit_per_stop", "profit_per_km",
        "cost_per_tonne", "completion_rate", "metric_null_flag")


@query
def cohort_key(spark, sf_dir):
    return (build(spark, sf_dir).silver
            .groupBy("primary_waste_stream", "primary_customer_segment", "cohort_key")
            .agg(F.count(F.lit(1)).alias("route_days")))


# --- Gold dimensions and facts --------------------------------------------
@query
def date_key_roundtrip(spark, sf_dir):
    dd = dims.dim_date(build(spark, sf_dir).silver)
    out = dd.select("date", "date_key", key_year("date_key").alias("key_year"),
                    key_month("date_key").alias("key_month"))
    return out.select("*", month_key("key_year", "key_month").alias("month_key"),
                      ((F.col("key_year") == F.year("date")) & (F.col("key_month") == F.month("date"))
                       ).alias("roundtrip_ok"))


@query
def dim_date(spark, sf_dir):
    return dims.dim_date(build(spark, sf_dir).silver)


@query
def dim_route(spark, sf_dir):
    return dims.dim_route(build(spark, sf_dir).silver)


def _with_moves(silver: DataFrame) -> DataFrame:
    """Silver with two injected faults for the checks to find: days of
    some routes in another area, and retail days in another region."""
    moved = (F.col("_source_seq") % 13 == 0) & (F.col("route_id").cast("long") % 5 == 0)
    strayed = (F.col("_source_seq") % 17 == 0) & (F.col("primary_customer_segment") == F.lit("Retail"))
    return silver.withColumns({
        "area": F.when(moved, F.concat("area", F.lit("-moved"))).otherwise(F.col("area")),
        "region": F.when(strayed, F.lit("ELSEWHERE")).otherwise(F.col("region"))})


@query
def hierarchy_violations(spark, sf_dir):
    """Routes with more than one value of an attribute, and which ones vary."""
    return dims.hierarchy_violations(_with_moves(build(spark, sf_dir).silver))


@query
def hierarchy_flags(spark, sf_dir):
    """Every route's flags on the tables as they are (none varies)."""
    return dims.hierarchy_flags(build(spark, sf_dir).silver)


@query
def level_violations(spark, sf_dir):
    """Geography members with more than one parent (area -> bu -> region)."""
    return dims.level_violations(_with_moves(build(spark, sf_dir).silver))


@query
def fact_day(spark, sf_dir):
    return facts.fact_day(build(spark, sf_dir).silver)


@query
def fact_month(spark, sf_dir):
    return build(spark, sf_dir).fact_month()


TIE_MEASURES = ["total_revenue", "gross_profit", "total_cost", "completed_stops"]


@query
def month_day_tieout(spark, sf_dir):
    """Day-fact totals vs month-fact totals: one aggregate per table, joined."""
    L = build(spark, sf_dir)

    def totals(df, label):
        row = df.agg(*[exact_sum(c).alias(c) for c in TIE_MEASURES])
        pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias(label)) for c in TIE_MEASURES])
        return row.select(F.inline(pairs))

    day, month = totals(L.fact_day, "day_total"), totals(L.fact_month(), "month_total")
    out = day.join(month, "measure")
    diff = F.abs(F.col("day_total") - F.col("month_total"))
    return out.select("measure", "day_total", "month_total", diff.alias("diff"), (diff < 0.5).alias("ties"))


# --- Verdict ----------------------------------------------------------------
@query
def scorecard(spark, sf_dir):
    """Computed from the star (fact_day ⋈ dim_route) on every call."""
    L = build(spark, sf_dir)
    return sc.scorecard_from_star(L.fact_day, L.dim_route)


def scorecard_table(spark, sf_dir):
    """The written scorecard layer (computed once per lakehouse)."""
    return build(spark, sf_dir).scorecard()


@query
def tier_counts(spark, sf_dir):
    return reports.tier_counts(scorecard_table(spark, sf_dir))


@query
def flagged_routes(spark, sf_dir):
    return reports.flagged_routes(scorecard_table(spark, sf_dir))


@query
def scorecard_export(spark, sf_dir):
    return reports.scorecard_export(scorecard_table(spark, sf_dir))


@query
def underperforming_export(spark, sf_dir):
    return reports.underperforming_export(scorecard_table(spark, sf_dir))


# --- Evidence reports -------------------------------------------------------
@query
def stream_medians(spark, sf_dir):
    return reports.stream_medians(build(spark, sf_dir).days())


@query
def cohort_medians(spark, sf_dir):
    return reports.cohort_medians(build(spark, sf_dir).days())


@query
def loss_incident_rates(spark, sf_dir):
    return reports.loss_incident_rates(build(spark, sf_dir).days())


@query
def maintenance_by_day_type(spark, sf_dir):
    return reports.maintenance_by_day_type(build(spark, sf_dir).days())


@query
def cost_share_by_day_type(spark, sf_dir):
    return reports.cost_share_by_day_type(build(spark, sf_dir).days())


@query
def cost_avg_by_day_type(spark, sf_dir):
    return reports.cost_avg_by_day_type(build(spark, sf_dir).days())


@query
def cost_drivers(spark, sf_dir):
    return reports.cost_drivers(build(spark, sf_dir).days())


@query
def trend_year(spark, sf_dir):
    return reports.trend_year(build(spark, sf_dir).days_dated())


@query
def trend_quarter(spark, sf_dir):
    return reports.trend_quarter(build(spark, sf_dir).days_dated())


@query
def margin_trend(spark, sf_dir):
    return reports.margin_trend(build(spark, sf_dir).days_dated())


# --- Sinks and table maintenance -------------------------------------------
UPSERT_FIRST_LOAD_BEFORE = "1998-01-01"   # first batch: days before this date
UPSERT_SECOND_LOAD_FROM = "1997-07-01"    # second batch: overlaps six months


def _upsert_batches(spark, sf_dir):
    silver = build(spark, sf_dir).silver
    cols = ["route_date_key", "route_id", "date", "total_revenue", "gross_profit"]
    first = (silver.filter(F.col("date") < F.lit(UPSERT_FIRST_LOAD_BEFORE).cast("date"))
             .select(*cols, F.lit(1).alias("_batch")))
    second = (silver.filter(F.col("date") >= F.lit(UPSERT_SECOND_LOAD_FROM).cast("date"))
              .select(*cols, F.lit(2).alias("_batch")))
    return first, second


@query
def upsert_merge(spark, sf_dir):
    """Two overlapping loads merged on the key: the second load's rows win."""
    first, second = _upsert_batches(spark, sf_dir)
    path = scratch_path(spark, "upsert_merge")
    upsert(spark, first, path, ["route_date_key"])
    upsert(spark, second, path, ["route_date_key"])
    return spark.read.parquet(path)


@query
def upsert_idempotent(spark, sf_dir):
    """The second load applied twice leaves the same table as once."""
    first, second = _upsert_batches(spark, sf_dir)
    path = scratch_path(spark, "upsert_twice")
    upsert(spark, first, path, ["route_date_key"])
    upsert(spark, second, path, ["route_date_key"])
    upsert(spark, second, path, ["route_date_key"])
    return spark.read.parquet(path)


@query
def upsert_partitioned(spark, sf_dir):
    """Two overlapping loads into a table partitioned by region label.

    The labels look like numbers (``01``), one region is NULL, and the second
    load moves every route to another partition, so keys leave the old one.
    """
    first, second = _upsert_batches(spark, sf_dir)
    names = build(spark, sf_dir).dim_route.select("route_id", "region")

    def labelled(df, shift):
        code = F.pmod(F.crc32("region") + shift, F.lit(4)).cast("int")
        return df.join(names, "route_id").select(
            "route_date_key", "date", "total_revenue", "_batch",
            F.when(code > 0, F.lpad(code.cast("string"), 2, "0")).alias("zone"))

    path = scratch_path(spark, "upsert_partitioned")
    upsert(spark, labelled(first, 0), path, ["route_date_key"], partition_by=["zone"])
    upsert(spark, labelled(second, 1), path, ["route_date_key"], partition_by=["zone"])
    return (spark.read.schema("route_date_key string, date date, total_revenue double, _batch int, zone string")
            .parquet(path))


@query
def partitioned_month(spark, sf_dir):
    """Month fact written partitioned by region and clustered on (bu, area),
    then re-upserted through dynamic partition overwrite; read back whole."""
    fm = build(spark, sf_dir).fact_month()
    path = scratch_path(spark, "fact_month")
    write_clustered(fm, path, ["region"], ["bu", "area"], tie_break=["route_id", "month_key"])
    upsert(spark, spark.read.schema(FACT_MONTH_SCHEMA).parquet(path).select(*FACT_MONTH_SCHEMA.names),
           path, ["route_id", "year", "month"], partition_by=["region"], cluster_by=["bu", "area"])
    return spark.read.schema(FACT_MONTH_SCHEMA).parquet(path).select(*FACT_MONTH_SCHEMA.names)


@query
def csv_roundtrip(spark, sf_dir):
    """Raw rows exported as CSV, re-ingested under the enforced schema."""
    raw = build(spark, sf_dir).bronze.select(*SOURCE_COLUMNS)
    path = scratch_path(spark, "route_day_csv")
    export_csv(raw, path, compression="gzip")
    landed = ingest(spark, path)
    return landed.filter(F.col("_source_file").isNotNull()).select(*SOURCE_COLUMNS)


@query
def quality_report(spark, sf_dir):
    L = build(spark, sf_dir)
    return qa.quality_report(L.bronze, L.silver, L.quarantine, L.dim_route, L.dim_date,
                             L.fact_day, L.table("fact_route_month"), L.scorecard(),
                             expected_rows=driver_table(spark, sf_dir, "lineitem").count())


# --- Tables as the pipeline writes them -------------------------------------
@query
def table_bronze(spark, sf_dir):
    return build(spark, sf_dir).bronze.drop("_row_id")


@query
def table_silver(spark, sf_dir):
    return build(spark, sf_dir).silver


@query
def table_quarantine(spark, sf_dir):
    return build(spark, sf_dir).quarantine


@query
def table_dim_route(spark, sf_dir):
    return build(spark, sf_dir).dim_route


@query
def table_dim_date(spark, sf_dir):
    return build(spark, sf_dir).dim_date


@query
def table_fact_day(spark, sf_dir):
    return build(spark, sf_dir).fact_day


@query
def table_fact_month(spark, sf_dir):
    return build(spark, sf_dir).table("fact_route_month")


@query
def table_scorecard(spark, sf_dir):
    return scorecard_table(spark, sf_dir)


# --- Order of the ordered reports: the position of every row is a column ----
def _positions(df: DataFrame) -> DataFrame:
    """The rows in the report's own order, numbered from 1."""
    return numbered(df, "_pos").withColumn("position", (F.col("_pos") + 1).cast("int")).drop("_pos")


@query
def order_tier_counts(spark, sf_dir):
    return _positions(reports.tier_counts(scorecard_table(spark, sf_dir)))


@query
def order_stream_medians(spark, sf_dir):
    return _positions(reports.stream_medians(build(spark, sf_dir).days()))


@query
def order_margin_trend(spark, sf_dir):
    return _positions(reports.margin_trend(build(spark, sf_dir).days_dated()))


@query
def order_underperforming(spark, sf_dir):
    return _positions(reports.underperforming_export(scorecard_table(spark, sf_dir))).select("position", "route_id", "tier")


# --- fixed values: headline figures of the reference's committed dataset ---
COMMITTED_BASELINE = {"routes": 120, "below_peer": 22, "tier1": 4, "tier2": 18}


@query
def baseline_drift(spark, sf_dir):
    return qa.baseline_drift(scorecard_table(spark, sf_dir), COMMITTED_BASELINE)


def _streamed(spark, sf_dir):
    """Raw rows as CSV files (one folder per ship year), ingested by the file
    stream three files per micro-batch; returns the lake's folder."""
    raw = build(spark, sf_dir).bronze.drop("_row_id")
    src = scratch_path(spark, "stream_source")
    (raw.withColumn("_ship_year", F.year("date")).repartition("_ship_year")
        .write.mode("overwrite").option("header", True).option("compression", "gzip").partitionBy("_ship_year").csv(src))
    lake = scratch_path(spark, "stream_lake")
    ingest_stream(spark, src, lake, has_lineage=True, max_files_per_trigger=3)
    return lake


@query
def incremental_ingest(spark, sf_dir):
    """Every raw row after an incremental ingest: in Silver, or in the
    quarantine with its reason. Equals the one-batch result."""
    lake = _streamed(spark, sf_dir)
    cols = ["route_date_key", "route_id", "date", "_source_seq", "total_revenue"]
    silver = spark.read.parquet(f"{lake}/silver").select(*cols, F.lit("").alias("_reject_reason"))
    return silver.unionByName(spark.read.parquet(f"{lake}/quarantine").select(*cols, "_reject_reason"))


# --- Incremental loads: the same rows in three loads give the same tables ----
@query
def load_silver(spark, sf_dir):
    return loaded_lakehouse(spark, sf_dir).silver


@query
def load_quarantine(spark, sf_dir):
    return (loaded_lakehouse(spark, sf_dir).quarantine
            .select("route_date_key", "route_id", "date", "_source_seq", "total_revenue", "_reject_reason"))


@query
def load_fact_day(spark, sf_dir):
    return loaded_lakehouse(spark, sf_dir).fact_day


@query
def load_fact_month(spark, sf_dir):
    """The month fact after partial refreshes only: as if recomputed in full."""
    return loaded_lakehouse(spark, sf_dir).table("fact_route_month")


@query
def load_scorecard(spark, sf_dir):
    """The scorecard from value counts that loads added to and subtracted from."""
    return loaded_lakehouse(spark, sf_dir).table("route_scorecard")


#: How far a figure may move from one load to the next.
LOAD_TOLERANCES = {"routes": Tolerance(absolute=2), "silver_rows": Tolerance(relative=1.0),
                   "total_revenue": Tolerance(relative=1.0), "quarantine_rows": Tolerance(absolute=10, relative=0.5)}


@query
def run_drift(spark, sf_dir):
    """Every load's quality figures against the load before; the constants serve the first."""
    lake = loaded_lakehouse(spark, sf_dir)
    return drift(history(spark, history_path(lake.root)), LOAD_TOLERANCES, COMMITTED_BASELINE)


@query
def compacted_month(spark, sf_dir):
    """The month fact from many small files per region, compacted and clustered
    jointly on (bu, area); read back whole."""
    path = scratch_path(spark, "compacted_month")
    build(spark, sf_dir).fact_month().repartition(32).write.partitionBy("region").parquet(path)
    compact(spark, path, FACT_MONTH_SCHEMA, ["region"], ["bu", "area"], ["route_id", "month_key"])
    return spark.read.schema(FACT_MONTH_SCHEMA).parquet(path).select(*FACT_MONTH_SCHEMA.names)


@query
def resumed_run(spark, sf_dir):
    """Rows per table of a run that broke before the facts and was resumed."""
    class Broken(Exception):
        pass

    def broken(*_):
        raise Broken

    out = scratch_path(spark, "resumed")
    facts_layer, pipeline.facts_layer = pipeline.facts_layer, broken
    try:
        pipeline.run(spark, out, sf_dir=sf_dir)
    except Broken:
        pass
    finally:
        pipeline.facts_layer = facts_layer
    counts = pipeline.run(spark, out, sf_dir=sf_dir, resume=True)
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


BOUNDED_REPORTS = ["waste_stream_margins", "cohort_margins", "cost_drivers", "margin_trend"]


@query
def published_reports(spark, sf_dir):
    """The lines of the published files whose size does not grow with the data."""
    lake, folder = build(spark, sf_dir), scratch_path(spark, "published")
    lake.scorecard()
    pipeline.publish_reports(spark, lake.root, folder)
    text = spark.read.text([f"{folder}/{name}.csv" for name in BOUNDED_REPORTS], wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
    lines = text.select(name.alias("report"), F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("position", "line"))
    return lines.select("report", "position", "line")


@query
def catalog_contract(spark, sf_dir):
    """The Gold tables declared in the catalog, and their files held against it."""
    lake = build(spark, sf_dir)
    lake.scorecard()
    paths = pipeline.table_paths(lake.root)
    catalog.register(spark, "marginlens_gold", paths, pipeline.CONTRACTS)
    return catalog.check(spark, "marginlens_gold", paths, pipeline.CONTRACTS)
