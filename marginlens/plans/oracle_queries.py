"""Oracle SQL per registered query (see :mod:`marginlens.plans.oracle_sql`)."""
from __future__ import annotations

import zlib

from marginlens.plans.oracle_sql import with_chain
from marginlens.plans.pipeline import CONTRACTS
from marginlens.sources.catalog import declared
from marginlens.sources.schemas import COST_COMPONENTS as COMPONENTS
from marginlens.sources.schemas import INT_MEASURES, PARTITIONS, ROUTE_ATTRS, SOURCE_COLUMNS, SUM_MEASURES

ORACLE: dict[str, str] = {}

SUMS_INT = [c for c in SUM_MEASURES if c in INT_MEASURES]
SUMS_DBL = [c for c in SUM_MEASURES if c not in INT_MEASURES]


def D(x: str) -> str:
    """The unrounded column's shortest decimal form at six places."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,6))"


def SUMC(x: str) -> str:
    """Sum in millionths as a double (the decimal point is taken out of the text)."""
    return f"CAST(replace(CAST(sum({D(x)}) AS VARCHAR), '.', '') AS DOUBLE)"


def AVGC(x: str) -> str:
    return f"({SUMC(x)} / NULLIF(CAST(count({x}) AS DOUBLE), 0) / 1000000.0)"


def RATIO(num: str, den: str) -> str:
    return f"({SUMC(num)} * 100 / NULLIF({SUMC(den)}, 0))"


def RND(x: str, n: int) -> str:
    """Half-up rounding of the shortest decimal form, like Spark's ``round``."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def sql(name: str, final_select: str, scorecard: bool = False, ctes: tuple[str, ...] = ()) -> None:
    ORACLE[name] = with_chain(final_select, scorecard=scorecard, extra_ctes=ctes)


DAY_TYPE = "CASE WHEN gross_profit < 0 THEN 'loss day' ELSE 'profitable day' END"

sql("clean_latest_wins", "SELECT route_date_key, route_id, date, _source_seq, total_revenue, disposal_cost, fuel_cost FROM silver")
sql("quarantine", "SELECT route_date_key, route_id, date, _source_seq, total_revenue, _reject_reason FROM quarantine")
sql("recompute_reconcile", """SELECT route_date_key, total_cost_src, total_cost, net_revenue_src, net_revenue,
  gross_profit_src, gross_profit, gross_margin_pct_src, gross_margin_pct, recon_flag FROM silver""")
sql("guarded_metrics", """SELECT route_date_key, completed_stops, total_stops, profit_per_stop, profit_per_km,
  cost_per_tonne, completion_rate, metric_null_flag FROM silver""")
sql("cohort_key", """SELECT primary_waste_stream, primary_customer_segment, cohort_key, count(*) AS route_days
  FROM silver GROUP BY ALL""")
sql("date_key_roundtrip", """SELECT date, date_key, CAST(date_key // 10000 AS INTEGER) AS key_year,
  CAST((date_key // 100) % 100 AS INTEGER) AS key_month,
  CAST((date_key // 10000) * 100 + (date_key // 100) % 100 AS INTEGER) AS month_key,
  (date_key // 10000 = year(date)) AND ((date_key // 100) % 100 = month(date)) AS roundtrip_ok
  FROM dim_date""")
sql("dim_date", "SELECT * FROM dim_date")
sql("dim_route", "SELECT * FROM dim_route")
_flags = ", ".join(f"coalesce(min({a}) <> max({a}), false) AS {a}_varies" for a in ROUTE_ATTRS)
_viol = " OR ".join(f"coalesce(min({a}) <> max({a}), false)" for a in ROUTE_ATTRS)
MOVED = """moved AS (
  SELECT * REPLACE (
    CASE WHEN _source_seq % 13 = 0 AND CAST(route_id AS BIGINT) % 5 = 0 THEN area || '-moved' ELSE area END AS area,
    CASE WHEN _source_seq % 17 = 0 AND primary_customer_segment = 'Retail' THEN 'ELSEWHERE' ELSE region END AS region) FROM silver
)"""
sql("hierarchy_violations", f"SELECT route_id, {_flags}, ({_viol}) AS violates FROM moved GROUP BY route_id HAVING {_viol}",
    ctes=(MOVED,))
sql("hierarchy_flags", f"SELECT route_id, {_flags}, ({_viol}) AS violates FROM silver GROUP BY route_id")
sql("level_violations", """SELECT 'area' AS level, area AS member, 'bu' AS parent_level FROM moved
  GROUP BY area HAVING coalesce(min(bu) <> max(bu), false)
  UNION ALL
  SELECT 'bu', bu, 'region' FROM moved GROUP BY bu HAVING coalesce(min(region) <> max(region), false)""", ctes=(MOVED,))
sql("fact_day", "SELECT * FROM fact_day")

_month_sums = ", ".join([f"CAST(sum({c}) AS BIGINT) AS {c}" for c in SUMS_INT]
                        + [f"{SUMC(c)} / 1000000.0 AS {c}" for c in SUMS_DBL])
FACT_MONTH = f"""fact_month AS (
  SELECT m.route_id, d.region, d.bu, d.area, m.year, m.month, m.days_active, m.loss_days,
         total_stops, completed_stops, missed_stops, {", ".join(SUMS_DBL)},
         gross_profit * 100 / NULLIF(total_revenue, 0) AS gross_margin_pct,
         CAST(m.year * 100 + m.month AS INTEGER) AS month_key
  FROM (SELECT route_id, CAST(date_key // 10000 AS INTEGER) AS year,
               CAST((date_key // 100) % 100 AS INTEGER) AS month,
               count(*) AS days_active,
               CAST(sum(CAST(gross_profit < 0 AS INTEGER)) AS BIGINT) AS loss_days,
               {_month_sums}
        FROM fact_day GROUP BY ALL) m
  JOIN dim_route d USING (route_id)
)"""
sql("fact_month", "SELECT * FROM fact_month", ctes=(FACT_MONTH,))

_tie = " UNION ALL ".join(
    f"SELECT '{c}' AS measure, (SELECT {SUMC(c)} / 1000000.0 FROM fact_day) AS day_total, "
    f"(SELECT {SUMC(c)} / 1000000.0 FROM fact_month) AS month_total" for c in
    ["total_revenue", "gross_profit", "total_cost", "completed_stops"])
sql("month_day_tieout", f"""SELECT measure, day_total, month_total, abs(day_total - month_total) AS diff,
  abs(day_total - month_total) < 0.5 AS ties FROM ({_tie}) t""", ctes=(FACT_MONTH,))

sql("scorecard", "SELECT * FROM scorecard", scorecard=True)
sql("tier_counts", "SELECT tier, count(*) AS routes FROM scorecard GROUP BY tier", scorecard=True)
sql("flagged_routes", f"""SELECT route_id, cohort_key, {RND('median_margin_pct', 1)} AS median_margin_pct,
  {RND('cohort_median_margin', 1)} AS cohort_median_margin, {RND('pct_days_below_peer', 2)} AS pct_days_below_peer,
  {RND('loss_day_rate', 2)} AS loss_day_rate, tier
  FROM scorecard WHERE below_peer_flag""", scorecard=True)
_export = f"""route_id, cohort_key, {RND('median_margin_pct', 2)} AS median_margin_pct,
  {RND('cohort_median_margin', 2)} AS cohort_median_margin, {RND('pct_days_below_peer', 3)} AS pct_days_below_peer,
  {RND('loss_day_rate', 3)} AS loss_day_rate, tier, tier_code"""
sql("scorecard_export", f"SELECT {_export} FROM scorecard", scorecard=True)
sql("underperforming_export", f"SELECT {_export} FROM scorecard WHERE tier_code <> 0", scorecard=True)

sql("stream_medians", """SELECT primary_waste_stream, quantile_disc(gross_margin_pct, 0.5) AS median_margin_pct,
  count(*) AS route_days FROM days GROUP BY primary_waste_stream""")
sql("cohort_medians", """SELECT cohort_key, quantile_disc(gross_margin_pct, 0.5) AS cohort_median_margin,
  count(*) AS route_days FROM days GROUP BY cohort_key""")
sql("loss_incident_rates", """SELECT route_days, loss_days, loss_days * 100 / NULLIF(route_days, 0) AS loss_day_pct,
  incident_loss_days, incident_loss_days * 100 / NULLIF(loss_days, 0) AS incident_loss_pct,
  incident_days, incident_days * 100 / NULLIF(route_days, 0) AS incident_day_pct
  FROM (SELECT count(*) AS route_days, count_if(gross_profit < 0) AS loss_days,
               count_if(gross_profit < 0 AND incident_flag = 1) AS incident_loss_days,
               count_if(incident_flag = 1) AS incident_days FROM days) t""")
sql("maintenance_by_day_type", f"""SELECT {DAY_TYPE} AS day_type, {AVGC('maintenance_cost')} AS avg_maintenance_cost,
  quantile_disc(maintenance_cost, 0.5) AS median_maintenance_cost, count(*) AS days FROM days GROUP BY 1""")
_shares = ", ".join(f"{RATIO(c, 'total_cost')} AS {c}_share_pct" for c in COMPONENTS)
sql("cost_share_by_day_type", f"SELECT {DAY_TYPE} AS day_type, {_shares} FROM days GROUP BY 1")
_avgs = ", ".join(f"{AVGC(c)} AS avg_{c}" for c in COMPONENTS)
sql("cost_avg_by_day_type", f"SELECT {DAY_TYPE} AS day_type, {AVGC('total_revenue')} AS avg_revenue, {_avgs} FROM days GROUP BY 1")
_long = " UNION ALL ".join(
    f"SELECT {DAY_TYPE} AS day_type, total_cost, '{c}' AS cost_component, {c} AS v FROM days" for c in COMPONENTS)
_drivers = f"""SELECT cost_component,
  {SUMC("CASE WHEN day_type = 'loss day' THEN v END")} * 100
     / NULLIF({SUMC("CASE WHEN day_type = 'loss day' THEN total_cost END")}, 0) AS loss_day_share_pct,
  {SUMC("CASE WHEN day_type = 'profitable day' THEN v END")} * 100
     / NULLIF({SUMC("CASE WHEN day_type = 'profitable day' THEN total_cost END")}, 0) AS profit_day_share_pct,
  {SUMC("CASE WHEN day_type = 'loss day' THEN v END")}
     / NULLIF(CAST(count(CASE WHEN day_type = 'loss day' THEN v END) AS DOUBLE), 0) / 1000000.0 AS loss_day_avg_gbp,
  {SUMC("CASE WHEN day_type = 'profitable day' THEN v END")}
     / NULLIF(CAST(count(CASE WHEN day_type = 'profitable day' THEN v END) AS DOUBLE), 0) / 1000000.0 AS profit_day_avg_gbp
  FROM ({_long}) t GROUP BY cost_component"""
sql("cost_drivers", _drivers)
DATED = "dated AS (SELECT d.*, dd.year AS year, dd.quarter AS quarter FROM days d JOIN dim_date dd USING (date_key))"
_trend = f"{RATIO('gross_profit', 'total_revenue')} AS margin_pct, avg(CAST(gross_profit < 0 AS INTEGER)) * 100 AS loss_day_rate_pct"
sql("trend_year", f"SELECT year, {_trend} FROM dated GROUP BY year", ctes=(DATED,))
sql("trend_quarter", f"SELECT year, quarter, {_trend} FROM dated GROUP BY year, quarter", ctes=(DATED,))
_margin_trend = f"""SELECT CASE WHEN GROUPING(quarter) = 1 THEN 'year' ELSE 'quarter' END AS period_type,
  CASE WHEN GROUPING(quarter) = 1 THEN CAST(year AS VARCHAR) ELSE CAST(year AS VARCHAR) || ' ' || quarter END AS period,
  {_trend} FROM dated GROUP BY GROUPING SETS ((year), (year, quarter))"""
sql("margin_trend", _margin_trend, ctes=(DATED,))

_UPS = """first_load AS (SELECT route_date_key, route_id, date, total_revenue, gross_profit, 1 AS _batch
                    FROM silver WHERE date < DATE '1998-01-01'),
second_load AS (SELECT route_date_key, route_id, date, total_revenue, gross_profit, 2 AS _batch
                    FROM silver WHERE date >= DATE '1997-07-01')"""
_UPS_SELECT = """SELECT f.* FROM first_load f ANTI JOIN second_load s USING (route_date_key)
  UNION ALL SELECT * FROM second_load"""
sql("upsert_merge", _UPS_SELECT, ctes=(_UPS,))
sql("upsert_idempotent", _UPS_SELECT, ctes=(_UPS,))
# --- fixed values: crc32 of the region names (DuckDB has no crc32) ---
REGION_CRC = {name: zlib.crc32(name.encode()) for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")}


def _zone(shift: int) -> str:
    code = " ".join(f"WHEN '{n}' THEN {(c + shift) % 4}" for n, c in REGION_CRC.items())
    return f"CASE CASE region {code} END WHEN 1 THEN '01' WHEN 2 THEN '02' WHEN 3 THEN '03' END"


sql("upsert_partitioned", f"""SELECT f.route_date_key, f.date, f.total_revenue, f._batch, {_zone(0)} AS zone
  FROM first_load f JOIN dim_route USING (route_id) WHERE f.route_date_key NOT IN (SELECT route_date_key FROM second_load)
  UNION ALL SELECT s.route_date_key, s.date, s.total_revenue, s._batch, {_zone(1)}
  FROM second_load s JOIN dim_route USING (route_id)""", ctes=(_UPS,))
sql("partitioned_month", "SELECT * FROM fact_month", ctes=(FACT_MONTH,))
_SRC = ", ".join(SOURCE_COLUMNS)
sql("csv_roundtrip", f"SELECT {_SRC} FROM bronze")

_QA = f"""
SELECT 'clean_plus_quarantine_equals_input' AS "check", (SELECT count(*) FROM bronze) AS expected,
       (SELECT count(*) FROM silver) + (SELECT count(*) FROM quarantine) AS actual
UNION ALL SELECT 'bronze_rows', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM bronze)
UNION ALL SELECT 'source_columns_missing', 0, 0
UNION ALL SELECT 'lineage_ingested_at_null', 0, (SELECT count(*) FROM bronze WHERE _ingested_at IS NULL)
UNION ALL SELECT 'lineage_source_file_null', 0, (SELECT count(*) FROM bronze WHERE _source_file IS NULL)
UNION ALL SELECT 'silver_key_unique', (SELECT count(*) FROM silver), (SELECT count(DISTINCT route_date_key) FROM silver)
UNION ALL SELECT 'recon_mismatch_rows', 0, (SELECT count_if(recon_flag) FROM silver)
UNION ALL SELECT 'recon_unknown_rows', NULL, (SELECT count_if(recon_flag IS NULL) FROM silver)
UNION ALL SELECT 'metric_null_rows', NULL, (SELECT count_if(metric_null_flag) FROM silver)
UNION ALL SELECT 'null_margin_rows', NULL, (SELECT count_if(gross_margin_pct IS NULL) FROM silver)
UNION ALL SELECT 'min_date_key', NULL, (SELECT CAST(strftime(min(date), '%Y%m%d') AS BIGINT) FROM silver)
UNION ALL SELECT 'max_date_key', NULL, (SELECT CAST(strftime(max(date), '%Y%m%d') AS BIGINT) FROM silver)
UNION ALL SELECT 'quarantine_rows', NULL, (SELECT count(*) FROM quarantine)
UNION ALL SELECT 'dim_route_key_unique', (SELECT count(*) FROM dim_route), (SELECT count(DISTINCT route_id) FROM dim_route)
UNION ALL SELECT 'dim_date_key_unique', (SELECT count(*) FROM dim_date), (SELECT count(DISTINCT date_key) FROM dim_date)
UNION ALL SELECT 'fact_rows_without_route', 0, (SELECT count(*) FROM fact_day f ANTI JOIN dim_route d USING (route_id))
UNION ALL SELECT 'month_day_untied_measures', 0, (
    SELECT {" + ".join(f"CAST(abs((SELECT sum({D(c)}) FROM fact_day) - (SELECT sum({D(c)}) FROM fact_month)) >= 0.5 AS INTEGER)"
                       for c in ["total_revenue", "gross_profit", "total_cost", "completed_stops"])})
UNION ALL SELECT 'scorecard_one_row_per_route', (SELECT count(*) FROM dim_route), (SELECT count(*) FROM scorecard)
UNION ALL SELECT 'scorecard_null_tier', 0, (SELECT count_if(tier IS NULL) FROM scorecard)
"""
sql("quality_report", f"""SELECT "check", CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
  CAST(expected AS BIGINT) = CAST(actual AS BIGINT) AS passed FROM ({_QA}) q""", scorecard=True, ctes=(FACT_MONTH,))
sql("baseline_drift", """SELECT metric, expected, actual, expected = actual AS matches FROM (
  SELECT 'routes' AS metric, CAST(120 AS BIGINT) AS expected, (SELECT count(*) FROM scorecard) AS actual
  UNION ALL SELECT 'below_peer', 22, (SELECT count_if(below_peer_flag) FROM scorecard)
  UNION ALL SELECT 'tier1', 4, (SELECT count_if(tier_code = 1) FROM scorecard)
  UNION ALL SELECT 'tier2', 18, (SELECT count_if(tier_code = 2) FROM scorecard)) b""", scorecard=True)
sql("incremental_ingest", """SELECT route_date_key, route_id, date, _source_seq, total_revenue, '' AS _reject_reason FROM silver
  UNION ALL SELECT route_date_key, route_id, date, _source_seq, total_revenue, _reject_reason FROM quarantine""")
for _name in ("bronze", "silver", "quarantine", "dim_route", "dim_date", "fact_day"):
    sql(f"table_{_name}", f"SELECT * FROM {_name}")
sql("table_fact_month", "SELECT * FROM fact_month", ctes=(FACT_MONTH,))
sql("table_scorecard", "SELECT * FROM scorecard", scorecard=True)

sql("order_tier_counts", """SELECT tier, count(*) AS routes, CAST(row_number() OVER (ORDER BY tier) AS INTEGER) AS position
  FROM scorecard GROUP BY tier""", scorecard=True)
sql("order_stream_medians", """SELECT *, CAST(row_number() OVER (ORDER BY median_margin_pct, primary_waste_stream) AS INTEGER) AS position
  FROM (SELECT primary_waste_stream, quantile_disc(gross_margin_pct, 0.5) AS median_margin_pct, count(*) AS route_days
        FROM days GROUP BY primary_waste_stream)""")
sql("order_margin_trend", f"""SELECT *, CAST(row_number() OVER (ORDER BY period_type DESC, period) AS INTEGER) AS position FROM (
  SELECT CASE WHEN GROUPING(quarter) = 1 THEN 'year' ELSE 'quarter' END AS period_type,
    CASE WHEN GROUPING(quarter) = 1 THEN CAST(year AS VARCHAR) ELSE CAST(year AS VARCHAR) || ' ' || quarter END AS period,
    {_trend} FROM dated GROUP BY GROUPING SETS ((year), (year, quarter)))""", ctes=(DATED,))
sql("order_underperforming", f"""SELECT CAST(row_number() OVER (ORDER BY loss_day_rate DESC, route_id) AS INTEGER) AS position,
  route_id, tier FROM (SELECT {_export} FROM scorecard WHERE tier_code <> 0)""", scorecard=True)

# --- incremental loads, compaction, resumed run ---
sql("load_silver", "SELECT * FROM silver")
sql("load_quarantine", "SELECT route_date_key, route_id, date, _source_seq, total_revenue, _reject_reason FROM quarantine")
sql("load_fact_day", "SELECT * FROM fact_day")
sql("load_fact_month", "SELECT * FROM fact_month", ctes=(FACT_MONTH,))
sql("load_scorecard", "SELECT * FROM scorecard", scorecard=True)
sql("compacted_month", "SELECT * FROM fact_month", ctes=(FACT_MONTH,))
_ROWS = {"bronze": "bronze", "silver": "silver", "quarantine": "quarantine", "dim_route": "dim_route", "dim_date": "dim_date",
         "fact_route_day": "fact_day", "fact_route_month": "fact_month", "route_scorecard": "scorecard"}
sql("resumed_run", " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {cte}) AS row_count" for t, cte in _ROWS.items()),
    scorecard=True, ctes=(FACT_MONTH,))

# --- run history: the figures after each load, from the rows it had seen ---
_AFTER = {0: "DATE '1998-01-01'", 1: "DATE '2000-01-01'", 2: "DATE '9999-01-01'"}


def _run_figures(run: int) -> list[str]:
    """CTEs of one run: the same chain over the rows that had come in by then."""
    return [f"""seen{run} AS (
  SELECT *, row_number() OVER (PARTITION BY route_date_key ORDER BY _ingested_at DESC NULLS LAST, _source_seq DESC NULLS LAST) AS _rn
  FROM bronze WHERE date < {_AFTER[run]}
)""", f"""silver{run} AS (
  SELECT s.* FROM (
    SELECT *, gross_profit * 100 / NULLIF(total_revenue, 0) AS gross_margin_pct, gross_profit / NULLIF(completed_stops, 0) AS profit_per_stop,
      (abs(total_cost - total_cost_src) > 0.02) OR (abs(net_revenue - net_revenue_src) > 0.02)
        OR (abs(gross_profit - gross_profit_src) > 0.02) AS recon_flag,
      (completed_stops IS NULL OR completed_stops = 0) OR (total_distance_km IS NULL OR total_distance_km = 0)
        OR (total_tonnes IS NULL OR total_tonnes = 0) OR (total_stops IS NULL OR total_stops = 0) AS metric_null_flag,
      concat_ws(' | ', primary_waste_stream, primary_customer_segment) AS cohort_key
    FROM (SELECT *, total_revenue - disposal_cost AS net_revenue, total_revenue - total_cost AS gross_profit
          FROM (SELECT * EXCLUDE (total_cost, net_revenue, gross_profit, gross_margin_pct), total_cost AS total_cost_src,
                       net_revenue AS net_revenue_src, gross_profit AS gross_profit_src,
                       disposal_cost + fuel_cost + labour_cost + maintenance_cost + admin_cost AS total_cost
                FROM seen{run} WHERE route_date_key IS NOT NULL AND _rn = 1))) s
)""", f"""cohort{run} AS (
  SELECT cohort_key, quantile_disc(gross_margin_pct, 0.5) AS m FROM silver{run} GROUP BY cohort_key
)""", f"""routes{run} AS (
  SELECT route_id, quantile_disc(gross_profit, 0.5) < 0 OR avg(CAST(gross_profit < 0 AS INTEGER)) > 0.5 AS loss_making,
         avg(CAST(gross_margin_pct < m AS INTEGER)) > 0.7 AS below
  FROM silver{run} JOIN cohort{run} USING (cohort_key) GROUP BY route_id
)""", f"""figures{run} AS (
  SELECT {run} AS run_no, unnest(['silver_rows', 'recon_mismatch_rows', 'metric_null_rows', 'quarantine_rows', 'loss_days',
                                  'total_revenue', 'routes', 'below_peer', 'tier1', 'tier2']) AS metric,
         unnest([silver_rows, recon, metric_null, n_seen - silver_rows, loss_days, revenue, n_routes, below, tier1, tier2]) AS value
  FROM (SELECT count(*)::DOUBLE AS silver_rows, count_if(recon_flag)::DOUBLE AS recon, count_if(metric_null_flag)::DOUBLE AS metric_null,
               count_if(gross_profit < 0)::DOUBLE AS loss_days, {SUMC('total_revenue')} / 1000000.0 AS revenue FROM silver{run}),
       (SELECT count(*)::DOUBLE AS n_seen FROM seen{run}),
       (SELECT count(*)::DOUBLE AS n_routes, count_if(below)::DOUBLE AS below, count_if(coalesce(loss_making, false))::DOUBLE AS tier1,
               count_if(NOT coalesce(loss_making, false) AND below)::DOUBLE AS tier2 FROM routes{run})
)"""]


_RUNS = tuple(c for run in _AFTER for c in _run_figures(run))
sql("run_drift", """SELECT run_no, metric, previous, value, value - previous AS change, allowed,
  CASE WHEN previous IS NOT NULL THEN abs(value - previous) > allowed END AS drifted
  FROM (SELECT *, greatest(a, abs(previous) * r) AS allowed FROM (
    SELECT run_no, metric, value,
      CASE WHEN run_no > 0 THEN lag(value) OVER (PARTITION BY metric ORDER BY run_no)
           ELSE CASE metric WHEN 'routes' THEN 120::DOUBLE WHEN 'below_peer' THEN 22 WHEN 'tier1' THEN 4 WHEN 'tier2' THEN 18 END END AS previous,
      CASE metric WHEN 'routes' THEN 2::DOUBLE WHEN 'quarantine_rows' THEN 10 ELSE 0 END AS a,
      CASE metric WHEN 'silver_rows' THEN 1::DOUBLE WHEN 'total_revenue' THEN 1 WHEN 'quarantine_rows' THEN 0.5::DOUBLE ELSE 0 END AS r
    FROM (SELECT * FROM figures0 UNION ALL SELECT * FROM figures1 UNION ALL SELECT * FROM figures2)))""", ctes=_RUNS)


# --- published files: header, order and number format ---
def _file(name: str, rows: str, columns: list[str], order: str) -> str:
    line = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"""SELECT '{name}' AS report, 0 AS position, '{",".join(c.split(".")[-1] for c in columns)}' AS line
  UNION ALL SELECT '{name}', CAST(row_number() OVER (ORDER BY {order}) AS INTEGER), {line} FROM ({rows})"""


def _whole(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), 0) AS BIGINT)"


_components = "[" + ", ".join(f"'{c}'" for c in COMPONENTS) + "]"
_published = [
    _file("waste_stream_margins", f"""SELECT primary_waste_stream, {RND('m', 2)} AS median_margin_pct, route_days, m FROM (
      SELECT primary_waste_stream, quantile_disc(gross_margin_pct, 0.5) AS m, count(*) AS route_days FROM days GROUP BY 1)""",
          ["primary_waste_stream", "median_margin_pct", "route_days"], "m, primary_waste_stream"),
    _file("cohort_margins", f"""SELECT cohort_key, {RND('m', 2)} AS cohort_median_margin, route_days, m FROM (
      SELECT cohort_key, quantile_disc(gross_margin_pct, 0.5) AS m, count(*) AS route_days FROM days GROUP BY 1)""",
          ["cohort_key", "cohort_median_margin", "route_days"], "m, cohort_key"),
    _file("cost_drivers", f"""SELECT cost_component, {RND('loss_day_share_pct', 1)} AS loss_day_share_pct,
      {RND('profit_day_share_pct', 1)} AS profit_day_share_pct, {_whole('loss_day_avg_gbp')} AS loss_day_avg_gbp,
      {_whole('profit_day_avg_gbp')} AS profit_day_avg_gbp FROM drivers""",
          ["cost_component", "loss_day_share_pct", "profit_day_share_pct", "loss_day_avg_gbp", "profit_day_avg_gbp"],
          f"list_position({_components}, cost_component)"),
    _file("margin_trend", f"SELECT period_type, period, {RND('margin_pct', 1)} AS margin_pct, {RND('loss_day_rate_pct', 1)} AS loss_day_rate_pct FROM trend",
          ["period_type", "period", "margin_pct", "loss_day_rate_pct"], "period_type DESC, period"),
]


sql("published_reports", " UNION ALL ".join(_published),
    ctes=(DATED, f"drivers AS ({_drivers})", f"trend AS ({_margin_trend})"))


# --- catalog: what is declared is what the files hold ---
def _declared() -> str:
    out = []
    for name, contract in CONTRACTS.items():
        for f in declared(name, contract).fields:
            part = f.name in PARTITIONS.get(name, [])
            kind = f.dataType.simpleString()
            out.append(f"('{name}', '{f.name}', '{kind}', '{'partition' if part else kind}', {not f.nullable}, {part}, 0::BIGINT, true)")
    return ", ".join(out)


ORACLE["catalog_contract"] = f"""SELECT * FROM (VALUES {_declared()}) AS t(table_name, column_name, declared_type, stored_type,
  required, is_partition, nulls, holds)"""
