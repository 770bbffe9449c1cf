"""Plain-SQL twins of the registered queries, for an independent engine.

Every query shares one CTE chain that re-derives Bronze -> Silver -> Gold from
the driver tables with the same arithmetic (same operation order, so doubles
are bit-identical); each query then adds its own final ``SELECT``. Medians are
``quantile_disc(x, 0.5)``; money sums go through integer cents exactly as the
Spark side does.
"""
from __future__ import annotations

_BRONZE = """
bronze_base AS (
  SELECT l.*, s.s_suppkey, s.s_nationkey, s.s_acctbal, n.n_name, r.r_name, p.p_size, p.p_retailprice,
         l.l_extendedprice * (1.0::DOUBLE - l.l_discount) AS _rev,
         (10000.0::DOUBLE - s.s_acctbal) / 11000.0::DOUBLE AS _x,
         CAST(l.l_shipdate AS DATE) AS _d
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
bronze_money AS (
  SELECT *,
    l_quantity * p_retailprice * (0.1::DOUBLE + 3.5::DOUBLE * _x * _x) AS _disposal,
    l_quantity * p_size * 2 AS _fuel,
    l_quantity * 3.0::DOUBLE AS _labour,
    l_tax * 1000.0::DOUBLE AS _maint,
    l_quantity * 1.5::DOUBLE AS _admin
  FROM bronze_base
),
bronze_sums AS (
  SELECT *, _disposal + _fuel + _labour + _maint + _admin AS _sum5 FROM bronze_money
),
bronze AS (
  SELECT
    CASE WHEN l_orderkey % 1000 = 0 THEN NULL
         ELSE concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) END AS route_date_key,
    _d AS date,
    CAST(year(_d) AS INTEGER) AS year,
    CAST(month(_d) AS INTEGER) AS month,
    'Q' || CAST(quarter(_d) AS VARCHAR) AS quarter,
    dayname(_d) AS day_of_week,
    r_name AS region,
    n_name AS bu,
    n_name || '-' || CAST(s_suppkey % 2 AS VARCHAR) AS area,
    CAST(l_suppkey AS VARCHAR) AS route_id,
    CASE s_suppkey % 4 WHEN 0 THEN 'General Waste' WHEN 1 THEN 'Recycling'
                       WHEN 2 THEN 'Organics' WHEN 3 THEN 'Cardboard' END AS primary_waste_stream,
    CASE s_nationkey % 2 WHEN 0 THEN 'Office & Commercial' WHEN 1 THEN 'Retail' END AS primary_customer_segment,
    CAST(1 + l_linenumber % 2 AS INTEGER) AS num_drivers,
    CAST(1 AS INTEGER) AS num_trucks,
    CAST(trunc(l_quantity) AS INTEGER) AS total_stops,
    CAST(CASE WHEN l_linenumber = 7 THEN 0
              ELSE CAST(trunc(l_quantity) AS INTEGER) - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END END
         AS INTEGER) AS completed_stops,
    CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS missed_stops,
    l_quantity * 4.5::DOUBLE AS total_distance_km,
    l_quantity * 1.25::DOUBLE AS total_fuel_used_litres,
    4.0::DOUBLE + l_linenumber * 0.5::DOUBLE AS total_labour_hours,
    l_quantity * 2.0::DOUBLE AS total_yards,
    l_quantity * 0.75::DOUBLE AS total_tonnes,
    _rev / l_quantity AS avg_revenue_per_stop,
    _rev AS total_revenue,
    _disposal AS disposal_cost,
    CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE _fuel END AS fuel_cost,
    _labour AS labour_cost,
    _maint AS maintenance_cost,
    _admin AS admin_cost,
    CASE WHEN l_orderkey % 97 = 0 THEN _sum5 + 1.0::DOUBLE ELSE _sum5 END AS total_cost,
    _rev - _disposal AS net_revenue,
    _rev - _sum5 AS gross_profit,
    (_rev - _sum5) * 100 / _rev AS gross_margin_pct,
    8.0::DOUBLE AS scheduled_hours,
    8.0::DOUBLE + l_linenumber * 0.25::DOUBLE AS actual_hours,
    CAST(l_linenumber * 5 AS INTEGER) AS delay_minutes,
    CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INTEGER) AS on_time_flag,
    CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS incident_flag,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'returned load' END AS incident_type,
    CAST(l_shipdate AS TIMESTAMP) AS _ingested_at,
    'lineitem.parquet' AS _source_file,
    l_partkey AS _source_seq
  FROM bronze_sums
)"""

_SILVER = """
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY route_date_key
                               ORDER BY _ingested_at DESC NULLS LAST, _source_seq DESC NULLS LAST) AS _rn
  FROM bronze
),
clean AS (
  SELECT * EXCLUDE (_rn) FROM ranked WHERE route_date_key IS NOT NULL AND _rn = 1
),
quarantine AS (
  SELECT * EXCLUDE (_rn), 'null_pk' AS _reject_reason FROM ranked WHERE route_date_key IS NULL
  UNION ALL
  SELECT * EXCLUDE (_rn), 'duplicate_pk' AS _reject_reason FROM ranked WHERE route_date_key IS NOT NULL AND _rn > 1
),
recomputed AS (
  SELECT * EXCLUDE (total_cost, net_revenue, gross_profit, gross_margin_pct),
    total_cost AS total_cost_src, net_revenue AS net_revenue_src,
    gross_profit AS gross_profit_src, gross_margin_pct AS gross_margin_pct_src,
    disposal_cost + fuel_cost + labour_cost + maintenance_cost + admin_cost AS total_cost
  FROM clean
),
recomputed2 AS (
  SELECT *, total_revenue - disposal_cost AS net_revenue, total_revenue - total_cost AS gross_profit
  FROM recomputed
),
silver AS (
  SELECT *,
    gross_profit * 100 / NULLIF(total_revenue, 0) AS gross_margin_pct,
    (abs(total_cost - total_cost_src) > 0.02) OR (abs(net_revenue - net_revenue_src) > 0.02)
      OR (abs(gross_profit - gross_profit_src) > 0.02) AS recon_flag,
    gross_profit / NULLIF(completed_stops, 0) AS profit_per_stop,
    gross_profit / NULLIF(total_distance_km, 0) AS profit_per_km,
    total_cost / NULLIF(total_tonnes, 0) AS cost_per_tonne,
    completed_stops / NULLIF(total_stops, 0) AS completion_rate,
    (completed_stops IS NULL OR completed_stops = 0) OR (total_distance_km IS NULL OR total_distance_km = 0)
      OR (total_tonnes IS NULL OR total_tonnes = 0) OR (total_stops IS NULL OR total_stops = 0) AS metric_null_flag,
    concat_ws(' | ', primary_waste_stream, primary_customer_segment) AS cohort_key
  FROM recomputed2
)"""

_GOLD = """
dim_route AS (
  SELECT route_id, max(region) AS region, max(bu) AS bu, max(area) AS area,
         max(primary_waste_stream) AS primary_waste_stream,
         max(primary_customer_segment) AS primary_customer_segment, max(cohort_key) AS cohort_key
  FROM silver GROUP BY route_id
),
dim_date AS (
  SELECT DISTINCT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
         CAST(year(date) AS INTEGER) AS year, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter,
         CAST(month(date) AS INTEGER) AS month, dayname(date) AS day_of_week
  FROM silver
),
fact_day AS (
  SELECT route_date_key,
         CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, route_id,
         num_drivers, num_trucks, total_stops, completed_stops, missed_stops,
         total_distance_km, total_fuel_used_litres, total_labour_hours, total_yards, total_tonnes,
         avg_revenue_per_stop, total_revenue, disposal_cost, fuel_cost, labour_cost, maintenance_cost,
         admin_cost, total_cost, net_revenue, gross_profit, gross_margin_pct,
         scheduled_hours, actual_hours, delay_minutes,
         profit_per_stop, profit_per_km, cost_per_tonne, completion_rate,
         on_time_flag, incident_flag, incident_type, metric_null_flag, recon_flag
  FROM silver
),
days AS (
  SELECT f.*, d.region, d.bu, d.area, d.primary_waste_stream, d.primary_customer_segment, d.cohort_key
  FROM fact_day f JOIN dim_route d USING (route_id)
)"""

_SCORECARD = """
cohort_bench AS (
  SELECT cohort_key, quantile_disc(gross_margin_pct, 0.5) AS cohort_median_margin,
         quantile_disc(profit_per_stop, 0.5) AS cohort_median_profit_per_stop
  FROM days GROUP BY cohort_key
),
flagged AS (
  SELECT d.*, b.cohort_median_margin, b.cohort_median_profit_per_stop,
         CAST(d.gross_margin_pct < b.cohort_median_margin AS INTEGER) AS below_peer_day
  FROM days d JOIN cohort_bench b USING (cohort_key)
),
profile AS (
  SELECT route_id, cohort_key, count(*) AS n_days,
         quantile_disc(gross_margin_pct, 0.5) AS median_margin_pct,
         quantile_disc(profit_per_stop, 0.5) AS median_profit_per_stop,
         quantile_disc(gross_profit, 0.5) AS median_gross_profit,
         avg(CAST(gross_profit < 0 AS INTEGER)) AS loss_day_rate,
         avg(below_peer_day) AS pct_days_below_peer,
         max(cohort_median_margin) AS cohort_median_margin,
         max(cohort_median_profit_per_stop) AS cohort_median_profit_per_stop
  FROM flagged GROUP BY route_id, cohort_key
),
scorecard AS (
  SELECT route_id, cohort_key, n_days, median_margin_pct, median_profit_per_stop, median_gross_profit,
         loss_day_rate, pct_days_below_peer, cohort_median_margin, cohort_median_profit_per_stop,
         pct_days_below_peer > 0.7 AS below_peer_flag,
         CASE WHEN median_gross_profit < 0 OR loss_day_rate > 0.5 THEN 'Tier 1 - Loss-making'
              WHEN pct_days_below_peer > 0.7 THEN 'Tier 2 - Margin leak' ELSE 'OK' END AS tier,
         CAST(CASE WHEN median_gross_profit < 0 OR loss_day_rate > 0.5 THEN 1
                   WHEN pct_days_below_peer > 0.7 THEN 2 ELSE 0 END AS INTEGER) AS tier_code
  FROM profile
)"""


def with_chain(final_select: str, scorecard: bool = False, extra_ctes: tuple[str, ...] = ()) -> str:
    ctes = [_BRONZE, _SILVER, _GOLD] + ([_SCORECARD] if scorecard else []) + ["\n" + c for c in extra_ctes]
    return "WITH " + ",".join(ctes) + "\n" + final_select.strip()
