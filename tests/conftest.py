"""Shared fixtures: one local Spark session, synthetic route-day rows."""
from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marginlens.session import get_spark  # noqa: E402
from marginlens.sources.schemas import BRONZE_SCHEMA_NULLABLE, SOURCE_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("marginlens-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from marginlens.session import cleanup_scratch
    cleanup_scratch(s)
    s.stop()


COSTS = {"disposal_cost": 300.0, "fuel_cost": 150.0, "labour_cost": 420.0, "maintenance_cost": 90.0, "admin_cost": 60.0}


def route_day(**given) -> dict:
    """A consistent route-day: everything follows from day, stops, revenue and
    costs unless it is given. By default 80 stops, revenue 2400, costs 1020."""
    day = given.get("date", date(2021, 9, 7))
    stops, revenue = given.get("total_stops", 80), given.get("total_revenue", 2400.0)
    cost = sum(COSTS.values())
    row = dict.fromkeys(BRONZE_SCHEMA_NULLABLE.names)
    row |= {"route_date_key": "K-1", "route_id": "R-1", "region": "Coast", "bu": "Harbour", "area": "Hill",
            "primary_waste_stream": "Recycling", "primary_customer_segment": "Retail", "_source_file": "mem:/rows"}
    row |= {"date": day, "year": day.year, "month": day.month, "quarter": f"Q{(day.month + 2) // 3}",
            "day_of_week": day.strftime("%A"), "_ingested_at": datetime(2022, 2, 2, 6, 30), "_source_seq": 0}
    row |= {c: 2 for c in ("num_drivers", "num_trucks")}
    row |= {"total_stops": stops, "completed_stops": stops, "missed_stops": 0, "delay_minutes": 0, "on_time_flag": 1,
            "incident_flag": 0, "scheduled_hours": 9.0, "actual_hours": 9.0, "total_labour_hours": 18.0}
    row |= {c: stops * per for c, per in (("total_distance_km", 1.5), ("total_fuel_used_litres", 0.5),
                                          ("total_yards", 3.0), ("total_tonnes", 0.25))}
    row |= {"total_revenue": revenue, "avg_revenue_per_stop": revenue / max(stops, 1), **COSTS, "total_cost": cost,
            "net_revenue": revenue - COSTS["disposal_cost"], "gross_profit": revenue - cost,
            "gross_margin_pct": (revenue - cost) * 100 / revenue if revenue else None}
    assert not set(given) - set(row), set(given) - set(row)
    return row | given


def bronze_row(**given) -> tuple:
    return tuple(route_day(**given).values())


@pytest.fixture
def bronze(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), BRONZE_SCHEMA_NULLABLE)
    return make


@pytest.fixture
def tmp_table(tmp_path):
    counter = iter(range(10_000))
    return lambda name="t": str(tmp_path / f"{name}_{next(counter)}")


__all__ = ["bronze_row", "route_day", "SOURCE_COLUMNS"]
