"""The medallion layers the registered queries read.

``lakehouse`` stands for a scratch lakehouse, one per session and source, that
the pipeline's own layer functions fill: a layer is written, with those below
it, when a query first reads one of its tables, and re-read after that. So a
query pays for the layers it names and no more.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.functions.joins import free_shuffles
from marginlens.operators import facts, quality
from marginlens.operators.history import append_run
from marginlens.plans import pipeline
from marginlens.plans.load import load
from marginlens.session import scratch_path
from marginlens.sources.driver import SOURCE_TABLES, day_slices, route_day_bronze
from marginlens.sources.tables import delete, source_state, table_exists


@dataclass
class Layers:
    spark: SparkSession
    root: str
    #: The driver tables it is filled from, layer by layer; None: others fill it.
    source: str | None = None
    #: The tables that queries have asked for by name.
    named: set[str] = field(default_factory=set)

    def table(self, name: str) -> DataFrame:
        """A table as the pipeline wrote it."""
        self.need(name)
        return pipeline.read_layer(self.spark, self.root, name)

    def path(self, name: str) -> str:
        return pipeline.table_paths(self.root)[name]

    def need(self, *names: str) -> None:
        """Write the layers of the named tables that are not there yet.

        Bronze that was written for Silver only is deleted once Silver and the
        quarantine hold its rows; a later query that reads Bronze has it written again.
        """
        for name in names if self.source else ():
            self.named.add(name)
            self._write(name)

    def _write(self, name: str) -> None:
        if table_exists(self.spark, self.path(name)):
            return
        spark, root = self.spark, self.root
        # what a step writes: what it reads, and how
        steps = {
            ("bronze",): ((), lambda: pipeline.bronze_layer(spark, root, route_day_bronze(spark, self.source), day_slices(spark, self.source))),
            ("silver", "quarantine"): (("bronze",), lambda: pipeline.silver_layer(spark, root, gathered=True)),
            ("dim_route", "dim_date"): (("silver",), lambda: pipeline.dims_layer(spark, root)),
            ("fact_route_day",): (("silver",), lambda: pipeline.day_fact(spark, root)),
            ("fact_route_month",): (("fact_route_day", "dim_route"), lambda: pipeline.month_fact(spark, root)),
            ("route_scorecard",): (("fact_route_day", "fact_route_month", "dim_route"), lambda: pipeline.scorecard_layer(spark, root)),
        }
        writes = next(k for k in steps if name in k)
        reads, step = steps[writes]
        for table in reads:
            self._write(table)
        if not all(table_exists(spark, self.path(t)) for t in writes):
            step()
            free_shuffles(spark)
            if "silver" in writes and "bronze" not in self.named:
                delete(spark, self.path("bronze"))

    @property
    def bronze(self) -> DataFrame:
        return self.table("bronze")

    @property
    def silver(self) -> DataFrame:
        return self.table("silver")

    @property
    def quarantine(self) -> DataFrame:
        return self.table("quarantine")

    @property
    def dim_route(self) -> DataFrame:
        return self.table("dim_route")

    @property
    def dim_date(self) -> DataFrame:
        return self.table("dim_date")

    @property
    def fact_day(self) -> DataFrame:
        return self.table("fact_route_day")

    def fact_month(self) -> DataFrame:
        """The month rollup's plan over the written day fact."""
        return facts.fact_month(self.fact_day, self.dim_route)

    def days(self) -> DataFrame:
        """fact_day ⋈ dim_route: every day with its entity attributes."""
        return self.fact_day.join(self.dim_route, "route_id")

    def days_dated(self) -> DataFrame:
        """The full star: fact_day ⋈ dim_route ⋈ dim_date(year, quarter)."""
        return self.days().join(self.dim_date.select("date_key", "year", "quarter"), "date_key")

    def scorecard(self) -> DataFrame:
        """Per-route verdict; written on first use and re-read."""
        return self.table("route_scorecard")


_LAKEHOUSES: dict[tuple, Layers] = {}


def lakehouse(spark: SparkSession, sf_dir: str) -> Layers:
    """The lakehouse of this session and state of the source files; a layer is
    written when it is first read (again, if scratch was cleaned up)."""
    key = (spark.sparkContext.applicationId, sf_dir, source_state(spark, sf_dir, SOURCE_TABLES))
    if key not in _LAKEHOUSES:
        _LAKEHOUSES[key] = Layers(spark, scratch_path(spark, "lakehouse"), sf_dir)
    return _LAKEHOUSES[key]


#: The raw rows come in loads by date; the last load's keys reach back into earlier months.
LOADS = ((None, "1998-01-01"), ("1998-01-01", "2000-01-01"), ("2000-01-01", None))
_LOADED: dict[tuple, Layers] = {}


def load_rows(raw: DataFrame, since: str | None, before: str | None) -> DataFrame:
    out = raw if since is None else raw.filter(F.col("date") >= F.lit(since).cast("date"))
    return out if before is None else out.filter(F.col("date") < F.lit(before).cast("date"))


def loaded_lakehouse(spark: SparkSession, sf_dir: str) -> Layers:
    """The same rows brought in by incremental loads, once per session and source.

    After every load its quality figures join the run history.
    """
    key = (spark.sparkContext.applicationId, sf_dir, source_state(spark, sf_dir, SOURCE_TABLES))
    known = _LOADED.get(key)
    if known is None or not table_exists(spark, known.path("fact_route_month")):
        root = scratch_path(spark, "loaded")
        raw = route_day_bronze(spark, sf_dir)  # each load writes its own slice of Bronze
        known = Layers(spark, root)
        for n, (since, before) in enumerate(LOADS):
            load(spark, root, load_rows(raw, since, before), f"{n:04d}")
            append_run(spark, history_path(root), n, run_metrics(known))
            free_shuffles(spark)
        _LOADED[key] = known
    return known


def history_path(root: str) -> str:
    return f"{root.rstrip('/')}/gold/quality_history"


def run_metrics(layers: Layers) -> DataFrame:
    return quality.headline_metrics(layers.silver, layers.quarantine, layers.fact_day, layers.scorecard())


# registered queries read the written layers
build = lakehouse
