"""Gold dimensions: the entity dimension (with its stability check) and the
calendar dimension."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.functions.exprs import date_key, quarter_label, weekday_name
from marginlens.functions.joins import staged
from marginlens.sources.schemas import ROUTE_ATTRS

SHOWN = 20  # offenders named in an error; all are counted


def hierarchy_flags(df: DataFrame, entity: str = "route_id",
                    attrs: Sequence[str] = tuple(ROUTE_ATTRS)) -> DataFrame:
    """One row per entity: ``<attr>_varies`` is TRUE when the entity carries
    more than one non-NULL value of ``attr``; ``violates`` ORs them.

    ``min <> max`` gives the same verdict as ``count(distinct) > 1`` (NULLs
    ignored) with one hash aggregate and no Expand; map-side combine keeps a
    hot entity cheap.
    """
    aggs = []
    for a in attrs:
        aggs += [F.min(a).alias(f"_min_{a}"), F.max(a).alias(f"_max_{a}")]
    per = df.groupBy(entity).agg(*aggs)
    flags = [F.coalesce(F.col(f"_min_{a}") != F.col(f"_max_{a}"), F.lit(False)).alias(f"{a}_varies") for a in attrs]
    out = per.select(entity, *flags)
    viol = None
    for a in attrs:
        viol = F.col(f"{a}_varies") if viol is None else viol | F.col(f"{a}_varies")
    return out.withColumn("violates", viol)


def hierarchy_violations(df: DataFrame, entity: str = "route_id",
                         attrs: Sequence[str] = tuple(ROUTE_ATTRS)) -> DataFrame:
    return hierarchy_flags(df, entity, attrs).filter(F.col("violates"))


def assert_strict_hierarchy(df: DataFrame, entity: str = "route_id",
                            attrs: Sequence[str] = tuple(ROUTE_ATTRS)) -> int:
    """Raise if an entity ever changes an attribute (SCD-1 would be invalid).
    Returns the number of entities. One job: both numbers from one aggregate."""
    row = hierarchy_flags(df, entity, attrs).agg(
        F.count(F.lit(1)).alias("entities"), F.count_if("violates").alias("bad")).first()
    _raise_unstable(row["bad"], hierarchy_violations(df, entity, attrs), entity)
    return row["entities"]


def dim_entity(df: DataFrame, entity: str = "route_id",
               attrs: Sequence[str] = tuple(ROUTE_ATTRS)) -> DataFrame:
    """One row per entity. Deterministic survivor (max per attribute), which
    equals the only value once the hierarchy check has passed."""
    return df.groupBy(entity).agg(*[F.max(a).alias(a) for a in attrs])


def dim_route(silver: DataFrame) -> DataFrame:
    return dim_entity(silver, "route_id", ROUTE_ATTRS)


def dim_date(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Calendar rows for the dates seen, recomputed from the date itself."""
    d = F.col(date_col)
    return (df.select(d.alias("date")).distinct()
              .select(date_key("date").alias("date_key"), "date",
                      F.year("date").alias("year"), quarter_label("date").alias("quarter"),
                      F.month("date").alias("month"), weekday_name("date").alias("day_of_week")))


def level_violations(df: DataFrame, levels: Sequence[str] = ("area", "bu", "region")) -> DataFrame:
    """Level-to-level check of a geography (each level maps to one parent):
    ``(level, member, parent_level)`` for every member with more than one
    parent. One map-side-combined aggregate per adjacent pair of levels."""
    out = None
    for child, parent in zip(levels, levels[1:]):
        bad = (hierarchy_flags(df, child, [parent]).filter(F.col("violates"))
               .select(F.lit(child).alias("level"), F.col(child).cast("string").alias("member"),
                       F.lit(parent).alias("parent_level")))
        out = bad if out is None else out.unionByName(bad)
    return out


def checked_dim_entity(df: DataFrame, entity: str = "route_id",
                       attrs: Sequence[str] = tuple(ROUTE_ATTRS)) -> DataFrame:
    """The entity dimension and its stability check from ONE aggregate.

    Per-entity ``min``/``max`` of every attribute are computed once (map-side
    combined) and written; an entity whose min and max differ fails the check
    (raises), otherwise the dimension is the ``max`` columns. Saves the second
    pass over the fact-sized input that a separate check would need.
    """
    bounds = [f(a).alias(n) for a in attrs for f, n in ((F.min, f"_min_{a}"), (F.max, a))]
    per = staged(df.groupBy(entity).agg(*bounds), "entity_bounds")
    varies = reduce(or_, [F.coalesce(F.col(f"_min_{a}") != F.col(a), F.lit(False)) for a in attrs])
    unstable = per.filter(varies)
    _raise_unstable(unstable.count(), unstable, entity)
    return per.select(entity, *attrs)


def _raise_unstable(n: int, unstable: DataFrame, entity: str) -> None:
    if n:
        some = ", ".join(str(r[0]) for r in unstable.select(entity).limit(SHOWN).collect())
        raise AssertionError(f"attributes of {n} {entity} value(s) change over time; "
                             f"one row per {entity} cannot hold them. Some of them: {some}")
