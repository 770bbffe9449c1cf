"""Exact lower median per group without gathering a group in one task.

``percentile_disc`` keeps every distinct value of a group in one aggregation
buffer on one task. When one cohort or entity holds a third of all rows that
buffer is a third of the table. This module computes the same value -- the
element at 0-based rank ``(n - 1) div 2`` of the group's non-NULL values -- by
narrowing:

1. each group starts with the value range ``[lo, hi]`` that holds rank ``k``,
   and the number of values below it;
2. while a range holds more than ``max_ranked`` rows and more than one value, a
   mergeable sketch of bounded size proposes a narrower range and a counting
   pass tells exactly on which side of it rank ``k`` lies; both are map-side
   combined aggregates;
3. a range of one value is the answer, however many rows tie on it. The others
   are ranked with a window over at most ``max_ranked`` rows a group; the rows
   carry a number for their group, not its keys (groups that are small from the
   start: a hash of the keys that is known to tell all groups apart).

The sketch only decides *where* to look; the counts make the answer exact.
Range and counts travel in one frame that is written before it is used, so a
recomputed task cannot pair one sketch's range with another's counts.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginlens.functions.joins import free_shuffles, release, staged

DEFAULT_ACCURACY = 10_000
MAX_RANKED = 100_000  # rows of one group that a ranking task may get
GRID = 200            # quantiles a sketch is asked for


def _measures(values) -> list[tuple[str, Column]]:
    if isinstance(values, str):
        return [(values, F.col(values))]
    if isinstance(values, Mapping):
        return [(k, F.col(v) if isinstance(v, str) else v) for k, v in values.items()]
    return [(v, F.col(v)) for v in values]


def long_form(df: DataFrame, keys: Sequence[str], values) -> DataFrame:
    """``(keys..., _m, _v)`` rows: one per measure value, NULLs dropped."""
    ms = _measures(values)
    if len(ms) == 1:
        name, c = ms[0]
        out = df.select(*keys, F.lit(name).alias("_m"), c.cast("double").alias("_v"))
    else:
        pairs = F.array(*[F.struct(F.lit(n).alias("_m"), c.cast("double").alias("_v")) for n, c in ms])
        out = df.select(*keys, F.inline(pairs))
    return out.filter(F.col("_v").isNotNull())


def _with_state(long: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``long`` inside their group's range (keys compare NULL-safely)."""
    right = state.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return (long.join(right, same).drop(*[f"_r_{k}" for k in keys])
            .filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))))


def _narrowed(long: DataFrame, open_: DataFrame, g: Sequence[str], accuracy: int) -> DataFrame:
    """The next state of the open groups: a smaller range that still holds rank ``_k``."""
    grid = [i / GRID for i in range(GRID + 1)]
    rows = _with_state(long, open_, g)
    sketch = rows.groupBy(*g, "_k", "_lo", "_hi", "_below", "_inside").agg(
        F.percentile_approx("_v", F.array(*[F.lit(x) for x in grid]), accuracy).alias("_q"))
    # rank k as a share of the range: a pivot there, and one grid step on either side
    share = (F.col("_k") - F.col("_below")) / F.col("_inside") * GRID
    at = {"_a": F.greatest(F.floor(share) - 1, F.lit(0)), "_c": F.floor(share), "_b": F.least(F.ceil(share) + 1, F.lit(GRID))}
    cuts = staged(sketch.select(*g, "_k", "_lo", "_hi", "_below", "_inside",
                                *[F.get("_q", i.cast("int")).alias(n) for n, i in at.items()]), "median_cuts")
    v, a, c, b = (F.col(n) for n in ("_v", "_a", "_c", "_b"))
    counted = _with_state(long, cuts, g).groupBy(*g, "_k", "_lo", "_hi", "_below", "_inside", "_a", "_c", "_b").agg(
        F.count_if(v < a).alias("_n0"), F.count_if(v < c).alias("_n1"),
        F.count_if(v <= c).alias("_n2"), F.count_if(v <= b).alias("_n3"),
        F.max(F.when(v < a, v)).alias("_before_a"), F.max(F.when(v < c, v)).alias("_before_c"),
        F.min(F.when(v > c, v)).alias("_after_c"), F.min(F.when(v > b, v)).alias("_after_b"))
    n = [F.lit(0).cast("long"), *[F.col(f"_n{i}") for i in range(4)], F.col("_inside")]
    # five parts of the range; the pivot's own value is one, so every pass excludes something
    lows = [F.col("_lo"), a, c, F.col("_after_c"), F.col("_after_b")]
    highs = [F.col("_before_a"), F.col("_before_c"), c, b, F.col("_hi")]
    rank = F.col("_k") - F.col("_below")

    def part(values):
        out = F.lit(None)
        for i in reversed(range(5)):
            out = F.when(rank < n[i + 1], values[i]).otherwise(out)
        return out

    return counted.select(*g, "_k", part(lows).alias("_lo"), part(highs).alias("_hi"),
                          (F.col("_below") + part(n[:5])).alias("_below"),
                          part([n[i + 1] - n[i] for i in range(5)]).alias("_inside"))


def medians_of_long(long: DataFrame, keys: Sequence[str], accuracy: int = DEFAULT_ACCURACY,
                    max_ranked: int = MAX_RANKED) -> DataFrame:
    """Exact lower median of ``_v`` per ``keys + [_m]`` over a long frame
    ``(keys..., _m, _v)`` with NULL values already dropped. Keys may be NULL
    (they compare NULL-safely). Returns ``keys + [_m, _med]``."""
    g = list(keys) + ["_m"]
    state = staged(long.groupBy(*g).agg(
        F.count("_v").alias("_inside"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        .select(*g, F.expr("cast((_inside - 1) div 2 as long)").alias("_k"), "_lo", "_hi",
                F.lit(0).cast("long").alias("_below"), "_inside"), "median_state")
    free_shuffles(long.sparkSession)
    still = (F.col("_inside") > max_ranked) & (F.col("_lo") < F.col("_hi"))
    # few groups are large (rows / max_ranked at most): a table of their own, which the planner can broadcast
    large = staged(state.filter(F.col("_inside") > max_ranked), "median_large")
    whole, state = state.filter(F.col("_inside") <= max_ranked), large
    while state.filter(still).limit(1).count():
        state = staged(state.filter(~still).unionByName(_narrowed(long, staged(state.filter(still), "median_open"), g, accuracy)),
                       "median_state")

    single = whole.unionByName(state).filter(F.col("_lo") == F.col("_hi")).select(*g, F.col("_lo").alias("_med"))
    ranges = staged(state.filter(F.col("_lo") < F.col("_hi")).withColumn("_g", F.monotonically_increasing_id()), "median_ranges")
    rows = _with_state(long, ranges, g).select("_g", _plain("_v"), (F.col("_k") - F.col("_below")).cast("int").alias("_at"))
    rank = F.row_number().over(Window.partitionBy("_g").orderBy("_v"))
    ranked = rows.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_at") + 1).select("_g", F.col("_v").alias("_med"))
    narrowed = ranges.select("_g", *g).join(ranked, "_g").select(*g, "_med")
    return single.unionByName(narrowed).unionByName(_ranked_whole(long, whole, large, g))


def _plain(v: str) -> Column:
    return (F.col(v) + F.lit(0.0)).alias(v)  # -0.0 is 0.0


def _ranked_whole(long: DataFrame, whole: DataFrame, large: DataFrame, g: Sequence[str]) -> DataFrame:
    """``g..., _med`` of the groups in ``whole`` with several values, which are ranked as they are; no row
    of a ``large`` one is.

    A row's group number is the hash of its keys, so it is not joined with its
    group. Where two groups share a hash the numbers are joined instead.
    """
    number, several = F.xxhash64(*g), F.col("_lo") < F.col("_hi")
    groups = whole.select(*g).unionByName(large.select(*g)).groupBy(number.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    if groups.filter("_n > 1").limit(1).count():
        numbered = staged(whole.filter(several).withColumn("_g", F.monotonically_increasing_id()), "median_groups")
        rows = _with_state(long, numbered, g).select("_g", _plain("_v"))
    else:
        numbered = whole.filter(several).withColumn("_g", number)
        rows = (long.select(number.alias("_g"), _plain("_v"))
                .join(large.select(number.alias("_g")), "_g", "left_anti"))
    w = Window.partitionBy("_g").orderBy("_v")
    size = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = (rows.withColumns({"_rank": F.row_number().over(w), "_size": size})
              .filter("_rank = (_size - 1) div 2 + 1").select("_g", F.col("_v").alias("_med")))
    return numbered.select("_g", *g).join(ranked, "_g").select(*g, "_med")


def widen(meds: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``(keys, _m, _med)`` rows -> one column per measure name."""
    return meds.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_m") == F.lit(n), F.col("_med"))).alias(n) for n in names])


def group_medians(df: DataFrame, keys: Sequence[str], values, accuracy: int = DEFAULT_ACCURACY,
                  max_ranked: int = MAX_RANKED) -> DataFrame:
    """Exact lower median of each measure per group.

    ``values`` is a column name, a list of names, or ``{out_name: column}``.
    Returns ``keys + [one column per measure]`` for every group that has at
    least one non-NULL value (left-join it to a group list to keep empty
    groups, whose median is NULL).
    """
    keys = list(keys)
    names = [n for n, _ in _measures(values)]
    meds = medians_of_long(long_form(df, keys, values), keys, accuracy, max_ranked)
    if len(names) == 1:
        return meds.select(*keys, F.col("_med").alias(names[0]))
    return widen(meds, keys, names)


def nested_medians(df: DataFrame, outer: str, inner: str, outer_values, inner_values,
                   accuracy: int = DEFAULT_ACCURACY,
                   max_ranked: int = MAX_RANKED) -> tuple[DataFrame, DataFrame]:
    """Medians at two grouping levels (``outer`` and ``inner``, inner nested in
    outer) from one set of passes: both levels share one long frame, the inner
    key being NULL on the outer-level rows. Returns ``(outer_meds, inner_meds)``."""
    inner_type = dict(df.dtypes)[inner]
    keys = ["_lvl", outer, inner]
    # one scan: every day row emits its outer-level and inner-level values
    cells = ([F.struct(F.lit(0).alias("_lvl"), F.lit(None).cast(inner_type).alias("_in"),
                       F.lit(n).alias("_m"), c.cast("double").alias("_v")) for n, c in _measures(outer_values)]
             + [F.struct(F.lit(1).alias("_lvl"), F.col(inner).alias("_in"),
                         F.lit(n).alias("_m"), c.cast("double").alias("_v")) for n, c in _measures(inner_values)])
    long = (df.select(outer, F.inline(F.array(*cells)))
              .withColumnRenamed("_in", inner)
              .filter(F.col("_v").isNotNull()))
    # the narrow value frame is read by every pass: write it once
    long = staged(long, "median_values")
    meds = staged(medians_of_long(long, keys, accuracy, max_ranked), "medians")
    release(long)
    free_shuffles(df.sparkSession)
    outer_names = [n for n, _ in _measures(outer_values)]
    inner_names = [n for n, _ in _measures(inner_values)]
    return (widen(meds.filter(F.col("_lvl") == 0), [outer], outer_names),
            widen(meds.filter(F.col("_lvl") == 1), [outer, inner], inner_names))


def group_medians_direct(df: DataFrame, keys: Sequence[str], values) -> DataFrame:
    """Same result through ``percentile_disc``: one shuffle, but each group's
    distinct values sit in one task's buffer. Fine only when no group is hot."""
    ms = _measures(values)
    flat = df.select(*keys, *[c.cast("double").alias(n) for n, c in ms])
    return flat.groupBy(*keys).agg(
        *[F.expr(f"percentile_disc(0.5) within group (order by `{n}`)").alias(n) for n, _ in ms]
    )
