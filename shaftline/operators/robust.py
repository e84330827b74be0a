"""Baselines that a few wild readings can't move: medians, and deviations from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor
from shaftline.operators.baseline import _check_rule, _in_baseline, _with_start
from shaftline.operators.rollup import with_date
from shaftline.sources.scratch import scratch_path
from shaftline.sources.tables import read_table, write_table

# Precision of the states of a day: ranks are about 1.3 percent off, in a few kB.
SKETCH = 200
# The first bracket of a median, by a state's ranks. A median outside is found too, a round later.
LOWEST, HIGHEST = 0.47, 0.53
# Parts that a bracket is cut into each round.
BINS = 1_024
# What makes the median deviation of normal readings their standard deviation.
NORMAL = 1.4826


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    write_table(df, path, arrange=False)
    return read_table(df.sparkSession, path, df.schema)


def _values(df: DataFrame, key: str, value: str) -> DataFrame:
    """``k`` and ``v``: finite values of rows with a key."""
    k, v = F.col(f"`{key}`"), F.col(f"`{value}`").cast("double")
    return df.select(k.alias("k"), v.alias("v")).where(
        F.col("k").isNotNull() & (F.abs("v") < F.lit(float("inf")))
    )


def day_states(cleaned: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """``Readings`` and ``State`` of vibration per key and day.

    A state is a quantile sketch of a few kB; those of days, or of parts of one, merge into that of
    all their readings (``kll_merge_agg_double``). Null, NaN and infinite readings are left out, and
    readings without a key.
    """
    value = F.col(f"`{cfg.vibration.source}`").cast("double")
    dated = with_date(cleaned, cfg.time, cfg.date)
    return (
        dated.where(F.col(f"`{cfg.key}`").isNotNull() & (F.abs(value) < F.lit(float("inf"))))
        .groupBy(cfg.key, cfg.date)
        .agg(
            F.count(F.lit(1)).alias("Readings"),
            F.kll_sketch_agg_double(value, F.lit(SKETCH)).alias("State"),
        )
    )


def _bin() -> Column:
    """Part of the bracket that a value is in; 0 below and BINS + 2 above the bracket.

    Halves, so that no difference overflows.
    """
    width = F.col("hi") / 2 - F.col("lo") / 2
    share = F.try_divide(F.col("v") / 2 - F.col("lo") / 2, width)
    inside = F.floor(F.coalesce(share, (F.col("v") > F.col("lo")).cast("double")) * BINS) + 1
    return (
        F.when(F.col("v") < F.col("lo"), F.lit(0))
        .when(F.col("v") > F.col("hi"), F.lit(BINS + 2))
        .otherwise(inside)
        .cast("int")
    )


def exact_medians(values: DataFrame, states: DataFrame) -> DataFrame:
    """``k``, ``n`` and ``median`` (the mean of both middle values for an even number).

    ``values`` are rows of ``k`` and ``v``; ``states`` has for each ``k`` the number ``n`` of its values and
    the merged ``state``. The states bracket each median; one pass counts the values of each part of
    the bracket, combined before they are shuffled, and the part with the median is
    the next bracket. Only what lies in it is read again, so a key with a third of all values sends
    at most ``BINS`` + 2 rows per task, and none has all its values in one task. A state that is off
    costs another round, never the result. Brackets are one row a key and
    joined as Spark sees fit.
    """
    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double("state", F.lit(rank))

    below = F.lit(0).cast("bigint").alias("below")
    brackets = states.select("k", "n", below, at(LOWEST).alias("lo"), at(HIGHEST).alias("hi"))
    by_key = Window.partitionBy("k").orderBy("bin")
    low, high = F.expr("(n - 1) div 2"), F.expr("n div 2")
    settled = (F.col("parts") == 2) | (F.col("lo") == F.col("hi"))
    found = []
    while True:
        parts = (
            values.join(brackets, "k")
            .groupBy("k", "n", "below", _bin().alias("bin"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("first"), F.max("v").alias("last"))
            .withColumn("upto", F.col("below") + F.sum("c").over(by_key))
            .withColumn("before", F.col("upto") - F.col("c"))
        )
        # One part, or the two that the middle values are the last and the first of.
        outcome = _stored(
            parts.where((F.col("upto") > low) & (F.col("before") <= high))
            .groupBy("k", "n")
            .agg(
                F.count(F.lit(1)).alias("parts"),
                F.min("before").alias("below"),
                F.min("first").alias("lo"),
                F.max("last").alias("hi"),
                F.min("last").alias("left"),
                F.max("first").alias("right"),
            ),
            "brackets",
        )
        middle = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
            F.col("left") / 2 + F.col("right") / 2
        )
        found.append(outcome.where(settled).select("k", "n", middle.alias("median")))
        unsettled = outcome.where(~settled)
        if unsettled.isEmpty():
            return reduce(DataFrame.unionByName, found)
        brackets = unsettled.select("k", "n", "below", "lo", "hi")
        inside = values.join(brackets, "k").where("v BETWEEN lo AND hi")
        values = _stored(inside.select("k", "v"), "bracketed")


def _sketched(values: DataFrame) -> DataFrame:
    return values.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("state")
    )


def robust_baseline(
    cleaned: DataFrame,
    cutoff: object = None,
    first_days: int | None = None,
    states: DataFrame | None = None,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """``BaselineMedian``, ``BaselineMad`` and ``BaselineReadings`` of vibration per key, over the readings of its
    baseline days.

    Both are exact, whatever the order of tasks. ``states`` of earlier runs (see ``day_states``), also several
    of one day, spare the first pass. The days are those of ``baseline``; a key without finite readings in them has no row, and
    neither have readings without a key or a day. ``cleaned`` is read three times, so it should be a stored table.
    """
    _check_rule(cutoff, first_days)
    states = day_states(cleaned, cfg) if states is None else states
    days = _with_start(states, first_days, cfg).where(_in_baseline(cutoff, first_days, cfg))
    days = _stored(days.select(cfg.key, cfg.date, "Readings", "State"), "day-states")
    merged = days.groupBy(F.col(cfg.key).alias("k")).agg(
        F.sum("Readings").alias("n"), F.kll_merge_agg_double("State").alias("state")
    )
    within = with_date(cleaned, cfg.time, cfg.date).join(
        days.select(cfg.key, cfg.date).distinct(), [cfg.key, cfg.date]
    )
    values = _values(within, cfg.key, cfg.vibration.source)
    middle = _stored(exact_medians(values, merged), "medians")
    away = values.join(middle.select("k", "median"), "k").select(
        "k", F.abs(F.col("v") - F.col("median")).alias("v")
    )
    spread = exact_medians(away, _sketched(away)).select("k", F.col("median").alias("mad"))
    return middle.join(spread, "k").select(
        F.col("k").alias(cfg.key),
        F.col("median").alias("BaselineMedian"),
        F.col("mad").alias("BaselineMad"),
        F.col("n").alias("BaselineReadings"),
    )


def robust_score(daily: DataFrame, baselines: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """Every day with its key's robust baseline, and its distance from the median in deviations.

    ``RobustScore`` is null without a baseline and for a baseline that does not vary.
    """
    distance = F.col(cfg.vibration.name) - F.col("BaselineMedian")
    return daily.join(baselines, cfg.key, "left").withColumn(
        "RobustScore", F.try_divide(distance, F.col("BaselineMad") * NORMAL)
    )
