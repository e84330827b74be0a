"""Each machine's days against its own baseline period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor

_START = "__baseline_start"


def _check_rule(cutoff: object, first_days: int | None) -> None:
    if (cutoff is None) == (first_days is None):
        raise ValueError("give either cutoff or first_days")
    if first_days is not None and first_days < 1:
        raise ValueError("first_days must be at least 1")


def _whole_key(cfg: Monitor) -> WindowSpec:
    """All days of a key, in order.

    A key has at most one row per day, so the calendar bounds what one task
    holds however many readings the key produced. The order makes the
    floating-point sums repeatable.
    """
    return (
        Window.partitionBy(cfg.key)
        .orderBy(cfg.date)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def _with_start(daily: DataFrame, first_days: int | None, cfg: Monitor) -> DataFrame:
    if first_days is None:
        return daily
    return daily.withColumn(_START, F.min(cfg.date).over(_whole_key(cfg)))


def _in_baseline(cutoff: object, first_days: int | None, cfg: Monitor) -> Column:
    day = F.col(cfg.date)
    if first_days is None:
        return day <= F.lit(cutoff).cast("date")
    return day < F.date_add(F.col(_START), first_days)


def baseline(
    daily: DataFrame,
    cutoff: object = None,
    first_days: int | None = None,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """Mean and sample deviation of vibration per key over its baseline days.

    ``cutoff`` takes every day up to that date, which reaches the scan as a
    filter; ``first_days`` takes that many calendar days from each key's own
    first one, and the average then reuses the shuffle of the window.
    """
    _check_rule(cutoff, first_days)
    value = cfg.vibration.name
    return (
        _with_start(daily, first_days, cfg)
        .where(_in_baseline(cutoff, first_days, cfg))
        .groupBy(cfg.key)
        .agg(
            F.avg(value).alias("BaselineMean"),
            F.stddev_samp(value).alias("BaselineStdDev"),
        )
    )


def _with_zscore(scored: DataFrame, cfg: Monitor) -> DataFrame:
    """A deviation of zero (constant baseline) scores null, not an error."""
    distance = F.col(cfg.vibration.name) - F.col("BaselineMean")
    return scored.withColumn("ZScore", F.try_divide(distance, F.col("BaselineStdDev")))


def baseline_zscore(
    daily: DataFrame,
    cutoff: object = None,
    first_days: int | None = None,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """Every day with its key's baseline and its distance from it in deviations.

    One window over the daily rows: they are read once and shuffled once by
    key, where joining an aggregate back would compute them twice. A key
    without baseline days keeps its rows with null scores.
    """
    _check_rule(cutoff, first_days)
    whole_key = _whole_key(cfg)
    started = _with_start(daily, first_days, cfg)
    counts = F.col(cfg.key).isNotNull() & _in_baseline(cutoff, first_days, cfg)
    value = F.when(counts, F.col(cfg.vibration.name))
    scored = started.withColumns(
        {
            "BaselineMean": F.avg(value).over(whole_key),
            "BaselineStdDev": F.stddev_samp(value).over(whole_key),
        }
    )
    return _with_zscore(scored.drop(_START), cfg)


def score_with(daily: DataFrame, baselines: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """``baseline_zscore`` against baselines computed or stored earlier.

    No broadcast is forced: there is one baseline per key, which grows with
    the fleet, so Spark picks the join from the size it measures. Both sides
    hold few rows per key, so a sort-merge join has no hot key either. Of the
    two forms only ``baseline_zscore`` sums in a fixed order; a score that lies
    on a limit to the last bit can differ between runs here.
    """
    return _with_zscore(daily.join(baselines, on=cfg.key, how="left"), cfg)


def baselines_of(scored: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """What each key of scored days is scored against, one row per key, with its first day.

    To be stored: ``score_with`` gives new days the same scores as scoring all of them again,
    and ``keys_to_score`` tells for which keys that does not hold.
    """
    return (
        scored.where(F.col(cfg.key).isNotNull())
        .groupBy(cfg.key)
        .agg(
            F.min(cfg.date).alias("FirstDay"),
            F.max("BaselineMean").alias("BaselineMean"),
            F.max("BaselineStdDev").alias("BaselineStdDev"),
        )
    )


def keys_to_score(
    before: DataFrame,
    after: DataFrame,
    baselines: DataFrame,
    cutoff: object = None,
    first_days: int | None = None,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """Keys whose stored baseline no longer holds when daily levels (key, day, level) of
    some days change from ``before`` to ``after``.

    These are the keys with a level within the baseline period that came, went or
    changed, and keys without a baseline yet. The levels are compared as signed counts,
    in one shuffle of the changed days; no other day is read.
    """
    _check_rule(cutoff, first_days)
    level = cfg.vibration.name
    signed = before.withColumn("__n", F.lit(-1)).unionByName(after.withColumn("__n", F.lit(1)))
    differing = signed.groupBy(cfg.key, cfg.date, level).agg(F.sum("__n").alias("__n"))
    earliest = (
        differing.where((F.col("__n") != 0) & F.col(cfg.key).isNotNull())
        .groupBy(cfg.key)
        .agg(F.min(cfg.date).alias(cfg.date))
    )
    known = earliest.join(baselines.withColumnRenamed("FirstDay", _START), cfg.key, "left")
    stale = _in_baseline(cutoff, first_days, cfg)
    if first_days is not None:
        stale = F.col(_START).isNull() | stale
    return known.where(stale).select(cfg.key)


def entities_without_baseline(scored: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """One row: how many keys have no baseline that a day can be scored against."""
    usable = F.max((F.col("BaselineStdDev") > 0).cast("int"))
    keys = scored.groupBy(cfg.key).agg(F.coalesce(usable, F.lit(0)).alias("usable"))
    return keys.agg(F.count_if(F.col("usable") == 0).alias("MachinesWithoutBaseline"))


def is_significant(z: float) -> Column:
    return F.abs("ZScore") > F.lit(z)


def significant_days(scored: DataFrame, z: float | None = None, cfg: Monitor = DEFAULT) -> DataFrame:
    """Days more than ``z`` deviations away, either side, in order."""
    wanted = is_significant(cfg.z_limit if z is None else z)
    return scored.where(wanted).orderBy(cfg.key, cfg.date)


def significant_day_count(
    scored: DataFrame, z: float | None = None, cfg: Monitor = DEFAULT
) -> DataFrame:
    """One row: how many days are significant."""
    wanted = is_significant(cfg.z_limit if z is None else z)
    return scored.agg(F.count_if(wanted).alias("SignificantDays"))


def significant_entities(
    scored: DataFrame, z: float | None = None, cfg: Monitor = DEFAULT
) -> DataFrame:
    """Keys with at least one significant day."""
    wanted = is_significant(cfg.z_limit if z is None else z)
    return scored.where(wanted).select(cfg.key).distinct()


def worst_zscore(scored: DataFrame, n: int | None = None, cfg: Monitor = DEFAULT) -> DataFrame:
    """Highest (signed) score per key, highest first; a top-n report with ``n``."""
    worst = (
        scored.groupBy(cfg.key)
        .agg(F.max("ZScore").alias("MaxZScore"))
        .orderBy(F.desc("MaxZScore"), cfg.key)
    )
    return worst if n is None else worst.limit(n)
