"""Days counted by machine, month and grade, at several levels at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor
from shaftline.operators.grading import is_restricted

MONTH = "Month"


def _average(total: Column, n: Column, decimals: int) -> Column:
    """``total / n`` of whole units, rounded half away from zero once."""
    away = F.call_function("div", F.abs(total) * 2 + n, n * 2)
    return F.signum(total).cast("bigint") * away / F.lit(float(10**decimals))


def fleet_report(
    flagged: DataFrame, levels: Sequence[Sequence[str]], cfg: Monitor = DEFAULT
) -> DataFrame:
    """Counts, extremes and the average of graded days for each set of columns in ``levels``.

    Columns of ``flagged`` and ``Month`` (the first day of it) can be grouped by; columns that a level does not
    group by are null there, and ``GroupingId`` tells such nulls from those of the data: a bit for
    each column in order of appearance, first one highest, set where it is not grouped by.
    The finest groups are aggregated once; all levels merge their states (counts, sums of whole units, extremes), so
    the days are neither read nor multiplied once per level. ``AvgVibration`` is the average of the daily averages,
    exact and rounded once, without null, NaN and infinite ones. No days give no rows, but for
    a level without columns, which has none either.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    if not columns:
        raise ValueError("at least one level needs a column")
    value, decimals = F.col(f"`{cfg.vibration.name}`"), cfg.vibration.decimals
    # Daily averages have so many decimals, so they are a whole number of units.
    units = F.rint(value * 10**decimals).try_cast("decimal(20,0)")
    finest = (
        flagged.withColumn(MONTH, F.trunc(cfg.date, "month"))
        .groupBy(*columns)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.count_if(is_restricted(cfg)).alias("restricted"),
            F.count_if(F.col("VibrationZone") == F.lit(cfg.danger_zone)).alias("danger"),
            F.count_if(F.col("TemperatureAlert") != F.lit(cfg.alert_below)).alias("alerts"),
            F.sum(units).alias("units"),
            F.count(units).alias("n"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
        )
    )
    sets = [[F.col(f"`{c}`") for c in level] for level in levels]
    return (
        finest.groupingSets(sets, *(F.col(f"`{c}`") for c in columns))
        .agg(
            F.grouping_id().cast("bigint").alias("GroupingId"),
            F.sum("days").alias("MachineDays"),
            F.sum("restricted").alias("RestrictedDays"),
            F.sum("danger").alias("DangerDays"),
            F.sum("alerts").alias("AlertDays"),
            F.sum("units").alias("units"),
            F.sum("n").alias("n"),
            F.min("least").alias("MinVibration"),
            F.max("most").alias("MaxVibration"),
        )
        .where(F.col("MachineDays").isNotNull())
        .withColumn("AvgVibration", _average(F.col("units"), F.nullif("n", F.lit(0)), decimals))
        .drop("units", "n")
    )
