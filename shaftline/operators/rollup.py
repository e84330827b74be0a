"""From readings to one row per key and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, DailyMeasure, Monitor
from shaftline.functions.averages import rounded_average


def with_date(df: DataFrame, time: str, out: str = "Date") -> DataFrame:
    """Add the day of ``time``.

    A timestamp without zone has one day everywhere; one with zone is cut in
    the session time zone.
    """
    return df.withColumn(out, F.to_date(F.col(time)))


def daily_average(
    df: DataFrame,
    key: str = DEFAULT.key,
    time: str = DEFAULT.time,
    measures: Sequence[DailyMeasure] = DEFAULT.daily_measures,
    date: str = DEFAULT.date,
    exact: bool = True,
) -> DataFrame:
    """Average of each measure per key and day, rounded.

    Sums and counts combine map-side, so a key that owns most of the readings
    sends one row per task and day. ``exact`` averages do not depend on task
    order (see ``rounded_average``).
    """
    return (
        with_date(df, time, date)
        .groupBy(key, date)
        .agg(*(rounded_average(m.source, m.decimals, exact).alias(m.name) for m in measures))
    )


def series(daily: DataFrame, value: object, cfg: Monitor = DEFAULT) -> DataFrame:
    """The days of one key, in order.

    The filter is on a grouping key, so it passes the rollup down to the scan.
    """
    return daily.where(F.col(cfg.key) == F.lit(value)).orderBy(cfg.key, cfg.date)
