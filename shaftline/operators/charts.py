"""Data behind the charts, one row per mark; drawing is up to the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, ZONE_COLOURS, Monitor
from shaftline.operators.grading import vibration_zone


def trend_series(
    daily: DataFrame,
    value: str,
    highlight: Sequence[object],
    lines: Mapping[str, float] | None = None,
    cfg: Monitor = DEFAULT,
    ordered: bool = True,
) -> DataFrame:
    """``value`` per key over time, with the keys to highlight marked.

    ``lines`` adds the height of each horizontal reference line as a column.
    ``ordered=False`` leaves the rows where they are, for storing: a whole history
    needs no global sort to be read by key or day.
    """
    series = daily.select(
        cfg.key,
        cfg.date,
        value,
        F.col(cfg.key).isin(*highlight).alias("Highlighted"),
        *(F.lit(float(height)).alias(name) for name, height in (lines or {}).items()),
    )
    return series.orderBy(cfg.key, cfg.date) if ordered else series


def max_bars(
    daily: DataFrame,
    colours: Mapping[str, str] = ZONE_COLOURS,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """Highest vibration per key with its zone and bar colour, highest first."""
    colour = F.create_map(*(F.lit(x) for pair in colours.items() for x in pair))
    return (
        daily.groupBy(cfg.key)
        .agg(F.max(cfg.vibration.name).alias("MaxVibration"))
        .withColumn("Zone", vibration_zone(F.col("MaxVibration"), cfg))
        .withColumn("Colour", F.try_element_at(colour, F.col("Zone")))
        .orderBy(F.desc("MaxVibration"), cfg.key)
    )
