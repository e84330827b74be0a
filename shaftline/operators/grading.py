"""Days and machines against fixed thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor
from shaftline.functions.grading import grade


def vibration_zone(value: Column, cfg: Monitor = DEFAULT) -> Column:
    return grade(value, cfg.zones, cfg.zone_above, side="le")


def temperature_alert(value: Column, cfg: Monitor = DEFAULT) -> Column:
    return grade(value, cfg.alerts, cfg.alert_below, side="ge")


def flagged_days(daily: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """Daily averages with their vibration zone and temperature alert."""
    return daily.withColumns(
        {
            "VibrationZone": vibration_zone(F.col(cfg.vibration.name), cfg),
            "TemperatureAlert": temperature_alert(F.col(cfg.temperature.name), cfg),
        }
    )


def is_restricted(cfg: Monitor = DEFAULT) -> Column:
    return F.col("VibrationZone").isin(*cfg.restricted_zones)


def restricted_days(
    flagged: DataFrame, zones: Sequence[str] | None = None, cfg: Monitor = DEFAULT
) -> DataFrame:
    """Days in one of ``zones`` (the restricted ones by default), in order."""
    wanted = F.col("VibrationZone").isin(*(cfg.restricted_zones if zones is None else zones))
    return flagged.where(wanted).orderBy(cfg.key, cfg.date)


def anomaly_day_count(flagged: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """One row: how many days are in a restricted zone."""
    return flagged.agg(F.count_if(is_restricted(cfg)).alias("AnomalyDays"))


def danger_entities(
    flagged: DataFrame, zone: str | None = None, cfg: Monitor = DEFAULT
) -> DataFrame:
    """Keys with at least one day in ``zone`` (the danger zone by default)."""
    wanted = cfg.danger_zone if zone is None else zone
    return flagged.where(F.col("VibrationZone") == F.lit(wanted)).select(cfg.key).distinct()


def worst_per_entity(daily: DataFrame, n: int | None = None, cfg: Monitor = DEFAULT) -> DataFrame:
    """Highest level each key reached and its zone, worst first.

    With ``n`` it is a top-n report: each task keeps n rows and nothing is
    sorted globally. Ties go by key.
    """
    worst = (
        daily.groupBy(cfg.key)
        .agg(
            F.max(cfg.vibration.name).alias("MaxVibrationReached"),
            F.max(cfg.temperature.name).alias("MaxTemperatureReached"),
        )
        .withColumn("WorstZoneReached", vibration_zone(F.col("MaxVibrationReached"), cfg))
        .orderBy(F.desc("MaxVibrationReached"), cfg.key)
    )
    return worst if n is None else worst.limit(n)
