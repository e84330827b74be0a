"""Readings that come at irregular intervals: silences, and what lies between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor
from shaftline.operators.ordering import SLICE, microseconds, seconds, time_slice

_AT, _SLICE = "__at", "__slice"


def _timed(readings: DataFrame, width: int, cfg: Monitor) -> DataFrame:
    key, time = F.col(f"`{cfg.key}`"), F.col(f"`{cfg.time}`")
    return readings.where(key.isNotNull() & time.isNotNull()).select(
        key.alias(cfg.key), time.alias("t"), microseconds(time).alias(_AT), time_slice(time, width).alias(_SLICE)
    )


def reporting_gaps(
    readings: DataFrame, gap: str | int = "1 hour", width: int = SLICE, cfg: Monitor = DEFAULT
) -> DataFrame:
    """``GapStart``, ``GapEnd`` and ``Seconds`` of every time a key reported nothing for longer
    than ``gap``.

    Within slices of ``width`` seconds each reading is held against the one before it. Between slices only their
    first and last times count, one row per key and slice, so a silence of any
    length is found and no task gets all readings of a key. Readings without key or time are left out.
    """
    timed = _timed(readings, width, cfg)
    limit = seconds(gap) * 1_000_000
    inside = Window.partitionBy(cfg.key, _SLICE).orderBy(_AT)
    steps = timed.select(
        cfg.key, F.lag("t").over(inside).alias("GapStart"), F.col("t").alias("GapEnd")
    )
    ends = timed.groupBy(cfg.key, _SLICE).agg(F.min("t").alias("first"), F.max("t").alias("last"))
    across = Window.partitionBy(cfg.key).orderBy(_SLICE)
    joints = ends.select(
        cfg.key, F.lag("last").over(across).alias("GapStart"), F.col("first").alias("GapEnd")
    )
    silent = microseconds(F.col("GapEnd")) - microseconds(F.col("GapStart"))
    return (
        steps.unionByName(joints)
        .where(silent > limit)
        .withColumn("Seconds", silent / 1_000_000)
    )


def reporting_sessions(
    readings: DataFrame, gap: str | int = "1 hour", width: int = SLICE, cfg: Monitor = DEFAULT
) -> DataFrame:
    """``SessionStart``, ``SessionEnd`` and ``Readings`` of each run of readings of a key with no
    two neighbours further apart than ``gap``.

    Slices of ``width`` seconds find their own runs. Only the first and the last run of a slice can go on in
    another one; these, two per key and slice, are merged in a second pass, and all others
    are whole already. Readings without key or time are left out.
    """
    timed = _timed(readings, width, cfg)
    limit = seconds(gap) * 1_000_000
    inside = Window.partitionBy(cfg.key, _SLICE).orderBy(_AT)
    opens = F.coalesce((F.col(_AT) - F.lag(_AT).over(inside) > limit).cast("int"), F.lit(1))
    numbered = timed.withColumn("opens", opens).withColumn("run", F.sum("opens").over(inside))
    runs = numbered.groupBy(cfg.key, _SLICE, "run").agg(
        F.min("t").alias("SessionStart"), F.max("t").alias("SessionEnd"), F.count(F.lit(1)).alias("Readings")
    )
    runs = runs.withColumn("runs", F.max("run").over(Window.partitionBy(cfg.key, _SLICE)))
    edge = (F.col("run") == 1) | (F.col("run") == F.col("runs"))
    columns = (cfg.key, "SessionStart", "SessionEnd", "Readings")

    across = Window.partitionBy(cfg.key).orderBy("SessionStart")
    silent = microseconds(F.col("SessionStart")) - microseconds(F.lag("SessionEnd").over(across))
    edges = runs.where(edge).withColumn("opens", F.coalesce((silent > limit).cast("int"), F.lit(1)))
    edges = edges.withColumn("session", F.sum("opens").over(across))
    merged = edges.groupBy(cfg.key, "session").agg(
        F.min("SessionStart").alias("SessionStart"),
        F.max("SessionEnd").alias("SessionEnd"),
        F.sum("Readings").alias("Readings"),
    )
    return runs.where(~edge).select(*columns).unionByName(merged.select(*columns))
