"""How likely a machine is to be dangerous soon: a logistic fit on rates of change."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor
from shaftline.sources.scratch import scratch_path
from shaftline.sources.tables import read_table, write_table

FEATURES = ("Level", "LevelRate", "TemperatureRate", "LevelRise")


@dataclass(frozen=True)
class RiskModel:
    """Coefficients of the standardised features, the intercept first."""

    coefficients: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    rows: int

    def logit(self) -> Column:
        total = F.lit(self.coefficients[0])
        for c, x in zip(self.coefficients[1:], self.standardised()):
            total = total + F.lit(c) * x
        return total

    def standardised(self) -> list[Column]:
        parts = zip(FEATURES, self.means, self.deviations)
        return [(F.col(name) - F.lit(m)) / F.lit(s) for name, m, s in parts]


def risk_features(
    daily: DataFrame, horizon: int = 3, bound: float | None = None, cfg: Monitor = DEFAULT
) -> DataFrame:
    """Every machine-day with its features and ``Danger``: whether the key is above ``bound`` (the last zone's) within the next ``horizon`` days.

    ``Level`` is the day's vibration, ``LevelRate`` and ``TemperatureRate`` the changes per day since the key's day
    before, and ``LevelRise`` that since its first day; a first day has zeros. ``Danger`` is null where
    the days seen of the fleet end before the horizon does. Days without key, date, vibration or temperature are left out. A key has
    one row per day, so the calendar bounds what a task holds of one.
    """
    v, t = F.col(cfg.vibration.name), F.col(cfg.temperature.name)
    day = F.unix_date(cfg.date)
    rows = daily.where(F.col(cfg.key).isNotNull() & F.col(cfg.date).isNotNull())
    rows = rows.where((F.abs(v) < float("inf")) & (F.abs(t) < float("inf"))).withColumn("__day", day)
    last = rows.agg(F.max("__day")).first()[0]
    by_key = Window.partitionBy(cfg.key).orderBy("__day")
    ahead = by_key.rangeBetween(1, horizon)
    since = F.col("__day") - F.lag("__day").over(by_key)
    start = F.col("__day") - F.first("__day").over(by_key)
    zero = F.lit(0.0)

    def rate(change: Column, days: Column) -> Column:
        return F.coalesce(F.try_divide(change, days), zero)

    bound = cfg.zones[-1][0] if bound is None else bound
    dangerous = F.coalesce(F.max((v > bound).cast("int")).over(ahead), F.lit(0))
    return rows.select(
        "*",
        v.alias("Level"),
        rate(v - F.lag(v).over(by_key), since).alias("LevelRate"),
        rate(t - F.lag(t).over(by_key), since).alias("TemperatureRate"),
        rate(v - F.first(v).over(by_key), start).alias("LevelRise"),
        F.when(F.col("__day") + horizon <= F.lit(last), dangerous).alias("Danger"),
    ).drop("__day")


def fit_risk(
    training: DataFrame, penalty: float = 1.0, tolerance: float = 1e-10, rounds: int = 50
) -> RiskModel:
    """Logistic regression of ``Danger`` on the features by Newton's method, over all rows that have it.

    Every round is one aggregate of sums, combined in the tasks: gradient and curvature, at most 20 numbers. ``penalty`` is
    that on the squared coefficients but the intercept's, which keeps them finite where the two
    outcomes can be told apart completely. Without rows every coefficient is 0.
    """
    known = training.where(F.col("Danger").isNotNull())
    stats = known.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(x).alias(f"m_{x}") for x in FEATURES),
        *(F.stddev_pop(x).alias(f"s_{x}") for x in FEATURES),
    ).first()
    means = tuple(stats[f"m_{x}"] or 0.0 for x in FEATURES)
    deviations = tuple(stats[f"s_{x}"] or 1.0 for x in FEATURES)
    size = len(FEATURES) + 1
    b = np.zeros(size)
    ridge = np.diag([0.0] + [penalty] * (size - 1))
    for _ in range(rounds if stats["n"] else 0):
        model = RiskModel(tuple(map(float, b)), means, deviations, stats["n"])
        xs = [F.lit(1.0), *(F.col(f"x{i}") for i in range(1, size))]
        prepared = known.select(
            (F.lit(1.0) / (F.lit(1.0) + F.exp(-model.logit()))).alias("p"),
            F.col("Danger").alias("y"),
            *(x.alias(f"x{i}") for i, x in enumerate(model.standardised(), 1)),
        )
        weight = F.col("p") * (F.lit(1.0) - F.col("p"))
        upper = [(i, j) for i in range(size) for j in range(i, size)]
        sums = prepared.agg(
            *(F.sum((F.col("y") - F.col("p")) * x).alias(f"g{i}") for i, x in enumerate(xs)),
            *(F.sum(weight * xs[i] * xs[j]).alias(f"h{i}_{j}") for i, j in upper),
        ).first()
        gradient = np.array([sums[f"g{i}"] for i in range(size)]) - ridge @ b
        curvature = ridge.copy()
        for i, j in upper:
            curvature[i, j] += sums[f"h{i}_{j}"]
            if i != j:
                curvature[j, i] += sums[f"h{i}_{j}"]
        step = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
        b += step
        if np.abs(step).max() < tolerance:
            break
    return RiskModel(tuple(map(float, b)), means, deviations, stats["n"])


def risk_scores(
    daily: DataFrame,
    split: object,
    horizon: int = 3,
    bound: float | None = None,
    penalty: float = 1.0,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """Every machine-day of ``risk_features`` with ``HeldOut`` and ``RiskScore``, the probability of danger within the
    next ``horizon`` days.

    The model is fitted on the days whose horizon ends before ``split``, so it has seen nothing of the held-out days,
    which are those from ``split`` on and the ``horizon`` days before.
    """
    features = risk_features(daily, horizon, bound, cfg)
    path = scratch_path(daily.sparkSession, "risk-features")
    write_table(features, path, arrange=False)
    features = read_table(daily.sparkSession, path, features.schema)
    held_out = F.date_add(cfg.date, horizon) >= F.lit(split).cast("date")
    model = fit_risk(features.where(~held_out), penalty)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.logit()))
    return features.select("*", held_out.alias("HeldOut"), score.alias("RiskScore"))
