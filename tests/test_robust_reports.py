"""Robust baselines, levels of a fleet report, reconciling and risk, against plain Python."""

from __future__ import annotations

import math
import random
import statistics
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shaftline.config import DailyMeasure, Monitor
from shaftline.operators import robust
from shaftline.operators.fleet import fleet_report
from shaftline.operators.reconcile import differences, reconcile, reconcile_counts
from shaftline.operators.risk import FEATURES, fit_risk, risk_features, risk_scores
from shaftline.operators.robust import day_states, robust_baseline, robust_score

CFG = Monitor(key="k", time="t", vibration=DailyMeasure("v", "v", 3), temperature=DailyMeasure("w", "w", 2))
START = datetime(2024, 1, 1)
SCHEMA = "k int, t timestamp_ntz, v double"


def some_readings(seed: int, n: int = 3_000) -> list[tuple]:
    """Key 1 has most rows, over many sizes; key 2 has copies only, key 3 two values, key 4 none that counts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = START + timedelta(minutes=rng.randrange(12 * 1_440))
        wild = rng.choice([1e300, -1e300, 1e-300, 5e-324, 0.0]) if rng.random() < 0.1 else rng.gauss(0, 10)
        rows.append((1, at, rng.choice([wild, wild, None, math.nan, math.inf])))
        rows.append((2, at, 7.25))
        rows.append((rng.choice([5, 6, None]), at, rng.randrange(40) / 8))
    rows += [(3, START, 1.0), (3, START, 4.0), (4, START, None), (4, START, math.nan), (6, None, 1e9)]
    return rows


def expected(rows: list[tuple], first_days: int) -> list[tuple]:
    out = []
    for key in {k for k, _, _ in rows} - {None}:
        own = [(t, v) for k, t, v in rows if k == key and t and v is not None and math.isfinite(v)]
        if own:
            first = min(t for t, _ in own).date()
            values = [v for t, v in own if (t.date() - first).days < first_days]
            middle = statistics.median(values)
            mad = statistics.median([abs(v - middle) for v in values])
            out.append((key, middle, mad, len(values)))
    return sorted(out)


@pytest.mark.parametrize("bins, reach", [(1_024, (0.47, 0.53)), (2, (0.47, 0.53)), (16, (0.9, 0.95))])
def test_robust_baseline(spark, monkeypatch, bins, reach):
    """Also with few parts, and with first brackets that the medians are not in."""
    monkeypatch.setattr(robust, "BINS", bins)
    monkeypatch.setattr(robust, "LOWEST", reach[0])
    monkeypatch.setattr(robust, "HIGHEST", reach[1])
    rows = some_readings(bins, 1_500)
    if bins == 2:  # a bracket of 1e300 is halved a thousand times
        rows = [r for r in rows if r[2] is None or not abs(r[2]) > 1e9]
    readings = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = robust_baseline(readings, first_days=6, cfg=CFG)
    assert sorted(map(tuple, got.collect())) == expected(rows, 6)


def test_states_of_parts_stand_in_for_those_of_the_whole(spark):
    rows = some_readings(4, 400)
    readings = spark.createDataFrame(rows, SCHEMA)
    halves = [day_states(readings.where(F.hour("t") % 2 == i), CFG) for i in (0, 1)]
    got = robust_baseline(readings, cutoff="2024-12-31", states=halves[0].unionByName(halves[1]), cfg=CFG)
    assert sorted(map(tuple, got.collect())) == expected(rows, 400)


def test_robust_scores_and_empty_tables(spark, rows):
    baselines = spark.createDataFrame([(1, 2.0, 0.5, 9), (2, 2.0, 0.0, 9)], "k int, BaselineMedian double, BaselineMad double, BaselineReadings bigint")
    daily = spark.createDataFrame([(1, START.date(), 3.4826), (2, START.date(), 9.0), (3, None, 1.0)], "k int, Date date, v double")
    scores = {r["k"]: r["RobustScore"] for r in robust_score(daily, baselines, CFG).collect()}
    assert scores == {1: pytest.approx(2.0), 2: None, 3: None}
    none = spark.createDataFrame([], SCHEMA)
    assert rows(robust_baseline(none, first_days=3, cfg=CFG)) == []
    with pytest.raises(ValueError):
        robust_baseline(none, cfg=CFG)


def some_days(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    days = []
    for i in range(400):
        at = None if rng.random() < 0.05 else date(2024, 1, 1) + timedelta(days=rng.randrange(90))
        v = rng.choice([None, math.nan, math.inf]) if rng.random() < 0.05 else rng.randrange(-3_000, 9_000) / 1_000
        days.append((rng.choice([1, 1, 2, 3, None]), at, v, rng.choice("ABCD"), rng.choice(["Normal", "Trip"])))
    return days


def test_fleet_report_equals_one_aggregate_a_level(spark):
    days = some_days(3)
    flagged = spark.createDataFrame(days, "k int, Date date, v double, VibrationZone string, TemperatureAlert string")
    levels = (("k", "Month"), ("VibrationZone",), ())
    names = ("k", "Month", "VibrationZone")
    want = {}
    for level in levels:
        number = sum(4 >> i for i, name in enumerate(names) if name not in level)
        for k, at, v, zone, alert in days:
            full = {"k": k, "Month": at and at.replace(day=1), "VibrationZone": zone}
            group = (number, *(full[n] if n in level else None for n in names))
            want.setdefault(group, []).append((v, zone, alert))
    got = {}
    for r in fleet_report(flagged, levels, CFG).collect():
        got[(r.GroupingId, r.k, r.Month, r.VibrationZone)] = r
    assert got.keys() == want.keys()
    for group, own in want.items():
        r = got[group]
        finite = [v for v, _, _ in own if v is not None and math.isfinite(v)]
        units = sum(round(v * 1_000) for v in finite)
        mean = units and math.copysign((2 * abs(units) + len(finite)) // (2 * len(finite)) / 1_000, units)
        assert r.MachineDays == len(own)
        assert r.RestrictedDays == sum(z in "CD" for _, z, _ in own)
        assert r.DangerDays == sum(z == "D" for _, z, _ in own)
        assert r.AlertDays == sum(a != "Normal" for _, _, a in own)
        assert r.AvgVibration == (mean if finite else None)
    with pytest.raises(ValueError):
        fleet_report(flagged, ((),), CFG)


def test_the_days_are_read_once_for_all_levels(spark):
    flagged = spark.createDataFrame(some_days(1), "k int, Date date, v double, VibrationZone string, TemperatureAlert string")
    plan = fleet_report(flagged, (("k",), ("Month",), ()), CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    # Levels are multiplied behind the first aggregate.
    assert plan.index("Expand") < plan.rindex("HashAggregate")


def test_reconcile_equals_counted_differences(spark):
    rng = random.Random(8)

    def table() -> list[tuple]:
        return [(rng.choice([1, 2, 3, None]), rng.choice(["a", None]), rng.choice([0.5, math.nan, None])) for _ in range(60)]

    before, after = table() + [(9, "gone", 1.0)], table() + [(8, "new", 1.0)] * 3
    frames = [spark.createDataFrame(t, "k int, s string, v double").repartition(3) for t in (before, after)]

    def plain(row):
        return tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in row)

    signed = Counter(map(plain, after))
    signed.subtract(map(plain, before))
    want = {row: n for row, n in signed.items() if n}
    changes = reconcile(*frames, ["k"]).collect()
    assert {plain(r[:3]): r.Copies for r in changes} == want
    sides = {}
    for row, n in want.items():
        sides.setdefault(row[0], set()).add(n > 0)
    names = {k: "changed" if len(own) == 2 else "added" if True in own else "removed" for k, own in sides.items()}
    assert all(r.Change == names[r.k] for r in changes)
    counts = {r.Change: (r.Rows, r.Keys) for r in reconcile_counts(reconcile(*frames, ["k"]), ["k"]).collect()}
    assert sum(n for n, _ in counts.values()) == sum(map(abs, want.values()))
    assert {name: n for name, (_, n) in counts.items()} == Counter(names.values())
    assert names[9] == "removed" and names[8] == "added" and "changed" in counts


def test_reconcile_of_equal_and_odd_tables(spark, rows):
    table = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "k int, s string")
    assert rows(reconcile(table, table.repartition(4), ["k"])) == []
    assert rows(reconcile(table.limit(0), table.limit(0), ["k"])) == []
    assert rows(differences(table, table.distinct())) == [(1, "a", -1)]
    with pytest.raises(ValueError, match="different"):
        differences(table, table.drop("s"))
    with pytest.raises(ValueError, match="Copies"):
        differences(table.withColumn("Copies", F.lit(1)), table.withColumn("Copies", F.lit(1)))


def some_series(spark, seed: int):
    rng = random.Random(seed)
    days = []
    for k in range(30):
        slope, v, w = rng.choice([0.0, 0.0, 0.12]), 2 + rng.random(), 45.0
        for i in range(40):
            v, w = v + slope + rng.gauss(0, 0.25), w + 4 * slope + rng.gauss(0, 1)
            if rng.random() < 0.9:
                days.append((k, date(2024, 1, 1) + timedelta(days=i), round(v, 3), round(w, 2)))
    days += [(None, date(2024, 1, 2), 1.0, 1.0), (1, None, 1.0, 1.0), (2, date(2024, 3, 1), None, 1.0)]
    return days, spark.createDataFrame(days, "k int, Date date, v double, w double").repartition(4)


def test_risk_features(spark):
    days, daily = some_series(spark, 1)
    own = sorted((k, d, v, w) for k, d, v, w in days if None not in (k, d, v))
    last = max(d for _, d, _, _ in own)
    got = {(r.k, r.Date): r for r in risk_features(daily, 3, cfg=CFG).collect()}
    assert len(got) == len(own)
    for i, (k, d, v, w) in enumerate(own):
        r = got[(k, d)]
        mine = [x for x in own if x[0] == k]
        earlier = [x for x in mine if x[1] < d]
        if earlier:
            days_since = (d - earlier[-1][1]).days
            assert r.LevelRate == pytest.approx((v - earlier[-1][2]) / days_since)
            assert r.TemperatureRate == pytest.approx((w - earlier[-1][3]) / days_since)
            assert r.LevelRise == pytest.approx((v - mine[0][2]) / (d - mine[0][1]).days)
        else:
            assert (r.LevelRate, r.TemperatureRate, r.LevelRise) == (0, 0, 0)
        soon = [x[2] for x in mine if 1 <= (x[1] - d).days <= 3]
        known = (last - d).days >= 3
        assert r.Danger == (int(max(soon, default=0) > 4.5) if known else None)


def test_the_fit_equals_a_plain_one_and_tells_held_out_days_apart(spark):
    _, daily = some_series(spark, 2)
    features = risk_features(daily, 3, cfg=CFG)
    model = fit_risk(features, penalty=0.5)
    known = [r for r in features.collect() if r.Danger is not None]
    x = np.array([[r[f] for f in FEATURES] for r in known])
    y = np.array([r.Danger for r in known])
    x = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0)])
    b = np.zeros(x.shape[1])
    ridge = np.diag([0.0] + [0.5] * len(FEATURES))
    for _ in range(60):  # plain gradient steps scaled by the whole curvature
        p = 1 / (1 + np.exp(-x @ b))
        b += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ b)
    assert model.rows == len(known)
    assert model.coefficients == pytest.approx(b, abs=1e-8)

    scored = risk_scores(daily, "2024-01-28", 3, cfg=CFG).collect()
    assert len(scored) == features.count()
    held = [r for r in scored if r.HeldOut and r.Danger is not None]
    assert {r.HeldOut for r in scored if r.Date < date(2024, 1, 25)} == {False}
    assert {r.HeldOut for r in scored if r.Date >= date(2024, 1, 25)} == {True}
    pairs = [(a.RiskScore > b.RiskScore) + 0.5 * (a.RiskScore == b.RiskScore)
             for a in held if a.Danger for b in held if not b.Danger]
    assert sum(pairs) / len(pairs) > 0.9


def test_risk_without_rows_or_with_one_outcome(spark):
    _, daily = some_series(spark, 3)
    none = risk_scores(daily.limit(0), "2024-01-28", cfg=CFG)
    assert none.count() == 0
    calm = risk_scores(daily.withColumn("v", F.lit(1.0)), "2024-01-28", cfg=CFG).collect()
    assert all(r.RiskScore < 0.01 for r in calm)
