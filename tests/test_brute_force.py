"""The whole flow against plain Python on random dirty readings."""

from __future__ import annotations

import math
import random
import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta
from fractions import Fraction

import pytest

from shaftline.config import READINGS, Monitor
from shaftline.operators import baseline as bl
from shaftline.operators import cleaning, grading, quality
from shaftline.plans import monitoring

START = datetime(2026, 1, 1)


def dirty_readings(seed: int, n: int = 1500) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        machine = rnd.choice([1, 1, 1, 2, 3, 4])  # half the rows are of machine 1
        time = START + timedelta(hours=rnd.randrange(24 * 12))
        drift = 0.3 * (time - START).days if machine == 3 else 0.0
        values = [
            rnd.choice([-999.0, None, *[round(rnd.uniform(0.5, 1.4) + drift, 3)] * 18]),
            rnd.choice([None, float("nan"), *[round(rnd.uniform(40, 70) + 10 * drift, 2)] * 18]),
            rnd.choice([None, *[round(rnd.uniform(10, 15), 2)] * 20]),
            rnd.choice([-999.0, *[round(rnd.uniform(1452, 1468), 1)] * 20]),
        ]
        rows.append((machine, time, *values, rnd.choice(["Running", "Idle", None])))
    hot = rows[7]
    return rows + [hot] * (n // 2) + rnd.sample(rows, n // 50)


def identity(row: tuple) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)


def half_up(values: list[float], decimals: int) -> float:
    units = [round(v * 10**decimals) for v in values]
    return math.floor(Fraction(sum(units), len(units)) + Fraction(1, 2)) / 10**decimals


def expected(rows: list[tuple], first_days: int | None):
    distinct = list({identity(r): r for r in rows}.values())
    kept = [
        r
        for r in distinct
        if r[2] != -999.0 and all(v is not None and not math.isnan(v) for v in r[2:6])
    ]
    groups = defaultdict(list)
    for r in kept:
        groups[r[0], r[1].date()].append(r)
    daily = {
        k: (half_up([r[2] for r in g], 3), half_up([r[3] for r in g], 2)) for k, g in groups.items()
    }
    scores = {}
    for (machine, day), (vibration, _) in daily.items():
        own = {d: v for (m, d), (v, _) in daily.items() if m == machine}
        last = date(2026, 1, 7) if first_days is None else min(own) + timedelta(first_days - 1)
        base = [v for d, v in own.items() if d <= last]
        sd = statistics.stdev(base) if len(base) > 1 else None
        scores[machine, day] = (vibration - statistics.mean(base)) / sd if base and sd else None
    return len(distinct), len(kept), daily, scores


@pytest.mark.parametrize("seed, first_days", [(1, None), (2, 3), (3, 1)])
def test_flow(spark, seed, first_days):
    rows = dirty_readings(seed)
    readings = spark.createDataFrame(rows, READINGS).repartition(5)
    cfg = Monitor() if first_days is None else Monitor(baseline_cutoff=None, baseline_days=first_days)
    distinct, kept, daily, scores = expected(rows, first_days)

    summary = quality.duplicate_summary(readings).first()
    assert (summary.TotalRows, summary.DistinctRows) == (len(rows), distinct)
    report = cleaning.cleaning_report(readings, cfg).first()
    assert (report.DedupedRows, report.FinalRows) == (distinct, kept)
    assert cleaning.clean(readings, cfg).count() == kept

    flagged = monitoring.flagged_from_readings(readings, cfg).collect()
    assert {(r.MachineID, r.Date): (r.AvgVibration, r.AvgTemperature) for r in flagged} == daily
    for r in flagged:
        zone = next((z for bound, z in cfg.zones if r.AvgVibration <= bound), "D")
        alert = next((a for bound, a in cfg.alerts if r.AvgTemperature >= bound), "Normal")
        assert (r.VibrationZone, r.TemperatureAlert) == (zone, alert)

    scored = monitoring.scored_from_readings(readings, cfg)
    found = {(r.MachineID, r.Date): r.ZScore for r in scored.collect()}
    assert found.keys() == scores.keys()
    for key, z in scores.items():
        assert (found[key] is None) == (z is None), key
        assert z is None or math.isclose(found[key], z, rel_tol=1e-9, abs_tol=1e-9), key
    significant = {k for k, z in scores.items() if z is not None and abs(z) > 3}
    assert {(r.MachineID, r.Date) for r in bl.significant_days(scored, cfg=cfg).collect()} == significant

    worst = grading.worst_per_entity(monitoring.daily_from_readings(readings, cfg), cfg=cfg).collect()
    assert {r.MachineID: r.MaxVibrationReached for r in worst} == {
        m: max(v for (k, _), (v, _) in daily.items() if k == m) for m, _ in daily
    }
