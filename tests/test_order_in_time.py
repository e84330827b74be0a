"""Operators that follow a machine through time, against plain Python on random rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shaftline.config import Monitor
from shaftline.operators.asof import asof_join
from shaftline.operators.drift import Drift, apply_map, drift, follow, slice_map
from shaftline.operators.intervals import filing_levels, interval_join
from shaftline.operators.ordering import seconds
from shaftline.operators.sessions import reporting_gaps, reporting_sessions

START = datetime(2024, 1, 1)
CFG = Monitor(key="k", time="t")


def minute(n: int) -> datetime:
    return START + timedelta(minutes=n)


def some_readings(seed: int, n: int = 240, span: int = 4_000) -> list[tuple]:
    """Key 1 owns most rows; times repeat; a few keys and times are null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choices([1, 2, 3, None], [30, 4, 2, 1])[0]
        at = None if rng.random() < 0.02 else minute(rng.randrange(span))
        rows.append((key, at, rng.choice([None, rng.randrange(-8, 9) / 4])))
    return rows + rows[:5]


@pytest.mark.parametrize("width", [86_400, 600])
@pytest.mark.parametrize("tolerance", [None, 3_600])
def test_asof_join(spark, rows, width, tolerance):
    rng = random.Random(width)
    left = some_readings(1)
    right = [(rng.choice([1, 1, 2, None]), minute(rng.randrange(0, 4_000, 40)), rng.choice("ab"), i % 3) for i in range(80)]
    right += [(1, None, "z", 9), (4, minute(5), "c", 0)]

    def state(key, at):
        if key is None or at is None:
            return (None, None, None)
        best = max(((t, s, n) for k, t, s, n in right if k == key and t is not None and t <= at), default=None)
        if best is None or tolerance is not None and (at - best[0]).total_seconds() > tolerance:
            return (None, None, None)
        return best

    got = asof_join(
        spark.createDataFrame(left, "k int, t timestamp_ntz, v double").repartition(3),
        spark.createDataFrame(right, "k int, since timestamp_ntz, state string, n int"),
        "k", "t", "since", tolerance, width,
    )
    assert got.columns == ["k", "t", "v", "since", "state", "n"]
    assert rows(got) == sorted(((*r, *state(*r[:2])) for r in left), key=repr)


def test_asof_join_refuses_clashing_names_and_takes_empty_tables(spark, rows):
    left = spark.createDataFrame([(1, START, 1.0)], "k int, t timestamp_ntz, v double")
    none = spark.createDataFrame([], "k int, since timestamp_ntz, state string")
    with pytest.raises(ValueError, match="both tables"):
        asof_join(left, left, "k", "t", "t")
    assert rows(asof_join(left, none, "k", "t", "since")) == [(1, START, 1.0, None, None)]
    assert rows(asof_join(left.limit(0), none, "k", "t", "since")) == []


def test_asof_join_spreads_a_hot_key(spark):
    """The windows over readings are by key and slice; only slices are gone through by key."""
    frame = spark.createDataFrame(some_readings(1), "k int, t timestamp_ntz, v double")
    states = spark.createDataFrame([(1, START, "a")], "k int, since timestamp_ntz, state string")
    plan = asof_join(frame, states, "k", "t", "since")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("__slice" in line.split("], [", 1)[1].split("]", 1)[0] for line in windows) == 1


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("on", [["k"], []])
def test_interval_join(spark, rows, closed, on):
    rng = random.Random(5)
    points = [(i, rng.choice([1, 1, 1, 2, None]), rng.choice([None, *map(minute, range(0, 900, 7))])) for i in range(150)]
    lengths = [0, 1, 7, 30, 400, 100_000, -5]
    spans = []
    for i in range(60):
        low = minute(rng.randrange(0, 900, 7) - rng.choice([0, 50_000]))
        spans.append((i, rng.choice([1, 2, None]), low, rng.choice([None, low + timedelta(minutes=rng.choice(lengths))])))
    points += points[:3]
    want = []
    for i, k, t in points:
        for j, own, a, b in spans:
            if t is None or b is None or on and (k is None or k != own):
                continue
            if a <= t < b or closed and t == b and a <= b:
                want.append((i, k, t, j, a, b) if on else (i, t, j, a, b))
    left = spark.createDataFrame(points, "id int, k int, t timestamp_ntz")
    right = spark.createDataFrame(spans, "span int, k int, a timestamp_ntz, b timestamp_ntz")
    if not on:
        left, right = left.drop("k"), right.drop("k")
    got = interval_join(left, right, on, "t", "a", "b", closed).select(*left.columns, "span", "a", "b")
    assert rows(got) == sorted(want, key=repr) and want


def test_interval_join_copies_long_intervals_no_more_than_short_ones(spark):
    spans = [(i, START, START + timedelta(minutes=10)) for i in range(50)]
    spans.append((99, START - timedelta(days=900), START + timedelta(days=900)))
    right = spark.createDataFrame(spans, "span int, a timestamp_ntz, b timestamp_ntz")
    left = spark.createDataFrame([(1, START)], "id int, t timestamp_ntz")
    joined = interval_join(left, right, [], "t", "a", "b")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and joined.count() == 51
    assert interval_join(left, right.limit(0), [], "t", "a", "b").count() == 0


def test_interval_join_copies_points_for_few_long_intervals_no_more(spark, rows):
    """A few intervals of other lengths go into several bins each, and each point is looked up once."""
    points = [(i, START + timedelta(minutes=i)) for i in range(1_000)]
    lengths = [4] * 30 + [9] * 10 + [700]
    spans = [(i, START + timedelta(minutes=23 * i), START + timedelta(minutes=23 * i + n)) for i, n in enumerate(lengths)]
    left = spark.createDataFrame(points, "id int, t timestamp_ntz")
    right = spark.createDataFrame(spans, "span int, a timestamp_ntz, b timestamp_ntz")
    joined = interval_join(left, right, [], "t", "a", "b")
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "explode(array(0))" in plan
    want = [(i, t, j, a, b) for i, t in points for j, a, b in spans if a <= t < b]
    assert rows(joined.select("id", "t", "span", "a", "b")) == sorted(want, key=repr)


def test_filing_levels_weighs_copies_of_points_against_those_of_intervals():
    found = {0: (80, 80.0 * 4), 1: (50, 50.0 * 8), 3: (2, 2.0 * 600)}
    assert filing_levels(found, 600, 5) == {0: 0, 1: 0, 3: 0}
    assert filing_levels(found, 100, 5) == {0: 0, 1: 1, 3: 1}
    assert filing_levels(found, 1, 5) == {0: 0, 1: 1, 3: 3}
    # However many points there are, an interval has a bounded number of copies.
    assert filing_levels({0: (1, 4.0), 4: (1, 20_000.0)}, 10**12, 5) == {0: 0, 4: 4}
    assert filing_levels({}, 10, 5) == {}


@pytest.mark.parametrize("width", [86_400, 300])
def test_gaps_and_sessions(spark, rows, width):
    readings = some_readings(8)
    frame = spark.createDataFrame(readings, "k int, t timestamp_ntz, v double").repartition(4)
    gaps, sessions = [], []
    for key in (1, 2, 3):
        times = sorted(t for k, t, _ in readings if k == key and t is not None)
        start = 0
        for i, t in enumerate(times):
            if i and t - times[i - 1] > timedelta(minutes=30):
                gaps.append((key, times[i - 1], t, (t - times[i - 1]).total_seconds()))
                sessions.append((key, times[start], times[i - 1], i - start))
                start = i
        sessions.append((key, times[start], times[-1], len(times) - start))
    assert rows(reporting_gaps(frame, "30 minutes", width, CFG)) == sorted(gaps, key=repr)
    assert rows(reporting_sessions(frame, 1_800, width, CFG)) == sorted(sessions, key=repr)
    assert rows(reporting_sessions(frame.limit(0), "1 hour", width, CFG)) == []


def test_durations():
    assert [seconds(d) for d in (5, "1 second", "90 minutes", "2 hours", "1 day", "3 weeks")] == [
        5, 1, 5_400, 7_200, 86_400, 1_814_400,
    ]


@pytest.mark.parametrize("width", [86_400, 900])
def test_drift_equals_the_recurrence(spark, width):
    readings = [(k, t, v if v is None or v > -2 else float("nan"), i % 37 == 5) for i, (k, t, v) in enumerate(some_readings(3))]
    frame = spark.createDataFrame(readings, "k int, t timestamp_ntz, v double, again boolean")
    settings = Drift(0.1, 0.25, 0.3)
    got = drift(frame.repartition(4), "v", settings, F.col("again"), width, CFG).collect()
    real = lambda v: v is not None and v == v
    want = []
    for key in (1, 2, 3):
        own = [(t, v, r) for k, t, v, r in readings if k == key and t is not None]
        own.sort(key=lambda row: (row[0], not real(row[1]), row[1] if real(row[1]) else 0, row[2]))
        states = follow([v if real(v) else None for _, v, _ in own], [r for *_, r in own], (None, 0.0, 0.0), settings)
        want += [(key, t, a, u, d) for (t, _, _), (a, u, d) in zip(own, states)]
    def ordered(found):
        return sorted(found, key=lambda r: (*r[:2], *((x is None, round(x or 0, 6)) for x in r[2:])))

    simple = ordered((r.k, r.t, r.Ewma, r.CusumUp, r.CusumDown) for r in got)
    for one, other in zip(simple, ordered(want), strict=True):
        assert one[:2] == other[:2] and list(one[2:]) == pytest.approx(list(other[2:]), abs=1e-9)
    assert drift(frame.limit(0), "v", settings, cfg=CFG).collect() == []


def test_slice_maps_compose():
    rng = random.Random(0)
    settings = Drift(0.0, 0.5, 0.2)
    for _ in range(200):
        values = [rng.choice([None, rng.uniform(-3, 3)]) for _ in range(rng.randrange(1, 6))]
        restarts = [rng.random() < 0.1 for _ in values]
        for state in ((None, 0.0, 0.0), (1.5, 2.0, 0.0), (-1.0, 0.0, 4.0)):
            *_, last = follow(values, restarts, state, settings)
            assert apply_map(state, slice_map(values, restarts, settings)) == pytest.approx(last)
