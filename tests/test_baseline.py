from __future__ import annotations

import math
import statistics
from datetime import date, timedelta

import pytest

from shaftline.config import Monitor
from shaftline.operators import baseline as bl

DDL = "MachineID int, Date date, AvgVibration double, AvgTemperature double"
START = date(2026, 1, 1)
CUTOFF = "2026-01-07"


def days(machine, values, first=0):
    return [(machine, START + timedelta(first + i), float(v), 50.0) for i, v in enumerate(values)]


RAMP = [1.0, 1.2, 1.1, 1.4, 1.3, 1.5, 1.6, 9.0, 9.1, -9.0]
ROWS = (
    days(1, RAMP)
    + days(2, [1.0] * 9)  # constant baseline: deviation zero
    + days(3, [2.0, 3.0], first=6)  # one baseline day
    + days(4, [1.0, 5.0], first=10)  # no day before the cutoff
    + days(None, [1.0, 2.0, 4.0])  # readings that name no machine
)


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(ROWS, DDL)


def table(df):
    return {(r.MachineID, r.Date): r for r in df.collect()}


def test_baseline_takes_days_up_to_the_cutoff(daily):
    got = {r.MachineID: r for r in bl.baseline(daily, cutoff=CUTOFF).collect()}
    assert set(got) == {1, 2, 3, None}
    assert math.isclose(got[1].BaselineMean, statistics.mean(RAMP[:7]))
    assert math.isclose(got[1].BaselineStdDev, statistics.stdev(RAMP[:7]))
    assert got[2].BaselineStdDev == 0.0
    assert (got[3].BaselineMean, got[3].BaselineStdDev) == (2.0, None)


def test_baseline_of_each_keys_first_days(daily):
    got = {r.MachineID: r for r in bl.baseline(daily, first_days=7).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert math.isclose(got[1].BaselineMean, statistics.mean(RAMP[:7]))
    assert got[3].BaselineMean == 2.5
    assert got[4].BaselineMean == 3.0


def test_first_days_are_calendar_days(spark):
    gaps = [(1, START, 1.0, 0.0), (1, START + timedelta(6), 3.0, 0.0), (1, START + timedelta(7), 50.0, 0.0)]
    got = bl.baseline(spark.createDataFrame(gaps, DDL), first_days=7).first()
    assert got.BaselineMean == 2.0


@pytest.mark.parametrize("rule", [{"cutoff": CUTOFF}, {"first_days": 7}])
def test_window_form_equals_join_form(daily, rule):
    windowed = table(bl.baseline_zscore(daily, **rule))
    joined = table(bl.score_with(daily, bl.baseline(daily, **rule)))
    assert windowed.keys() == joined.keys() == {(m, d) for m, d, _, _ in ROWS}
    for key, row in windowed.items():
        for name in ("BaselineMean", "BaselineStdDev", "ZScore"):
            other = joined[key][name]
            assert (row[name] is None) == (other is None), (key, name)
            if other is not None:
                assert math.isclose(row[name], other, rel_tol=1e-9, abs_tol=1e-12), (key, name)


def test_both_forms_have_the_same_columns(daily):
    expected = ["MachineID", "Date", "AvgVibration", "AvgTemperature",
                "BaselineMean", "BaselineStdDev", "ZScore"]
    assert bl.baseline_zscore(daily, cutoff=CUTOFF).columns == expected
    assert bl.score_with(daily, bl.baseline(daily, first_days=7)).columns == expected


def test_scores(daily):
    scored = table(bl.baseline_zscore(daily, cutoff=CUTOFF))
    mean, deviation = statistics.mean(RAMP[:7]), statistics.stdev(RAMP[:7])
    for i, value in enumerate(RAMP):
        z = scored[1, START + timedelta(i)].ZScore
        assert math.isclose(z, (value - mean) / deviation, rel_tol=1e-9, abs_tol=1e-12)
    # Zero or undefined deviation, and no baseline at all: kept, without score.
    assert all(r.ZScore is None for (m, _), r in scored.items() if m != 1)
    assert {r.BaselineMean for (m, _), r in scored.items() if m in (4, None)} == {None}


def test_significance_is_strict_and_two_sided(spark):
    rows = [(i, START, z) for i, z in enumerate([3.0, -3.0, 3.0001, -3.0001, None, 0.0])]
    scored = spark.createDataFrame(rows, "MachineID int, Date date, ZScore double")
    assert [r.MachineID for r in bl.significant_days(scored).collect()] == [2, 3]
    assert bl.significant_day_count(scored).first().SignificantDays == 2
    assert {r.MachineID for r in bl.significant_entities(scored).collect()} == {2, 3}
    assert bl.significant_day_count(scored, z=2.9).first().SignificantDays == 4


def test_worst_score_is_signed(spark):
    rows = [(1, -9.0), (1, 2.0), (2, 3.0), (3, None), (4, 3.0)]
    scored = spark.createDataFrame(rows, "MachineID int, ZScore double")
    got = [tuple(r) for r in bl.worst_zscore(scored).collect()]
    assert got == [(2, 3.0), (4, 3.0), (1, 2.0), (3, None)]
    assert bl.worst_zscore(scored, n=1).first().MachineID == 2


@pytest.mark.parametrize(
    "rule", [{}, {"cutoff": CUTOFF, "first_days": 7}, {"first_days": 0}]
)
def test_bad_rules_are_refused(daily, rule):
    with pytest.raises(ValueError):
        bl.baseline(daily, **rule)
    with pytest.raises(ValueError):
        bl.baseline_zscore(daily, **rule)


def test_monitor_picks_the_rule():
    assert Monitor(baseline_cutoff=CUTOFF).baseline_rule == {"cutoff": CUTOFF}
    assert Monitor().baseline_rule == {"first_days": 7}


def test_scoring_shuffles_once(daily):
    for rule in ({"cutoff": CUTOFF}, {"first_days": 7}):
        text = bl.baseline_zscore(daily, **rule)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1


def test_cutoff_prunes_partitions(spark, daily, tmp_path):
    daily.write.partitionBy("Date").parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    text = bl.baseline(stored, cutoff=CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Date" in text


def test_a_large_fleet_is_joined_without_broadcast(spark, daily, rows):
    joined = bl.score_with(daily, bl.baseline(daily, cutoff=CUTOFF))
    expected = rows(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = bl.score_with(daily, bl.baseline(daily, cutoff=CUTOFF))
        assert "SortMergeJoin" in again._jdf.queryExecution().executedPlan().toString()
        assert rows(again) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
