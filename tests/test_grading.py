from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shaftline.config import ALERT_BELOW, ALERTS, ZONE_ABOVE, ZONES, Monitor
from shaftline.functions.grading import grade
from shaftline.operators import charts, grading

DDL = "MachineID int, Date date, AvgVibration double, AvgTemperature double"


def day(d: int) -> date:
    return date(2026, 1, d)


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(
        [
            (1, day(1), 1.4, 79.99),
            (1, day(2), 1.401, 80.0),
            (2, day(1), 2.8, 89.99),
            (2, day(2), 2.801, 90.0),
            (3, day(1), 4.5, 20.0),
            (3, day(2), 4.501, 95.0),
            (4, day(1), 0.0, -5.0),
            (5, day(1), 0.0, 10.0),
        ],
        DDL,
    )


def label(spark, value, steps, otherwise, side):
    df = spark.createDataFrame([(value,)], "x double")
    return df.select(grade(F.col("x"), steps, otherwise, side).alias("g")).first().g


@pytest.mark.parametrize(
    "value, zone",
    [(-1.0, "A"), (1.4, "A"), (1.401, "B"), (2.8, "B"), (2.801, "C"), (4.5, "C"), (4.501, "D"),
     (float("nan"), "D"), (None, "D")],
)
def test_zone_bounds_are_inclusive_above(spark, value, zone):
    assert label(spark, value, ZONES, ZONE_ABOVE, "le") == zone


@pytest.mark.parametrize(
    "value, alert",
    [(79.99, "Normal"), (80.0, "Alarm"), (89.99, "Alarm"), (90.0, "Trip"), (120.0, "Trip"),
     (float("nan"), "Trip"), (None, "Normal")],
)
def test_alert_bounds_are_inclusive_below(spark, value, alert):
    assert label(spark, value, ALERTS, ALERT_BELOW, "ge") == alert


@pytest.mark.parametrize(
    "steps, side", [(ZONES, "ge"), (ALERTS, "le"), (ZONES, "lt"), ((), "le")]
)
def test_bad_ladders_are_refused(spark, steps, side):
    with pytest.raises(ValueError):
        grade(F.lit(1.0), steps, "?", side)


def test_flagged_days(daily):
    flagged = grading.flagged_days(daily)
    got = [(r.VibrationZone, r.TemperatureAlert) for r in flagged.orderBy("MachineID", "Date").collect()]
    assert got == [
        ("A", "Normal"),
        ("B", "Alarm"),
        ("B", "Alarm"),
        ("C", "Trip"),
        ("C", "Normal"),
        ("D", "Trip"),
        ("A", "Normal"),
        ("A", "Normal"),
    ]


def test_restricted_days_and_counts(daily):
    flagged = grading.flagged_days(daily)
    days = [(r.MachineID, r.Date) for r in grading.restricted_days(flagged).collect()]
    assert days == [(2, day(2)), (3, day(1)), (3, day(2))]
    assert grading.anomaly_day_count(flagged).first().AnomalyDays == 3
    assert grading.restricted_days(flagged, zones=["B"]).count() == 2


def test_danger_entities_are_distinct(daily, rows):
    flagged = grading.flagged_days(daily.union(daily))
    assert rows(grading.danger_entities(flagged)) == [(3,)]
    assert rows(grading.danger_entities(flagged, zone="C")) == [(2,), (3,)]


def test_worst_per_entity_breaks_ties_by_key(daily):
    got = [tuple(r) for r in grading.worst_per_entity(daily).collect()]
    assert got == [
        (3, 4.501, 95.0, "D"),
        (2, 2.801, 90.0, "C"),
        (1, 1.401, 80.0, "B"),
        (4, 0.0, -5.0, "A"),
        (5, 0.0, 10.0, "A"),
    ]
    assert [r.MachineID for r in grading.worst_per_entity(daily, n=2).collect()] == [3, 2]


def test_worst_zone_is_the_zone_of_the_maximum(daily):
    worst = {r.MachineID: r.WorstZoneReached for r in grading.worst_per_entity(daily).collect()}
    highest = grading.flagged_days(daily).groupBy("MachineID").agg(F.max("VibrationZone").alias("z"))
    assert worst == {r.MachineID: r.z for r in highest.collect()}


def test_top_n_does_not_sort_globally(daily):
    text = grading.worst_per_entity(daily, n=2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_other_thresholds(daily):
    cfg = Monitor(zones=((4.0, "ok"),), zone_above="bad", restricted_zones=("bad",), danger_zone="bad")
    flagged = grading.flagged_days(daily, cfg)
    assert grading.anomaly_day_count(flagged, cfg).first().AnomalyDays == 2


def test_max_bars(daily):
    bars = [tuple(r) for r in charts.max_bars(daily).collect()]
    assert bars[:3] == [
        (3, 4.501, "D", "#e74c3c"),
        (2, 2.801, "C", "#e67e22"),
        (1, 1.401, "B", "#f1c40f"),
    ]
    uncoloured = charts.max_bars(daily, colours={"D": "red"}).collect()
    assert [r.Colour for r in uncoloured] == ["red", None, None, None, None]


def test_trend_series(daily):
    trend = charts.trend_series(daily, "AvgVibration", [3], {"Limit": 4})
    assert trend.columns == ["MachineID", "Date", "AvgVibration", "Highlighted", "Limit"]
    got = trend.collect()
    assert [(r.MachineID, r.Date) for r in got] == sorted((r.MachineID, r.Date) for r in got)
    assert {r.MachineID for r in got if r.Highlighted} == {3}
    assert {r.Limit for r in got} == {4.0}
