from __future__ import annotations

import math
from datetime import date, datetime
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shaftline.config import DailyMeasure
from shaftline.functions.averages import rounded_average
from shaftline.operators import rollup

NAN, INF = float("nan"), float("inf")


def average(spark, values, decimals=3, exact=True, parts=1):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    return df.repartition(parts).agg(rounded_average("x", decimals, exact).alias("a")).first().a


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1.0, 2.0], 1.5),
        ([1.0005], 1.001),  # ties go away from zero
        ([-1.0005], -1.001),
        ([0.001, 0.002], 0.002),
        ([-0.001, -0.002], -0.002),
        ([-0.0001], 0.0),
        ([0.1, 0.2, 0.3], 0.2),
        ([1.0, None], 1.0),
        ([], None),
        ([None], None),
        ([1.4004999999], 1.4),
        ([1.39949999999], 1.399),
        ([0.0004999999], 0.0),
        ([1e12, 1.0], 500000000000.5),
        ([INF, 1.0], INF),
        ([-INF, 1.0], -INF),
    ],
)
def test_rounded_average(spark, values, expected):
    assert average(spark, values) == expected


def test_readings_beyond_the_decimals_end_no_job(spark):
    assert average(spark, [1e300, 2.0]) == pytest.approx(5e299)
    assert average(spark, [1e20]) == 1e20
    assert average(spark, [1e20, -1e20, 3.0]) == 1.0
    assert average(spark, [1e308, 1e308, INF]) == INF
    assert math.isnan(average(spark, [1e300, NAN]))


def test_sums_beyond_the_decimals_end_no_job(spark):
    many = spark.range(300_000)
    for value, decimals in ((8e12, 0), (8.5e9, 3), (999_999_999_999.123456, 3)):
        values = many.select(F.lit(value).alias("x"))
        assert values.agg(rounded_average("x", decimals).alias("a")).first().a == pytest.approx(value)


def test_one_absurd_reading_leaves_other_groups_exact(spark):
    df = spark.createDataFrame([(1, 1e25), (1, 1.0), (2, 0.001), (2, 0.002)], "k int, x double")
    found = dict(df.groupBy("k").agg(rounded_average("x", 3).alias("a")).collect())
    assert found[2] == 0.002 and found[1] == pytest.approx(5e24)


def test_averages_of_fine_values_do_not_depend_on_tasks(spark):
    df = spark.range(4_000).select((F.lit(2e9) + F.rand(7)).alias("x")).toPandas()
    found = {
        spark.createDataFrame(df).repartition(n).agg(rounded_average("x", 6).alias("a")).first().a
        for n in (1, 3, 7, 13)
    }
    assert len(found) == 1


def test_generated_code_stays_compilable(spark):
    """The JVM leaves methods above 8,000 bytes to the interpreter."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        names = [f"m{i}" for i in range(4)]
        df = spark.range(9).select("id", *((F.col("id") / 7).alias(n) for n in names))
        daily = df.groupBy("id").agg(*(rounded_average(n, 3).alias(n) for n in names))
        parts = daily._jdf.queryExecution().debug().codegenToSeq()
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
        assert 0 < max(sizes) < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rounded_average_of_nan(spark):
    assert math.isnan(average(spark, [NAN, 1.0]))
    assert math.isnan(average(spark, [INF, -INF]))


def test_finer_readings_are_not_rounded_first(spark):
    values = [0.0004, 0.0004, 0.0008]  # rounding each to 3 decimals would give 0.001 / 3
    assert average(spark, values) == 0.001
    assert average(spark, values, exact=False) == 0.001


def test_many_readings_do_not_overflow(spark):
    # 2 ** 50 units each: a single long sum would overflow after 8192 rows.
    df = spark.range(100_000).select(F.lit(1125899906.5).alias("x"))
    assert df.agg(rounded_average("x", 3).alias("a")).first().a == 1125899906.5


def test_rounded_average_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert average(spark, [-0.001, -0.002, None]) == -0.002
        assert average(spark, [None]) is None
        assert average(spark, [1e300, 2.0]) == pytest.approx(5e299)
        assert math.isnan(average(spark, [NAN, 1.0]))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-200_000, 200_000), min_size=1, max_size=40), st.integers(1, 5))
def test_rounded_average_is_the_exact_one(spark, thousandths, parts):
    mean = Fraction(sum(thousandths), len(thousandths))
    digits = math.floor(abs(mean) + Fraction(1, 2))
    expected = (digits if mean >= 0 else -digits) / 1000
    assert average(spark, [t / 1000 for t in thousandths], parts=parts) == expected


READINGS = [
    (1, datetime(2026, 1, 1, 0, 0), 1.0, 40.0),
    (1, datetime(2026, 1, 1, 23, 45), 2.001, 41.01),
    (1, datetime(2026, 1, 2, 0, 0), 3.0, 42.0),
    (2, datetime(2026, 1, 1, 12, 0), 4.0, 43.0),
]
DDL = "MachineID int, Timestamp timestamp_ntz, VibrationVelocity double, BearingTemperature double"


def test_daily_average(spark, rows):
    daily = rollup.daily_average(spark.createDataFrame(READINGS, DDL))
    assert rows(daily) == [
        (1, date(2026, 1, 1), 1.501, 40.51),  # 1.5005 and 40.505 rounded half-up
        (1, date(2026, 1, 2), 3.0, 42.0),
        (2, date(2026, 1, 1), 4.0, 43.0),
    ]


def test_plain_daily_average_rounds_the_double(spark, rows):
    df = spark.createDataFrame(READINGS, DDL)
    plain = rollup.daily_average(df, exact=False)
    expected = df.selectExpr("MachineID", "to_date(Timestamp) AS Date", "VibrationVelocity AS v", "BearingTemperature AS t")
    expected = expected.groupBy("MachineID", "Date").agg(F.round(F.avg("v"), 3), F.round(F.avg("t"), 2))
    assert rows(plain) == rows(expected)


def test_daily_average_of_other_columns(spark, rows):
    df = spark.createDataFrame(READINGS, "k int, t timestamp_ntz, a double, b double")
    daily = rollup.daily_average(df, "k", "t", [DailyMeasure("a", "AvgA", 0)], "Day")
    assert daily.columns == ["k", "Day", "AvgA"]
    assert rows(daily)[0] == (1, date(2026, 1, 1), 2.0)


def test_zoned_timestamps_use_the_session_zone(spark, rows):
    df = spark.sql("SELECT 1 AS k, timestamp'2026-01-01 23:30:00 UTC' AS t")
    assert rollup.with_date(df, "t").first().Date == date(2026, 1, 1)


def test_series(spark):
    daily = rollup.daily_average(spark.createDataFrame(READINGS, DDL))
    days = rollup.series(daily, 1).collect()
    assert [(r.MachineID, r.Date.day) for r in days] == [(1, 1), (1, 2)]


def test_result_does_not_depend_on_partitioning(spark, rows):
    df = spark.range(20_000).selectExpr(
        "CAST(id % 7 AS int) AS MachineID",
        "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(id % 3) AS Timestamp",
        "(id * 7919 % 1801) / 1000D AS VibrationVelocity",
        "(id * 104729 % 9001) / 100D AS BearingTemperature",
    )
    results = [rows(rollup.daily_average(df.repartition(n))) for n in (1, 3, 16)]
    assert results[0] == results[1] == results[2]


def test_machine_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(READINGS, DDL).write.parquet(str(tmp_path / "r"))
    daily = rollup.daily_average(spark.read.parquet(str(tmp_path / "r")))
    text = rollup.series(daily, 1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(MachineID,1)" in text


def test_rollup_combines_before_its_only_shuffle(spark):
    daily = rollup.daily_average(spark.createDataFrame(READINGS, DDL))
    text = daily._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_sum")
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
