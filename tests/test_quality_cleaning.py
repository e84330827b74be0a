from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shaftline.config import MEASURES, READINGS, SENTINELS, Monitor
from shaftline.operators import cleaning, quality

NAN = float("nan")
T0 = datetime(2026, 1, 1)
T1 = datetime(2026, 1, 1, 0, 15)


def reading(machine=1, time=T0, vib=1.0, temp=50.0, amps=12.0, rpm=1460.0, status="Running"):
    return (machine, time, vib, temp, amps, rpm, status)


DIRTY = [
    reading(),
    reading(),  # exact copy
    reading(),  # and another
    reading(time=T1),
    reading(time=T1, vib=-999.0),  # differs only by the sentinel: no copy
    reading(machine=2, vib=None),
    reading(machine=2, temp=NAN),
    reading(machine=2, time=T1, amps=None, rpm=None),
    reading(machine=3, status=None),
    reading(machine=3, status="Idle"),  # differs in status: no copy
    reading(machine=4, temp=-999.0),  # a sentinel of vibration only
    reading(machine=5, vib=float("inf")),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(DIRTY, READINGS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], READINGS)


def by_steps(df, cfg=Monitor()):
    distinct = cleaning.dedup(df)
    return cleaning.drop_incomplete(
        cleaning.sentinel_to_null(distinct, cfg.sentinels), cfg.measures
    )


def test_row_count(dirty, empty):
    assert quality.row_count(dirty).first().Rows == 12
    assert quality.row_count(empty).first().Rows == 0


def test_null_counts_ignore_nan(dirty):
    assert quality.null_counts(dirty).first().asDict() == {
        "MachineID": 0,
        "Timestamp": 0,
        "VibrationVelocity": 1,
        "BearingTemperature": 0,
        "MotorCurrentDraw": 1,
        "RotationalSpeed": 1,
        "Status": 1,
    }


def test_schema_profile(dirty, empty):
    profile = {r.ColumnName: r for r in quality.schema_profile(dirty).collect()}
    assert [profile[c].Position for c in READINGS.names] == list(range(1, 8))
    assert profile["Timestamp"].DataType == "timestamp_ntz"
    assert all(p.Nullable for p in profile.values())
    assert quality.schema_profile(empty).count() == 7


def test_schema_profile_scans_nothing(spark, dirty, tmp_path):
    dirty.write.parquet(str(tmp_path / "t"))
    profile = quality.schema_profile(spark.read.parquet(str(tmp_path / "t")))
    assert "FileScan" not in profile._jdf.queryExecution().executedPlan().toString()


def test_table_profile_takes_types_from_the_files(spark, dirty, tmp_path):
    """And is one scan, with rows counted where the schema is shown."""
    dirty.selectExpr("CAST(MachineID AS BIGINT) AS id", "*").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    profile = quality.table_profile(stored)
    assert profile._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = {r.ColumnName: r for r in profile.collect()}
    counts = {r.ColumnName: r for r in quality.column_counts(dirty).collect()}
    assert found["id"].DataType == "bigint" and found["MachineID"].DataType == "int"
    for name, count in counts.items():
        assert (found[name].Rows, found[name].Nulls, found[name].NaNs) == tuple(count)[2:]


def test_column_counts(dirty, empty):
    counts = {r.ColumnName: r for r in quality.column_counts(dirty).collect()}
    assert counts["BearingTemperature"].NaNs == 1
    assert counts["BearingTemperature"].Nulls == 0
    assert counts["Status"].Nulls == 1
    assert {c.Rows for c in counts.values()} == {12}
    assert {r.Rows for r in quality.column_counts(empty).collect()} == {0}


def test_odd_column_names(spark, rows):
    data = [(1, None, -9.0), (1, None, -9.0), (2, 3.0, 4.0)]
    df = spark.createDataFrame(data, "`a.b` int, `c d` double, `e``f.g` double")
    sentinels = {"e`f.g": -9.0}
    assert quality.null_counts(df).first().asDict() == {"a.b": 0, "c d": 2, "e`f.g": 0}
    assert quality.duplicate_summary(df).first().DuplicateRows == 1
    assert quality.schema_profile(df).count() == 3
    assert quality.column_counts(df).count() == 3
    assert quality.sentinel_counts(df, sentinels).first()[0] == 2
    assert quality.quality_report(df, sentinels).first()["Sentinele`f.g"] == 2
    assert cleaning.sentinel_to_null(df, sentinels).where("`e``f.g` is null").count() == 2
    assert rows(cleaning.drop_incomplete(df, ["a.b", "c d"])) == [(2, 3.0, 4.0)]
    cfg = Monitor(measures=("a.b", "c d", "e`f.g"), sentinels=sentinels)
    assert rows(cleaning.clean(df, cfg)) == [(2, 3.0, 4.0)]
    assert cleaning.cleaning_report(df, cfg).first().FinalRows == 1


def test_duplicates_are_exact(dirty, empty):
    assert tuple(quality.duplicate_summary(dirty).first()) == (12, 10, 2)
    assert tuple(quality.duplicate_summary(empty).first()) == (0, 0, 0)
    assert cleaning.dedup(dirty).count() == 10


def test_sentinel_counts(dirty):
    assert quality.sentinel_counts(dirty, SENTINELS).first().VibrationVelocity == 1
    both = {"VibrationVelocity": -999.0, "BearingTemperature": -999.0}
    assert tuple(quality.sentinel_counts(dirty, both).first()) == (1, 1)


def test_quality_report_equals_separate_counts(dirty, empty):
    for df in (dirty, empty):
        report = quality.quality_report(df, SENTINELS).first().asDict()
        nulls = quality.null_counts(df).first().asDict()
        assert {c: report[f"Null{c}"] for c in nulls} == nulls
        summary = quality.duplicate_summary(df).first().asDict()
        assert {c: report[c] for c in summary} == summary
        sentinels = quality.sentinel_counts(df, SENTINELS).first().VibrationVelocity
        assert report["SentinelVibrationVelocity"] == sentinels


def test_preview(dirty):
    assert quality.preview(dirty, 3).count() == 3
    top = quality.preview(dirty, 2, [F.desc("MachineID")])
    assert [r.MachineID for r in top.collect()] == [5, 4]


def test_sentinel_to_null_keeps_everything_else(dirty, rows):
    blanked = cleaning.sentinel_to_null(dirty, SENTINELS)
    assert blanked.where("VibrationVelocity IS NULL").count() == 2
    assert blanked.where("BearingTemperature = -999").count() == 1
    assert blanked.columns == dirty.columns


def test_drop_incomplete_drops_nan(dirty):
    kept = cleaning.drop_incomplete(dirty, MEASURES)
    assert kept.count() == 9
    assert kept.where(F.isnan("BearingTemperature")).count() == 0


def test_clean_equals_its_steps(dirty, empty, rows):
    assert rows(cleaning.clean(dirty)) == rows(by_steps(dirty))
    assert cleaning.clean(dirty).count() == 6
    assert rows(cleaning.clean(empty)) == []


def test_clean_is_idempotent(dirty, rows):
    once = cleaning.clean(dirty)
    assert rows(cleaning.clean(once)) == rows(once)


def test_clean_blanks_sentinels_outside_the_measures(spark, rows):
    cfg = Monitor(measures=("a",), sentinels={"a": -1.0, "b": -9.0})
    df = spark.createDataFrame(
        [(1.0, -9.0), (1.0, -9.0), (1.0, None), (-1.0, 2.0), (2.0, 3.0)], "a double, b double"
    )
    # A sentinel and a null are different rows while copies are removed.
    expected = [(1.0, None), (1.0, None), (2.0, 3.0)]
    assert rows(cleaning.clean(df, cfg)) == expected == rows(by_steps(df, cfg))
    observation = Observation()
    assert rows(cleaning.clean_and_observe(df, observation, cfg)) == expected


def test_clean_takes_integer_measures(spark, rows):
    cfg = Monitor(measures=("a", "b"), sentinels={"a": -1})
    df = spark.createDataFrame([(1, 5), (-1, 5), (None, 5), (2, None)], "a int, b bigint")
    assert rows(cleaning.clean(df, cfg)) == [(1, 5)]


def test_cleaning_report(dirty, empty):
    report = cleaning.cleaning_report(dirty).first()
    assert tuple(report) == (12, 10, 6, 2, 4, 6, 50.0)
    report = cleaning.cleaning_report(empty).first()
    assert tuple(report) == (0, 0, 0, 0, 0, 0, None)


def test_observed_counts_equal_the_report(dirty, empty, rows, tmp_path):
    for i, df in enumerate((dirty, empty)):
        observation = Observation()
        cleaned = cleaning.clean_and_observe(df, observation)
        cleaned.write.parquet(str(tmp_path / str(i)))
        seen = observation.get
        report = cleaning.cleaning_report(df).first()
        assert seen.get("TotalRows", 0) == report.OriginalRows
        assert seen.get("DistinctRows", 0) == report.DedupedRows
        assert seen.get("FinalRows", 0) == report.FinalRows
        for name, count in quality.quality_report(df, SENTINELS).first().asDict().items():
            assert name == "DuplicateRows" or seen.get(name, 0) == count
        assert rows(cleaned) == rows(cleaning.clean(df))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unusable_rows_are_filtered_in_the_scan(spark, dirty, tmp_path):
    dirty.write.parquet(str(tmp_path / "r"))
    text = plan(cleaning.clean(spark.read.parquet(str(tmp_path / "r"))))
    assert text.index("Exchange") < text.index("Filter") < text.index("FileScan")
    assert text.count("Exchange") == 1
    assert "IsNotNull(VibrationVelocity)" in text


def test_observed_cleaning_counts_behind_the_shuffle(dirty):
    text = plan(cleaning.clean_and_observe(dirty, Observation()))
    assert text.count("Exchange") == 1
    assert text.index("CollectMetrics") < text.index("Exchange")


def test_hot_copies_and_a_hot_machine_stay_whole(spark):
    """A third of the rows are copies of one row, a third belong to one machine."""
    n = 30_000
    df = spark.range(3 * n, numPartitions=6).select(
        F.when(F.col("id") < 2 * n, 1).otherwise(F.col("id") % 500 + 2).cast("int").alias("MachineID"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00'").alias("Timestamp"),
        F.when(F.col("id") < n, 1.0).otherwise(F.col("id") / 1e6).alias("VibrationVelocity"),
        F.lit(50.0).alias("BearingTemperature"),
        F.lit(12.0).alias("MotorCurrentDraw"),
        F.lit(1460.0).alias("RotationalSpeed"),
        F.lit("Running").alias("Status"),
    )
    assert tuple(quality.duplicate_summary(df).first()) == (3 * n, 2 * n + 1, n - 1)
    report = cleaning.cleaning_report(df).first()
    assert (report.OriginalRows, report.FinalRows) == (3 * n, 2 * n + 1)
    assert math.isclose(report.PercentRemoved, round(100 * (n - 1) / (3 * n), 2))
    # Copies shrink to one row per task before the shuffle, and the others
    # spread over the partitions by whole row, not by machine.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = cleaning.dedup(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in parts]
    assert len(sizes) == 4
    assert max(sizes) < 1.2 * sum(sizes) / 4
