"""Readings that arrive file by file, late ones and a restart included."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from shaftline.config import DEFAULT, READINGS
from shaftline.plans.monitoring import daily_from_readings
from shaftline.streaming.rollup import Stream, advance, late_rows, streamed_daily

START = datetime(2024, 1, 1)


def reading(machine, hours, vibration=1.0, status="ok"):
    at = None if hours is None else START + timedelta(hours=hours)
    return (machine, at, vibration, 50.0, 10.0, 1460.0, status)


BATCHES = [
    [reading(1, 1, 1.0), reading(1, 2, 2.0), reading(2, 3, 0.5), reading(1, 1, 1.0), reading(1, 5, -999.0)],
    [reading(1, 30, 3.0), reading(1, 20, 4.0), reading(1, 2, 2.0), reading(1, None, 9.0), reading(2, 31, None)],
    [reading(1, 100, 1.0), reading(2, 40, 1.5), reading(2, 41, 2.5)],
    [reading(1, 4, 7.0), reading(2, 99, 2.0), reading(1, 100, 1.0)],
]


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(str(tmp_path / "stream"), delay="1 day", files_per_batch=1)


def put(spark, tmp_path, batch):
    frame = spark.createDataFrame(batch, READINGS).coalesce(1)
    frame.write.mode("append").parquet(str(tmp_path / "landing"))


def test_stream_equals_a_batch_of_rows_in_time(spark, tmp_path, stream, rows):
    for batch in BATCHES:
        put(spark, tmp_path, batch)
        advance(spark, str(tmp_path / "landing"), stream)
    late = [r for r in BATCHES[1] if r[1] is None] + [BATCHES[3][0]]
    assert rows(late_rows(spark, stream).drop("batch")) == sorted(late, key=repr)
    in_time = [r for batch in BATCHES for r in batch if r not in late]
    want = rows(daily_from_readings(spark.createDataFrame(in_time, READINGS), DEFAULT))
    assert rows(streamed_daily(spark, stream)) == want and len(want) == 6

    # A second start, without new files, adds nothing.
    advance(spark, str(tmp_path / "landing"), stream)
    assert rows(streamed_daily(spark, stream)) == want
    assert rows(late_rows(spark, stream).drop("batch")) == sorted(late, key=repr)


def test_a_batch_run_again_replaces_itself(spark, tmp_path, stream, rows):
    from shaftline.streaming.rollup import _divide, _ledger

    frame = spark.createDataFrame(BATCHES[0], READINGS)
    _divide(frame, 0, stream)
    _divide(spark.createDataFrame(BATCHES[2], READINGS), 1, stream)
    _divide(spark.createDataFrame(BATCHES[3], READINGS), 2, stream)
    before, told = rows(late_rows(spark, stream)), rows(_ledger(spark, stream))
    _divide(spark.createDataFrame(BATCHES[3], READINGS), 2, stream)
    _divide(frame, 0, stream)
    assert rows(late_rows(spark, stream)) == before and len(before) == 1
    assert rows(_ledger(spark, stream)) == told
    assert [r[2:] for r in told] == [(5, 0), (3, 0), (2, 1)]


def test_nothing_yet(spark, tmp_path, stream):
    put(spark, tmp_path, [])
    advance(spark, str(tmp_path / "landing"), stream)
    assert streamed_daily(spark, stream).collect() == []
    assert late_rows(spark, stream).collect() == []
    assert streamed_daily(spark, stream).columns == ["MachineID", "Date", "AvgVibration", "AvgTemperature"]


def test_other_time_zones_are_refused(spark, tmp_path, stream):
    put(spark, tmp_path, BATCHES[0])
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        with pytest.raises(ValueError, match="UTC"):
            advance(spark, str(tmp_path / "landing"), stream)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
