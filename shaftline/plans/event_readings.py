"""Sensor readings derived from an ``events`` table.

The events carry no measures and no dirt, so both follow from the event id and
day by fixed formulas: three machines drift upwards, and nulls, sentinels and
exact copies are spread over all machines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shaftline.config import FAULTY_MACHINES, Monitor
from shaftline.sources.tables import read_table

# The columns the readings are derived from.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
    ]
)

# The derived readings start on 1 January 2024; so does their baseline week.
EVENT_MONITOR = Monitor(baseline_cutoff="2024-01-07")


def readings_from_events(events: DataFrame) -> DataFrame:
    """One reading per event, and a second, identical one for some of them.

    The copies come from exploding a literal array, so the events are read
    once.
    """
    faulty = f"event_id % 20 + 1 IN {FAULTY_MACHINES}"
    day = "datediff(ts, DATE '2024-01-01')"
    return events.selectExpr(
        "CAST(event_id % 20 + 1 AS INT) AS MachineID",
        "ts AS Timestamp",
        f"""CASE WHEN event_id % 199 = 13 THEN -999D
                 WHEN event_id % 211 = 5 THEN NULL
                 WHEN {faulty} THEN 0.8D + {day} * 0.15D + event_id % 31 / 200D
                 ELSE 0.5D + event_id * 7919 % 901 / 1000D END AS VibrationVelocity""",
        f"""CASE WHEN event_id % 223 = 7 THEN NULL
                 WHEN {faulty} THEN 45D + {day} * 1.7D + event_id % 41 / 20D
                 ELSE 40D + event_id * 104729 % 3001 / 100D END AS BearingTemperature""",
        """CASE WHEN event_id % 227 = 9 THEN NULL
                ELSE 10D + event_id * 31 % 501 / 100D END AS MotorCurrentDraw""",
        """CASE WHEN event_id % 229 = 11 THEN NULL
                ELSE 1452D + event_id * 17 % 161 / 10D END AS RotationalSpeed""",
        "event_type AS Status",
        "explode(IF(event_id % 101 = 42, array(0, 1), array(0))) AS copy",
    ).drop("copy")


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(read_table(spark, f"{folder}/events.parquet", EVENTS))
