"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import inspect
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata")
# The text operators have tests of their own, as far as they are installed.
QUERIES = {k: q for k, q in contract.queries().items() if k not in contract.TEXT_QUERIES}
ORACLES = {k: q for k, q in contract.oracle_sql().items() if k not in contract.TEXT_ORACLES}
# Fitted by iteration; held against a plain fit in test_risk.py.
NO_SQL = {"risk_of_danger"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def tables(request):
    con = duckdb.connect()
    for file in sorted((DATA / request.param).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield str(DATA / request.param), con
    con.close()


def canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() - NO_SQL == ORACLES.keys()
    assert all(len(inspect.signature(query).parameters) == 2 for query in QUERIES.values())


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, tables, name):
    folder, con = tables
    df = QUERIES[name](spark, folder)
    result = con.execute(ORACLES[name])
    expected = canonical([c[0] for c in result.description], result.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.mark.parametrize("name", ["restricted_days", "significant_days", "machine_daily_series"])
def test_day_reports_are_in_order(spark, name):
    days = [(r.MachineID, r.Date) for r in QUERIES[name](spark, str(DATA / "sf0.01")).collect()]
    assert days == sorted(days)


@pytest.mark.parametrize(
    "name, value",
    [
        ("worst_per_machine", "MaxVibrationReached"),
        ("worst_zscore", "MaxZScore"),
        ("max_vibration_bars", "MaxVibration"),
    ],
)
def test_worst_reports_descend(spark, name, value):
    rows = [(-r[value], r.MachineID) for r in QUERIES[name](spark, str(DATA / "sf0.01")).collect()]
    assert rows == sorted(rows)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "MachineID",
        "Date",
        "AvgVibration",
        "AvgTemperature",
        "VibrationZone",
        "TemperatureAlert",
    ]
    assert df.count() == 596
