"""SQL for the same results, written against the raw tables."""

from __future__ import annotations

import re

_COLUMNS = (
    "MachineID",
    "Timestamp",
    "VibrationVelocity",
    "BearingTemperature",
    "MotorCurrentDraw",
    "RotationalSpeed",
    "Status",
)
_MEASURES = _COLUMNS[2:6]
_LINEITEM = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

READINGS = """
e AS (
  SELECT *,
         CAST(event_id % 20 + 1 AS INTEGER) AS m,
         event_id % 20 + 1 IN (3, 11, 17) AS faulty,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS dd
  FROM events
),
r1 AS (
  SELECT event_id AS id,
         m AS MachineID,
         ts AS "Timestamp",
         CASE WHEN event_id % 199 = 13 THEN CAST(-999 AS DOUBLE)
              WHEN event_id % 211 = 5 THEN NULL
              WHEN faulty THEN CAST(0.8 AS DOUBLE) + dd * CAST(0.15 AS DOUBLE)
                               + CAST(event_id % 31 AS DOUBLE) / CAST(200 AS DOUBLE)
              ELSE CAST(0.5 AS DOUBLE)
                   + CAST(event_id * 7919 % 901 AS DOUBLE) / CAST(1000 AS DOUBLE)
         END AS VibrationVelocity,
         CASE WHEN event_id % 223 = 7 THEN NULL
              WHEN faulty THEN CAST(45 AS DOUBLE) + dd * CAST(1.7 AS DOUBLE)
                               + CAST(event_id % 41 AS DOUBLE) / CAST(20 AS DOUBLE)
              ELSE CAST(40 AS DOUBLE)
                   + CAST(event_id * 104729 % 3001 AS DOUBLE) / CAST(100 AS DOUBLE)
         END AS BearingTemperature,
         CASE WHEN event_id % 227 = 9 THEN NULL
              ELSE CAST(10 AS DOUBLE) + CAST(event_id * 31 % 501 AS DOUBLE) / CAST(100 AS DOUBLE)
         END AS MotorCurrentDraw,
         CASE WHEN event_id % 229 = 11 THEN NULL
              ELSE CAST(1452 AS DOUBLE) + CAST(event_id * 17 % 161 AS DOUBLE) / CAST(10 AS DOUBLE)
         END AS RotationalSpeed,
         event_type AS Status
  FROM e
),
r AS (
  SELECT * EXCLUDE (id) FROM r1
  UNION ALL
  SELECT * EXCLUDE (id) FROM r1 WHERE id % 101 = 42
)"""

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _MEASURES)

CLEAN = (
    READINGS
    + f""",
blanked AS (
  SELECT * REPLACE (nullif(VibrationVelocity, -999) AS VibrationVelocity)
  FROM (SELECT DISTINCT * FROM r)
),
c AS (SELECT * FROM blanked WHERE {_COMPLETE})"""
)


def _half_up(column: str, decimals: int) -> str:
    """The average of the decimals the readings are written as, rounded half-up
    once, in integers."""
    text = f"CAST(sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38, 18))) AS VARCHAR)"
    total = f"CAST(replace({text}, '.', '') AS HUGEINT)"
    step = f"(count({column}) * CAST({10 ** (18 - decimals)} AS HUGEINT))"
    return f"CAST((2 * {total} + {step}) // (2 * {step}) AS DOUBLE) / {10**decimals}"


DAILY = (
    CLEAN
    + f""",
d AS (
  SELECT MachineID,
         CAST("Timestamp" AS DATE) AS "Date",
         {_half_up("VibrationVelocity", 3)} AS AvgVibration,
         {_half_up("BearingTemperature", 2)} AS AvgTemperature
  FROM c
  GROUP BY 1, 2
)"""
)


def _zone(column: str, bounds: tuple[float, float, float] = (1.4, 2.8, 4.5)) -> str:
    a, b, c = bounds
    return (
        f"CASE WHEN {column} <= {a} THEN 'A' WHEN {column} <= {b} THEN 'B' "
        f"WHEN {column} <= {c} THEN 'C' ELSE 'D' END"
    )


FLAGGED = (
    DAILY
    + f""",
f AS (
  SELECT *,
         {_zone("AvgVibration")} AS VibrationZone,
         CASE WHEN AvgTemperature >= 90 THEN 'Trip'
              WHEN AvgTemperature >= 80 THEN 'Alarm'
              ELSE 'Normal' END AS TemperatureAlert
  FROM d
)"""
)

_BASELINE = """
b AS (
  SELECT MachineID,
         avg(AvgVibration) AS BaselineMean,
         stddev_samp(AvgVibration) AS BaselineStdDev
  FROM {source}
  GROUP BY MachineID
)"""
_SCORED = """
s AS (
  SELECT d.*, BaselineMean, BaselineStdDev,
         (AvgVibration - BaselineMean) / nullif(BaselineStdDev, 0) AS ZScore
  FROM d LEFT JOIN b USING (MachineID)
)"""
_FIRST_WEEK = """(
    SELECT d.* FROM d
    JOIN (SELECT MachineID, min("Date") AS start FROM d GROUP BY MachineID) USING (MachineID)
    WHERE date_diff('day', start, "Date") < 7
  )"""
_WEEK = "(SELECT * FROM d WHERE \"Date\" <= DATE '2024-01-07')"

BASELINE = DAILY + "," + _BASELINE.format(source=_WEEK)
BASELINE_FIRST = DAILY + "," + _BASELINE.format(source=_FIRST_WEEK)
SCORED = BASELINE + "," + _SCORED
SCORED_FIRST = BASELINE_FIRST + "," + _SCORED

# Adding zero turns a score rounded to -0.0 into 0.0.
_ROUNDED_B = """MachineID, round(BaselineMean, 6) AS BaselineMean,
       round(BaselineStdDev, 6) AS BaselineStdDev"""
_ROUNDED_S = """MachineID, "Date", AvgVibration, AvgTemperature,
       round(BaselineMean, 6) AS BaselineMean, round(BaselineStdDev, 6) AS BaselineStdDev,
       round(ZScore, 6) + 0.0 AS ZScore"""

SHIPMENTS = f"""
d AS (
  SELECT l_suppkey,
         CAST(l_shipdate AS DATE) AS "Date",
         {_half_up("l_quantity", 2)} AS AvgQuantity,
         {_half_up("l_extendedprice", 2)} AS AvgPrice
  FROM lineitem
  GROUP BY 1, 2
)"""
SHIPMENTS_SCORED = (
    SHIPMENTS
    + """,
b AS (
  SELECT l_suppkey, avg(AvgQuantity) AS m, stddev_samp(AvgQuantity) AS sd
  FROM d JOIN (SELECT l_suppkey, min("Date") AS start FROM d GROUP BY 1) USING (l_suppkey)
  WHERE date_diff('day', start, "Date") < 365
  GROUP BY 1
)"""
)


_FINE = f"""
d AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS "Date",
         {_half_up("round(l_extendedprice * (1 - l_discount) / 7, 9)", 2)} AS AvgNet
  FROM lineitem
  GROUP BY 1, 2
)"""

USERS = f"""
d AS (
  SELECT user_id, CAST(ts AS DATE) AS "Date",
         {_half_up("value", 3)} AS AvgValue, {_half_up("value", 2)} AS AvgValue2
  FROM events
  GROUP BY 1, 2
)"""
USERS_SCORED = (
    USERS
    + """,
b AS (
  SELECT user_id, avg(AvgValue) AS m, stddev_samp(AvgValue) AS sd
  FROM d JOIN (SELECT user_id, min("Date") AS start FROM d GROUP BY 1) USING (user_id)
  WHERE date_diff('day', start, "Date") < 7
  GROUP BY 1
)"""
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _nulls(columns: tuple[str, ...], prefix: str = "") -> str:
    return ", ".join(f'count(*) - count("{c}") AS "{prefix}{c}"' for c in columns)


_TYPES = ("int", "timestamp_ntz", "double", "double", "double", "double", "string")

_LABELLED_TYPES = {
    "doc_id": "bigint",
    "text": "string",
    "lang": "string",
    "source": "string",
    "n_chars": "bigint",
    "quality": "int",
    "toxic": "int",
}
_LINEITEM_TYPES = dict(
    zip(
        _LINEITEM,
        ("bigint",) * 3 + ("int",) + ("double",) * 4 + ("string", "string", "timestamp_ntz"),
    )
)


def _profile(columns: dict[str, str], table: str) -> str:
    """Types as stored, beside the counts of each column."""
    rows = [
        f"SELECT {i} AS Position, '{c}' AS ColumnName, '{t}' AS DataType, true AS Nullable, "
        f'count(*) AS Rows, count(*) - count("{c}") AS Nulls, '
        + (f'count(*) FILTER (isnan("{c}"))' if t == "double" else "CAST(0 AS BIGINT)")
        + f" AS NaNs FROM {table}"
        for i, (c, t) in enumerate(columns.items(), start=1)
    ]
    return "\nUNION ALL ".join(rows)


def _column_counts() -> str:
    rows = [
        f"SELECT {i} AS Position, '{c}' AS ColumnName, "
        f'count(*) AS Rows, count(*) - count("{c}") AS Nulls, '
        + (f'count(*) FILTER (isnan("{c}"))' if t == "double" else "CAST(0 AS BIGINT)")
        + " AS NaNs FROM r"
        for i, (c, t) in enumerate(zip(_COLUMNS, _TYPES), start=1)
    ]
    return "\nUNION ALL ".join(rows)


_DUPLICATES = """SELECT *, TotalRows - DistinctRows AS DuplicateRows
FROM (SELECT (SELECT count(*) FROM {table}) AS TotalRows,
             (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS DistinctRows)"""

_STEPS = """SELECT (SELECT count(*) FROM r) AS o,
              (SELECT count(*) FROM (SELECT DISTINCT * FROM r)) AS u,
              (SELECT count(*) FROM c) AS k"""

_STORED = SCORED + "," + FLAGGED.removeprefix(DAILY + ",")
_HEADLINES = """(SELECT count(*) FROM d) AS MachineDays,
       (SELECT count(*) FROM f WHERE VibrationZone IN ('C', 'D')) AS AnomalyDays,
       (SELECT count(*) FROM s WHERE abs(ZScore) > 3) AS SignificantDays,
       (SELECT count(*) FROM (SELECT MachineID FROM s GROUP BY MachineID
                              HAVING count(*) FILTER (BaselineStdDev > 0) = 0))
         AS MachinesWithoutBaseline"""

_WORST_MACHINES = f"""SELECT *, {_zone("MaxVibrationReached")} AS WorstZoneReached
FROM (SELECT MachineID, max(AvgVibration) AS MaxVibrationReached,
             max(AvgTemperature) AS MaxTemperatureReached
      FROM d GROUP BY MachineID)
ORDER BY MaxVibrationReached DESC, MachineID"""
_WORST_SUPPLIERS = f"""SELECT *, {_zone("MaxVibrationReached", (20, 30, 40))} AS WorstZoneReached
FROM (SELECT l_suppkey, max(AvgQuantity) AS MaxVibrationReached,
             max(AvgPrice) AS MaxTemperatureReached
      FROM d GROUP BY l_suppkey)
ORDER BY MaxVibrationReached DESC, l_suppkey"""
_WORST_Z = """SELECT MachineID, round(max(ZScore), 6) + 0.0 AS MaxZScore FROM s GROUP BY MachineID
ORDER BY max(ZScore) DESC NULLS LAST, MachineID"""

def _asof(recent: str) -> str:
    """Every reading with the latest state of its machine; ``recent`` bounds its age."""
    columns = ("StateSince", "StateId", "State")
    told = ", ".join(f"CASE WHEN true{recent} THEN {c} END AS {c}" for c in columns)
    return _with(
        READINGS
        + """,
st AS (
  SELECT CAST(event_id % 20 + 1 AS INTEGER) AS machine, ts AS StateSince, event_id AS StateId,
         event_type AS State
  FROM events WHERE event_id % 7 = 3
  QUALIFY row_number() OVER (PARTITION BY event_id % 20, ts
                             ORDER BY event_id DESC, event_type DESC) = 1
)""",
        f"""SELECT MachineID, "Timestamp", VibrationVelocity, {told}
FROM r ASOF LEFT JOIN st ON r.MachineID = st.machine AND r."Timestamp" >= st.StateSince""",
    )


# Rows of one minute of each hour come last, three days behind the others at most.
_TOO_LATE = """(minute("Timestamp") = 31 AND "Timestamp" < (
    SELECT max("Timestamp") - INTERVAL 3 DAY FROM r
    WHERE minute("Timestamp") <> 31 AND "Timestamp" < TIMESTAMP '2024-01-25'))"""

_STEPS_OF_READINGS = (
    READINGS
    + """,
steps AS (
  SELECT MachineID, "Timestamp", before,
         CASE WHEN before IS NULL OR epoch_us("Timestamp") - epoch_us(before) > 10800000000
              THEN 1 ELSE 0 END AS opens
  FROM (SELECT *, lag("Timestamp") OVER (PARTITION BY MachineID ORDER BY "Timestamp") AS before
        FROM r)
)"""
)

_DRIFT = (
    CLEAN.replace("e AS (", "WITH RECURSIVE e AS (", 1)
    + """,
o AS (
  SELECT MachineID AS m, "Timestamp" AS t, VibrationVelocity AS v,
         Status = 'error' AND hour("Timestamp") = 3 AS restart,
         row_number() OVER (PARTITION BY MachineID
                            ORDER BY "Timestamp", VibrationVelocity, restart) AS n
  FROM c
),
walk AS (
  SELECT m, n, t, v, v AS a, greatest(0.0::DOUBLE, 0.0::DOUBLE + (v - 0.95::DOUBLE) - 0.05::DOUBLE) AS u,
         greatest(0.0::DOUBLE, 0.0::DOUBLE - (v - 0.95::DOUBLE) - 0.05::DOUBLE) AS d
  FROM o WHERE n = 1
  UNION ALL
  SELECT o.m, o.n, o.t, o.v,
         CASE WHEN restart THEN o.v
              ELSE (1.0::DOUBLE - 0.2::DOUBLE) * a + 0.2::DOUBLE * o.v END,
         greatest(0.0::DOUBLE, CASE WHEN restart THEN 0.0::DOUBLE ELSE u END
                               + (o.v - 0.95::DOUBLE) - 0.05::DOUBLE),
         greatest(0.0::DOUBLE, CASE WHEN restart THEN 0.0::DOUBLE ELSE d END
                               - (o.v - 0.95::DOUBLE) - 0.05::DOUBLE)
  FROM walk JOIN o ON o.m = walk.m AND o.n = walk.n + 1
)
SELECT m AS MachineID, t AS "Timestamp", v AS VibrationVelocity, round(a, 6) AS Ewma,
       round(u, 6) + 0.0 AS CusumUp, round(d, 6) + 0.0 AS CusumDown
FROM walk"""
)

def _robust_over(days: str) -> str:
    """Medians and median deviations of the clean readings of some days."""
    return f"""
rb AS (
  SELECT MachineID, median(VibrationVelocity) AS BaselineMedian,
         mad(VibrationVelocity) AS BaselineMad, count(*) AS BaselineReadings
  FROM c JOIN (SELECT MachineID, min(CAST("Timestamp" AS DATE)) AS start FROM c GROUP BY MachineID)
       USING (MachineID)
  WHERE {days}
  GROUP BY MachineID
)"""


_ROBUST_WEEK = _robust_over("""CAST("Timestamp" AS DATE) <= DATE '2024-01-07'""")
_ROBUST_FIRST = _robust_over("""date_diff('day', start, CAST("Timestamp" AS DATE)) < 5""")
_ROUNDED_R = """round(BaselineMedian, 6) + 0.0 AS BaselineMedian,
       round(BaselineMad, 6) AS BaselineMad, BaselineReadings"""


def _levels(key: str, value: str, decimals: int, sets: str) -> str:
    """Graded days at several levels, straight from the days."""
    names = [n for n in (key, "Month", "VibrationZone") if n in sets]
    one = 10**decimals
    units = f"CAST(sum(CAST(round({value} * {one}) AS BIGINT)) AS HUGEINT)"
    return f"""SELECT {", ".join(names)}, CAST(grouping_id({", ".join(names)}) AS BIGINT) AS GroupingId,
       count(*) AS MachineDays,
       count(*) FILTER (VibrationZone IN ('C', 'D')) AS RestrictedDays,
       count(*) FILTER (VibrationZone = 'D') AS DangerDays,
       count(*) FILTER (TemperatureAlert <> 'Normal') AS AlertDays,
       min({value}) AS MinVibration, max({value}) AS MaxVibration,
       CAST((2 * {units} + count(*)) // (2 * count(*)) AS DOUBLE) / {one} AS AvgVibration
FROM (SELECT *, CAST(date_trunc('month', "Date") AS DATE) AS Month FROM f)
GROUP BY GROUPING SETS ({sets})"""


def _published(name: str, condition: str) -> str:
    """The days that readings meeting a condition give."""
    days = FLAGGED.replace(READINGS, "", 1).replace("FROM r)", f"FROM r WHERE {condition})")
    for cte in ("blanked", "c", "d", "f"):
        days = re.sub(rf"\n{cte} AS \(", f"\n{name}_{cte} AS (", days)
        days = re.sub(rf"\bFROM {cte}\b", f"FROM {name}_{cte}", days)
    return days


_PUBLISHES = (
    READINGS
    + _published("p", """minute("Timestamp") >= 2
                         AND NOT (MachineID = 5 AND "Timestamp" >= TIMESTAMP '2024-01-20')""")
    + _published("q", """(MachineID <> 7 OR hour("Timestamp") <> 4)""")
)


def _differing(before: str, after: str, columns: str, key: str) -> str:
    """Two EXCEPT ALLs, their copies counted, and whether a key has rows in both."""
    return f"""x AS (
  SELECT {columns}, n AS Copies
  FROM (SELECT {columns}, count(*) AS n FROM (FROM {after} EXCEPT ALL FROM {before}) GROUP BY ALL)
  UNION ALL
  SELECT {columns}, -n
  FROM (SELECT {columns}, count(*) AS n FROM (FROM {before} EXCEPT ALL FROM {after}) GROUP BY ALL)
),
changes AS (
  SELECT {columns}, Copies,
         CASE WHEN min(Copies) OVER k < 0 AND max(Copies) OVER k > 0 THEN 'changed'
              WHEN Copies > 0 THEN 'added' ELSE 'removed' END AS Change
  FROM x WINDOW k AS (PARTITION BY {key})
)"""


_DAY_COLUMNS = 'MachineID, "Date", AvgVibration, AvgTemperature, VibrationZone, TemperatureAlert'
_RECONCILED = _PUBLISHES + "," + _differing("p_f", "q_f", _DAY_COLUMNS, 'MachineID, "Date"')
_READING_COLUMNS = ", ".join(f'"{c}"' for c in _COLUMNS)

ORACLES: dict[str, str] = {
    "csv_ingest": _with(READINGS, "SELECT * FROM r"),
    "schema_profile": _with(READINGS, _profile(dict(zip(_COLUMNS, _TYPES)), "r")),
    "table_profile_documents": _with(
        "l AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))",
        _profile(_LABELLED_TYPES, "l"),
    ),
    "table_profile_lineitem": _profile(_LINEITEM_TYPES, "lineitem"),
    "column_counts": _with(READINGS, _column_counts()),
    "preview_rows": _with(
        READINGS,
        'SELECT * FROM r ORDER BY "Timestamp", MachineID, VibrationVelocity NULLS FIRST, '
        "BearingTemperature NULLS FIRST, MotorCurrentDraw NULLS FIRST, "
        "RotationalSpeed NULLS FIRST, Status NULLS FIRST LIMIT 10",
    ),
    "row_count": _with(READINGS, "SELECT count(*) AS Rows FROM r"),
    "null_counts": _with(READINGS, f"SELECT {_nulls(_COLUMNS)} FROM r"),
    "null_counts_lineitem": f"SELECT {_nulls(_LINEITEM)} FROM lineitem",
    "duplicate_summary": _with(READINGS, _DUPLICATES.format(table="r")),
    "duplicate_summary_lineitem": _DUPLICATES.format(table="lineitem"),
    "duplicate_summary_documents": "WITH t AS (SELECT * EXCLUDE (doc_id) FROM documents) "
    + _DUPLICATES.format(table="t"),
    "null_counts_documents": """SELECT count(*) - count(doc_id) AS doc_id,
       count(*) - count(text) AS text, count(*) - count(lang) AS lang, count(*) - count(source) AS source,
       count(*) - count(n_chars) AS n_chars, count(*) - count(quality) AS quality,
       count(*) - count(toxic) AS toxic
FROM documents LEFT JOIN labels USING (doc_id)""",
    "sentinel_counts": _with(
        READINGS,
        "SELECT count(*) FILTER (VibrationVelocity = -999) AS VibrationVelocity FROM r",
    ),
    "quality_report": _with(
        READINGS,
        f"""SELECT *, TotalRows - DistinctRows AS DuplicateRows
FROM (SELECT count(*) AS TotalRows, {_nulls(_COLUMNS, "Null")},
             count(*) FILTER (VibrationVelocity = -999) AS SentinelVibrationVelocity
      FROM r),
     (SELECT count(*) AS DistinctRows FROM (SELECT DISTINCT * FROM r))""",
    ),
    "sentinel_to_null": _with(
        READINGS,
        "SELECT * REPLACE (nullif(VibrationVelocity, -999) AS VibrationVelocity) FROM r",
    ),
    "drop_incomplete": _with(READINGS, f"SELECT * FROM r WHERE {_COMPLETE}"),
    "dedup_rows": _with(READINGS, "SELECT DISTINCT * FROM r"),
    "clean_readings": _with(CLEAN, "SELECT * FROM c"),
    "cleaning_report": _with(
        CLEAN,
        f"""SELECT o AS OriginalRows, u AS DedupedRows, k AS FinalRows,
       o - u AS DuplicatesRemoved, u - k AS IncompleteRemoved, o - k AS TotalRemoved,
       round(CAST(100 * (o - k) AS DOUBLE) / nullif(o, 0), 2) AS PercentRemoved
FROM ({_STEPS})""",
    ),
    "both_reports": _with(
        CLEAN,
        f"""SELECT *, TotalRows - DistinctRows AS DuplicateRows
FROM (SELECT count(*) AS TotalRows, {_nulls(_COLUMNS, "Null")},
             count(*) FILTER (VibrationVelocity = -999) AS SentinelVibrationVelocity
      FROM r),
     (SELECT count(*) AS DistinctRows FROM (SELECT DISTINCT * FROM r)),
     (SELECT count(*) AS FinalRows FROM c)""",
    ),
    "daily_average_fine": _with(_FINE, "SELECT * FROM d"),
    "daily_average_users": _with(USERS, "SELECT * FROM d"),
    "worst_per_user": _with(
        USERS,
        f"""SELECT *, {_zone("MaxVibrationReached", (10, 20, 40))} AS WorstZoneReached
FROM (SELECT user_id, max(AvgValue) AS MaxVibrationReached,
             max(AvgValue2) AS MaxTemperatureReached
      FROM d GROUP BY user_id)""",
    ),
    "baseline_zscore_users": _with(
        USERS_SCORED,
        """SELECT d.*, round(m, 4) AS BaselineMean, round(sd, 4) AS BaselineStdDev,
       round((AvgValue - m) / nullif(sd, 0), 4) + 0.0 AS ZScore
FROM d LEFT JOIN b USING (user_id)""",
    ),
    "daily_average": _with(DAILY, "SELECT * FROM d"),
    "daily_average_lineitem": _with(SHIPMENTS, "SELECT * FROM d"),
    "machine_daily_series": _with(DAILY, 'SELECT * FROM d WHERE MachineID = 11 ORDER BY "Date"'),
    "flagged_days": _with(FLAGGED, "SELECT * FROM f"),
    "restricted_days": _with(
        FLAGGED, "SELECT * FROM f WHERE VibrationZone IN ('C', 'D') ORDER BY MachineID, \"Date\""
    ),
    "worst_per_machine": _with(DAILY, _WORST_MACHINES),
    "worst_machines_top": _with(DAILY, f"{_WORST_MACHINES} LIMIT 5"),
    "worst_per_supplier": _with(SHIPMENTS, _WORST_SUPPLIERS),
    "worst_suppliers_top": _with(SHIPMENTS, f"{_WORST_SUPPLIERS} LIMIT 5"),
    "anomaly_day_count": _with(
        FLAGGED, "SELECT count(*) AS AnomalyDays FROM f WHERE VibrationZone IN ('C', 'D')"
    ),
    "danger_machines": _with(
        FLAGGED, "SELECT DISTINCT MachineID FROM f WHERE VibrationZone = 'D'"
    ),
    "baseline_per_machine": _with(BASELINE, f"SELECT {_ROUNDED_B} FROM b"),
    "baseline_first_days": _with(BASELINE_FIRST, f"SELECT {_ROUNDED_B} FROM b"),
    "baseline_zscore": _with(SCORED, f"SELECT {_ROUNDED_S} FROM s"),
    "baseline_zscore_join": _with(SCORED, f"SELECT {_ROUNDED_S} FROM s"),
    "baseline_zscore_first_days": _with(SCORED_FIRST, f"SELECT {_ROUNDED_S} FROM s"),
    "baseline_zscore_lineitem": _with(
        SHIPMENTS_SCORED,
        """SELECT d.*, round(m, 4) AS BaselineMean, round(sd, 4) AS BaselineStdDev,
       round((AvgQuantity - m) / nullif(sd, 0), 4) + 0.0 AS ZScore
FROM d LEFT JOIN b USING (l_suppkey)""",
    ),
    "significant_days": _with(
        SCORED,
        f'SELECT {_ROUNDED_S} FROM s WHERE abs(s.ZScore) > 3 ORDER BY MachineID, "Date"',
    ),
    "significant_day_count": _with(
        SCORED, "SELECT count(*) AS SignificantDays FROM s WHERE abs(ZScore) > 3"
    ),
    "significant_machines": _with(
        SCORED, "SELECT DISTINCT MachineID FROM s WHERE abs(ZScore) > 3"
    ),
    "worst_zscore": _with(SCORED, _WORST_Z),
    "worst_zscore_top": _with(SCORED, f"{_WORST_Z} LIMIT 5"),
    "asof_state": _asof(""),
    "asof_state_recent": _asof(
        """ AND epoch_us("Timestamp") - epoch_us(StateSince) <= 3600000000"""
    ),
    "shipments_in_windows": """
SELECT part, l_orderkey, l_linenumber, l_shipdate, o_orderkey, opens, closes
FROM (SELECT l_orderkey, l_linenumber, l_partkey AS part, l_shipdate FROM lineitem)
JOIN (SELECT o_orderkey, o_custkey AS part, o_orderdate AS opens,
             o_orderdate + to_days(CAST(CASE WHEN o_orderkey % 97 = 0 THEN 400
                                             ELSE o_orderkey % 9 END AS INTEGER)) AS closes
      FROM orders) USING (part)
WHERE opens <= l_shipdate AND l_shipdate < closes""",
    "reporting_gaps": _with(
        _STEPS_OF_READINGS,
        f"""SELECT MachineID, before AS GapStart, "Timestamp" AS GapEnd,
       (epoch_us("Timestamp") - epoch_us(before)) / 1000000.0::DOUBLE AS Seconds
FROM steps WHERE opens = 1 AND before IS NOT NULL""",
    ),
    "reporting_sessions": _with(
        _STEPS_OF_READINGS,
        """SELECT MachineID, min("Timestamp") AS SessionStart, max("Timestamp") AS SessionEnd,
       count(*) AS Readings
FROM (SELECT *, sum(opens) OVER (PARTITION BY MachineID ORDER BY "Timestamp", before NULLS FIRST
                                 ROWS UNBOUNDED PRECEDING) AS session FROM steps)
GROUP BY MachineID, session""",
    ),
    "vibration_drift": _DRIFT,
    "robust_baseline": _with(CLEAN + "," + _ROBUST_WEEK, f"SELECT MachineID, {_ROUNDED_R} FROM rb"),
    "robust_baseline_first_days": _with(
        CLEAN + "," + _ROBUST_FIRST, f"SELECT MachineID, {_ROUNDED_R} FROM rb"
    ),
    "robust_baseline_users": """SELECT user_id, round(median(value), 6) + 0.0 AS BaselineMedian,
       round(mad(value), 6) AS BaselineMad, count(*) AS BaselineReadings
FROM events GROUP BY user_id""",
    "robust_zscore": _with(
        DAILY + "," + _ROBUST_WEEK,
        f"""SELECT d.*, {_ROUNDED_R},
       round((AvgVibration - rb.BaselineMedian) / nullif(rb.BaselineMad * 1.4826, 0), 6) + 0.0
         AS RobustScore
FROM d LEFT JOIN rb USING (MachineID)""",
    ),
    "fleet_levels": _with(
        FLAGGED,
        _levels("MachineID", "AvgVibration", 3, "(MachineID, Month), (Month, VibrationZone), (MachineID), (Month), ()"),
    ),
    "fleet_levels_lineitem": _with(
        SHIPMENTS
        + f""",
f AS (
  SELECT *, {_zone("AvgQuantity", (20, 30, 40))} AS VibrationZone,
         CASE WHEN AvgPrice >= 90 THEN 'Trip' WHEN AvgPrice >= 80 THEN 'Alarm'
              ELSE 'Normal' END AS TemperatureAlert
  FROM d
)""",
        _levels("l_suppkey", "AvgQuantity", 2, "(l_suppkey), (Month, VibrationZone), ()"),
    ),
    "reconciled_days": _with(_RECONCILED, "SELECT * FROM changes"),
    "reconciled_counts": _with(
        _RECONCILED,
        """SELECT Change, CAST(sum(abs(Copies)) AS BIGINT) AS Rows,
       count(DISTINCT (MachineID, "Date")) AS Keys
FROM changes GROUP BY Change""",
    ),
    "reconciled_readings": _with(
        CLEAN + "," + _differing("r", "c", _READING_COLUMNS, 'MachineID, "Timestamp"'),
        "SELECT * FROM changes",
    ),
    "streaming_daily": _with(
        DAILY.replace("FROM (SELECT DISTINCT * FROM r)", f"FROM (SELECT DISTINCT * FROM r WHERE NOT {_TOO_LATE})"),
        "SELECT * FROM d",
    ),
    "streaming_late_rows": _with(READINGS, f"SELECT * FROM r WHERE {_TOO_LATE}"),
    "vibration_trend_series": _with(
        DAILY,
        """SELECT MachineID, "Date", AvgVibration, MachineID IN (3, 11, 17) AS Highlighted,
       CAST(1.4 AS DOUBLE) AS BoundaryAB, CAST(2.8 AS DOUBLE) AS BoundaryBC,
       CAST(4.5 AS DOUBLE) AS BoundaryCD
FROM d ORDER BY MachineID, "Date\"""",
    ),
    "max_vibration_bars": _with(
        DAILY,
        f"""SELECT *, CASE Zone WHEN 'A' THEN '#2ecc71' WHEN 'B' THEN '#f1c40f'
                     WHEN 'C' THEN '#e67e22' ELSE '#e74c3c' END AS Colour
FROM (SELECT *, {_zone("MaxVibration")} AS Zone
      FROM (SELECT MachineID, max(AvgVibration) AS MaxVibration FROM d GROUP BY MachineID))
ORDER BY MaxVibration DESC, MachineID""",
    ),
    "zscore_trend_series": _with(
        SCORED,
        """SELECT MachineID, "Date", round(ZScore, 6) + 0.0 AS ZScore,
       MachineID IN (3, 11, 17) AS Highlighted,
       CAST(-3 AS DOUBLE) AS LowerBound, CAST(3 AS DOUBLE) AS UpperBound
FROM s ORDER BY MachineID, "Date\"""",
    ),
    "publish_verify": _with(
        FLAGGED,
        """SELECT *, Rows AS ExpectedRows, RestrictedDays AS ExpectedRestrictedDays,
       true AS Verified
FROM (SELECT count(*) AS Rows,
             count(*) FILTER (VibrationZone IN ('C', 'D')) AS RestrictedDays FROM f)""",
    ),
    "stored_run_summary": _with(
        _STORED,
        f"""SELECT o AS TotalRows, u AS DistinctRows, k AS FinalRows, {_HEADLINES}
FROM ({_STEPS})""",
    ),
    "stored_run_incremental": _with(
        _STORED, f"SELECT (SELECT count(*) FROM c) AS FinalRows, {_HEADLINES}"
    ),
    "stored_run_untimed": _with(
        _STORED.replace(
            'ts AS "Timestamp"',
            """CASE WHEN event_type <> 'signup' OR minute(ts) <> 7 THEN ts END AS "Timestamp\"""",
        ),
        f"""SELECT (SELECT count(*) FROM d WHERE "Date" IS NULL) AS UntimedDays, {_HEADLINES}""",
    ),
}
