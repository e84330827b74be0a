"""Named queries over a folder of test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.config import FAULTY_MACHINES, ZONES, DailyMeasure, Monitor
from shaftline.operators import baseline as bl
from shaftline.operators import charts, cleaning, grading, quality, rollup
from shaftline.operators.asof import asof_join
from shaftline.operators.drift import Drift, drift
from shaftline.operators.fleet import MONTH, fleet_report
from shaftline.operators.intervals import interval_join
from shaftline.operators.reconcile import reconcile, reconcile_counts
from shaftline.operators.risk import risk_scores
from shaftline.operators.robust import robust_baseline, robust_score
from shaftline.operators.sessions import reporting_gaps, reporting_sessions
from shaftline.plans.event_readings import EVENT_MONITOR as CFG
from shaftline.plans.event_readings import event_readings
from shaftline.plans.monitoring import (
    daily_from_clean,
    daily_from_readings,
    flagged_from_readings,
    inspect_run,
    run_monitoring,
    scored_from_readings,
    update_monitoring,
)
from shaftline.sources.scratch import scratch_path
from shaftline.streaming.rollup import Stream, advance, late_rows, streamed_daily
from shaftline.sources.tables import (
    publish,
    read_readings,
    read_table,
    verify_publish,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# A second fleet with other column names: suppliers and their shipments.
SHIPMENTS = Monitor(
    key="l_suppkey",
    time="l_shipdate",
    measures=("l_quantity", "l_extendedprice"),
    sentinels={},
    vibration=DailyMeasure("l_quantity", "AvgQuantity", 2),
    temperature=DailyMeasure("l_extendedprice", "AvgPrice", 2),
    zones=((20.0, "A"), (30.0, "B"), (40.0, "C")),
    baseline_cutoff=None,
)

# A third one: users and the values of their events.
USERS = Monitor(
    key="user_id",
    time="ts",
    measures=("value",),
    sentinels={},
    vibration=DailyMeasure("value", "AvgValue", 3),
    temperature=DailyMeasure("value", "AvgValue2", 2),
    zones=((10.0, "A"), (20.0, "B"), (40.0, "C")),
)

_MICROSECONDS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_Z_LINES = {"LowerBound": -CFG.z_limit, "UpperBound": CFG.z_limit}
_ZONE_LINES = dict(zip(("BoundaryAB", "BoundaryBC", "BoundaryCD"), (z for z, _ in ZONES)))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_from_readings(event_readings(spark, sf), CFG)


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return flagged_from_readings(event_readings(spark, sf), CFG)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scored_from_readings(event_readings(spark, sf), CFG)


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/lineitem.parquet")


def _daily_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return daily_from_clean(_lineitem(spark, sf), SHIPMENTS)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels, which many of them lack."""
    labels = read_table(spark, f"{sf}/labels.parquet")
    return _documents(spark, sf).join(labels, "doc_id", "left")


def _daily_users(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, f"{sf}/events.parquet").select("user_id", "ts", "value")
    return daily_from_clean(events, USERS)


def daily_average_fine(spark: SparkSession, sf: str) -> DataFrame:
    """Averages of a value with more decimals than are asked for."""
    fine = _lineitem(spark, sf).selectExpr(
        "l_suppkey", "l_shipdate", "round(l_extendedprice * (1 - l_discount) / 7, 9) AS net"
    )
    net = DailyMeasure("net", "AvgNet", 2)
    return rollup.daily_average(fine, "l_suppkey", "l_shipdate", (net,))


def _comparable(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Baseline columns rounded, so that engines agreeing up to the order of
    floating-point sums compare equal. The operators return them unrounded."""
    names = ("BaselineMean", "BaselineStdDev", "ZScore", "MaxZScore")
    return df.withColumns({c: F.round(c, decimals) for c in names if c in df.columns})


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "readings-csv")
    writer = event_readings(spark, sf).write.option("timestampNTZFormat", _MICROSECONDS)
    writer.csv(path, header=True)
    return read_readings(spark, path, timestamp_format=_MICROSECONDS)


def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Of the readings as they are stored: types come from the files."""
    path = scratch_path(spark, "readings")
    write_table(event_readings(spark, sf), path)
    return quality.table_profile(read_table(spark, path))


def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    readings = event_readings(spark, sf)
    rest = [c for c in readings.columns if c not in (CFG.time, CFG.key)]
    return quality.preview(readings, 10, [CFG.time, CFG.key, *rest])


def baseline_zscore_join(spark: SparkSession, sf: str) -> DataFrame:
    """The daily table is stored first: baseline and join both read it, and
    would otherwise each clean and roll up the raw readings."""
    path = scratch_path(spark, "daily")
    daily = _daily(spark, sf)
    write_table(daily, path, partition_by=[CFG.date], sort_by=[CFG.key])
    daily = read_table(spark, path, daily.schema)
    return _comparable(
        bl.score_with(daily, bl.baseline(daily, cutoff=CFG.baseline_cutoff, cfg=CFG), CFG)
    )


def publish_verify(spark: SparkSession, sf: str) -> DataFrame:
    counts = {"RestrictedDays": grading.is_restricted(CFG)}
    receipt = publish(
        _flagged(spark, sf),
        scratch_path(spark, "flagged"),
        counts=counts,
        partition_by=[CFG.date],
        sort_by=[CFG.key],
    )
    return verify_publish(spark, receipt, counts)


def stored_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All tables stored; headline counts of the run next to those re-read."""
    run = run_monitoring(spark, event_readings(spark, sf), scratch_path(spark, "run"), CFG)
    counted = {name: run.counts.get(name, 0) for name in ("TotalRows", "DistinctRows", "FinalRows")}
    counted["MachineDays"] = run.receipt.rows
    return inspect_run(spark, run.tables, CFG).select(
        *(F.lit(n).cast("bigint").alias(name) for name, n in counted.items()), "*"
    )


def stored_run_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same tables from three batches that cut across days and overlap."""
    readings, target = event_readings(spark, sf), scratch_path(spark, "updated")
    machine, hour = F.col(CFG.key), F.hour(CFG.time)
    for batch in (hour < 9, (hour >= 7) & (machine <= 8), machine > 8):
        run = update_monitoring(spark, readings.where(batch), target, CFG)
    final = run.tables.read(spark, "clean").count()
    return inspect_run(spark, run.tables, CFG).select(
        F.lit(final).cast("bigint").alias("FinalRows"),
        F.lit(run.receipt.rows).cast("bigint").alias("MachineDays"),
        "*",
    )


def stored_run_untimed(spark: SparkSession, sf: str) -> DataFrame:
    """Batches some of whose readings have no time: a day of their own, as in one run."""
    readings, target = event_readings(spark, sf), scratch_path(spark, "untimed")
    timed = F.when((F.col("Status") != "signup") | (F.minute(CFG.time) != 7), F.col(CFG.time))
    readings, machine = readings.withColumn(CFG.time, timed), F.col(CFG.key)
    for batch in (machine <= 12, machine > 8):
        run = update_monitoring(spark, readings.where(batch), target, CFG)
    untimed = run.tables.read(spark, "daily").where(F.col(CFG.date).isNull()).count()
    return inspect_run(spark, run.tables, CFG).select(
        F.lit(run.receipt.rows).cast("bigint").alias("MachineDays"),
        F.lit(untimed).cast("bigint").alias("UntimedDays"),
        "*",
    )


def machine_states(spark: SparkSession, sf: str) -> DataFrame:
    """States that machines enter: every seventh event tells one."""
    events = read_table(spark, f"{sf}/events.parquet").where("event_id % 7 = 3")
    return events.selectExpr(
        "CAST(event_id % 20 + 1 AS INT) AS MachineID",
        "ts AS StateSince",
        "event_id AS StateId",
        "event_type AS State",
    )


def asof_state(spark: SparkSession, sf: str, tolerance: int | None = None) -> DataFrame:
    readings = event_readings(spark, sf).select(CFG.key, CFG.time, CFG.vibration.source)
    states = machine_states(spark, sf)
    return asof_join(readings, states, CFG.key, CFG.time, "StateSince", tolerance)


def shipments_in_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments of a part within windows of up to eight days, and some of over a year."""
    windows = read_table(spark, f"{sf}/orders.parquet").selectExpr(
        "o_orderkey",
        "o_custkey AS part",
        "o_orderdate AS opens",
        """timestampadd(DAY, CAST(CASE WHEN o_orderkey % 97 = 0 THEN 400
             ELSE o_orderkey % 9 END AS INT), o_orderdate) AS closes""",
    )
    shipments = _lineitem(spark, sf).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey AS part", "l_shipdate"
    )
    return interval_join(shipments, windows, ["part"], "l_shipdate", "opens", "closes")


def vibration_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift from 0.95 mm/s, begun anew by errors between 3 and 4 o'clock."""
    cleaned = cleaning.clean(event_readings(spark, sf), CFG)
    restart = (F.col("Status") == "error") & (F.hour(CFG.time) == 3)
    followed = drift(cleaned, CFG.vibration.source, Drift(0.95, 0.05), restart, cfg=CFG)
    return followed.withColumns({c: F.round(c, 6) for c in ("Ewma", "CusumUp", "CusumDown")})


def _streamed(spark: SparkSession, sf: str) -> Stream:
    """The readings in four files that come one after the other, by day; some rows of all
    days come with the last file only."""
    readings, landing = event_readings(spark, sf), scratch_path(spark, "landing")
    delayed = F.minute(CFG.time) == 31
    bounds = ("2024-01-09", "2024-01-17", "2024-01-25")
    days = [F.col(CFG.time) < bounds[0]]
    days += [(F.col(CFG.time) >= a) & (F.col(CFG.time) < b) for a, b in zip(bounds, bounds[1:])]
    stream = Stream(scratch_path(spark, "stream"), delay="3 days", files_per_batch=1, cfg=CFG)
    for part in (*(day & ~delayed for day in days), (F.col(CFG.time) >= bounds[-1]) | delayed):
        readings.where(part).coalesce(1).write.mode("append").parquet(landing)
        advance(spark, landing, stream)
    return stream


def streaming_daily(spark: SparkSession, sf: str) -> DataFrame:
    return streamed_daily(spark, _streamed(spark, sf))


def streaming_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    return late_rows(spark, _streamed(spark, sf)).drop("batch")


def _stored_clean(spark: SparkSession, sf: str) -> DataFrame:
    path, cleaned = scratch_path(spark, "clean"), cleaning.clean(event_readings(spark, sf), CFG)
    write_table(cleaned, path, arrange=False)
    return read_table(spark, path, cleaned.schema)


def _robust(df: DataFrame) -> DataFrame:
    names = ("BaselineMedian", "BaselineMad", "RobustScore")
    return df.withColumns({c: F.round(c, 6) for c in names if c in df.columns})


def robust_baselines(spark: SparkSession, sf: str, **rule: object) -> DataFrame:
    return _robust(robust_baseline(_stored_clean(spark, sf), **rule, cfg=CFG))


def robust_baseline_users(spark: SparkSession, sf: str) -> DataFrame:
    """Over all days: users have few events on each."""
    events = read_table(spark, f"{sf}/events.parquet").select("user_id", "ts", "value")
    return _robust(robust_baseline(events, cutoff="9999-12-31", cfg=USERS))


def robust_zscore(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = _stored_clean(spark, sf)
    baselines = robust_baseline(cleaned, cutoff=CFG.baseline_cutoff, cfg=CFG)
    return _robust(robust_score(daily_from_clean(cleaned, CFG), baselines, CFG))


def fleet_levels(spark: SparkSession, sf: str) -> DataFrame:
    levels = ((CFG.key, MONTH), (MONTH, "VibrationZone"), (CFG.key,), (MONTH,), ())
    return fleet_report(_flagged(spark, sf), levels, CFG)


def fleet_levels_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    flagged = grading.flagged_days(_daily_shipments(spark, sf), SHIPMENTS)
    return fleet_report(flagged, ((SHIPMENTS.key,), (MONTH, "VibrationZone"), ()), SHIPMENTS)


def reconciled_days(spark: SparkSession, sf: str) -> DataFrame:
    """Two publishes: the first without the readings of some minutes and of one machine's
    last days, the second without those of an hour of another machine."""
    readings, machine, time = event_readings(spark, sf), F.col(CFG.key), F.col(CFG.time)
    kept = ((F.minute(time) >= 2) & ~((machine == 5) & (time >= "2024-01-20")), (machine != 7) | (F.hour(time) != 4))
    tables = []
    for part in kept:
        receipt = publish(
            flagged_from_readings(readings.where(part), CFG), scratch_path(spark, "published")
        )
        tables.append(read_table(spark, receipt.uri, receipt.schema))
    return reconcile(*tables, [CFG.key, CFG.date])


def reconciled_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile_counts(reconciled_days(spark, sf), [CFG.key, CFG.date])


def reconciled_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with their copies, against those cleaned."""
    readings = event_readings(spark, sf)
    return reconcile(readings, cleaning.clean(readings, CFG), [CFG.key, CFG.time])


def risk_of_danger(spark: SparkSession, sf: str) -> DataFrame:
    """Being above the zones that are free of restrictions within three days."""
    scored = risk_scores(_daily(spark, sf), split="2024-01-21", bound=CFG.zones[1][0], cfg=CFG)
    names = ("LevelRate", "TemperatureRate", "LevelRise", "RiskScore")
    return scored.withColumns({c: F.round(c, 6) for c in names})


QUERIES: dict[str, Query] = {
    # Sources and profile
    "csv_ingest": csv_ingest,
    "schema_profile": schema_profile,
    "table_profile_documents": lambda s, sf: quality.table_profile(_labelled(s, sf)),
    "table_profile_lineitem": lambda s, sf: quality.table_profile(_lineitem(s, sf)),
    "column_counts": lambda s, sf: quality.column_counts(event_readings(s, sf)),
    "preview_rows": preview_rows,
    "row_count": lambda s, sf: quality.row_count(event_readings(s, sf)),
    # Quality
    "null_counts": lambda s, sf: quality.null_counts(event_readings(s, sf)),
    "null_counts_lineitem": lambda s, sf: quality.null_counts(_lineitem(s, sf)),
    "duplicate_summary": lambda s, sf: quality.duplicate_summary(event_readings(s, sf)),
    "duplicate_summary_lineitem": lambda s, sf: quality.duplicate_summary(_lineitem(s, sf)),
    "duplicate_summary_documents": lambda s, sf: quality.duplicate_summary(
        _documents(s, sf).drop("doc_id")
    ),
    "null_counts_documents": lambda s, sf: quality.null_counts(_labelled(s, sf)),
    "sentinel_counts": lambda s, sf: quality.sentinel_counts(
        event_readings(s, sf), CFG.sentinels
    ),
    "quality_report": lambda s, sf: quality.quality_report(event_readings(s, sf), CFG.sentinels),
    # Cleaning
    "sentinel_to_null": lambda s, sf: cleaning.sentinel_to_null(
        event_readings(s, sf), CFG.sentinels
    ),
    "drop_incomplete": lambda s, sf: cleaning.drop_incomplete(
        event_readings(s, sf), CFG.measures
    ),
    "dedup_rows": lambda s, sf: cleaning.dedup(event_readings(s, sf)),
    "clean_readings": lambda s, sf: cleaning.clean(event_readings(s, sf), CFG),
    "cleaning_report": lambda s, sf: cleaning.cleaning_report(event_readings(s, sf), CFG),
    "both_reports": lambda s, sf: cleaning.both_reports(event_readings(s, sf), CFG),
    # Rollup
    "daily_average": _daily,
    "daily_average_lineitem": _daily_shipments,
    "daily_average_fine": daily_average_fine,
    "daily_average_users": _daily_users,
    "machine_daily_series": lambda s, sf: rollup.series(_daily(s, sf), 11, CFG),
    # Thresholds
    "flagged_days": _flagged,
    "restricted_days": lambda s, sf: grading.restricted_days(_flagged(s, sf), cfg=CFG),
    "worst_per_machine": lambda s, sf: grading.worst_per_entity(_daily(s, sf), cfg=CFG),
    "worst_machines_top": lambda s, sf: grading.worst_per_entity(_daily(s, sf), n=5, cfg=CFG),
    "worst_suppliers_top": lambda s, sf: grading.worst_per_entity(
        _daily_shipments(s, sf), n=5, cfg=SHIPMENTS
    ),
    "worst_per_supplier": lambda s, sf: grading.worst_per_entity(
        _daily_shipments(s, sf), cfg=SHIPMENTS
    ),
    "worst_per_user": lambda s, sf: grading.worst_per_entity(
        _daily_users(s, sf), cfg=USERS
    ),
    "anomaly_day_count": lambda s, sf: grading.anomaly_day_count(_flagged(s, sf), CFG),
    "danger_machines": lambda s, sf: grading.danger_entities(_flagged(s, sf), cfg=CFG),
    # Baseline
    "baseline_per_machine": lambda s, sf: _comparable(
        bl.baseline(_daily(s, sf), cutoff=CFG.baseline_cutoff, cfg=CFG)
    ),
    "baseline_first_days": lambda s, sf: _comparable(
        bl.baseline(_daily(s, sf), first_days=CFG.baseline_days, cfg=CFG)
    ),
    "baseline_zscore": lambda s, sf: _comparable(_scored(s, sf)),
    "baseline_zscore_join": baseline_zscore_join,
    "baseline_zscore_first_days": lambda s, sf: _comparable(
        bl.baseline_zscore(_daily(s, sf), first_days=CFG.baseline_days, cfg=CFG)
    ),
    "baseline_zscore_lineitem": lambda s, sf: _comparable(
        bl.baseline_zscore(_daily_shipments(s, sf), first_days=365, cfg=SHIPMENTS), 4
    ),
    "baseline_zscore_users": lambda s, sf: _comparable(
        bl.baseline_zscore(_daily_users(s, sf), first_days=7, cfg=USERS), 4
    ),
    "significant_days": lambda s, sf: _comparable(bl.significant_days(_scored(s, sf), cfg=CFG)),
    "significant_day_count": lambda s, sf: bl.significant_day_count(_scored(s, sf), cfg=CFG),
    "significant_machines": lambda s, sf: bl.significant_entities(_scored(s, sf), cfg=CFG),
    "worst_zscore": lambda s, sf: _comparable(bl.worst_zscore(_scored(s, sf), cfg=CFG)),
    "worst_zscore_top": lambda s, sf: _comparable(bl.worst_zscore(_scored(s, sf), n=5, cfg=CFG)),
    # Order in time
    "asof_state": lambda s, sf: asof_state(s, sf),
    "asof_state_recent": lambda s, sf: asof_state(s, sf, tolerance=3_600),
    "shipments_in_windows": shipments_in_windows,
    "reporting_gaps": lambda s, sf: reporting_gaps(event_readings(s, sf), "3 hours", cfg=CFG),
    "reporting_sessions": lambda s, sf: reporting_sessions(event_readings(s, sf), "3 hours", cfg=CFG),
    "vibration_drift": vibration_drift,
    # Robust baselines, levels, publishes, risk
    "robust_baseline": lambda s, sf: robust_baselines(s, sf, cutoff=CFG.baseline_cutoff),
    "robust_baseline_first_days": lambda s, sf: robust_baselines(s, sf, first_days=5),
    "robust_baseline_users": robust_baseline_users,
    "robust_zscore": robust_zscore,
    "fleet_levels": fleet_levels,
    "fleet_levels_lineitem": fleet_levels_lineitem,
    "reconciled_days": reconciled_days,
    "reconciled_counts": reconciled_counts,
    "reconciled_readings": reconciled_readings,
    "risk_of_danger": risk_of_danger,
    # Streams
    "streaming_daily": streaming_daily,
    "streaming_late_rows": streaming_late_rows,
    # Chart data
    "vibration_trend_series": lambda s, sf: charts.trend_series(
        _daily(s, sf), CFG.vibration.name, FAULTY_MACHINES, _ZONE_LINES, CFG
    ),
    "max_vibration_bars": lambda s, sf: charts.max_bars(_daily(s, sf), cfg=CFG),
    "zscore_trend_series": lambda s, sf: _comparable(
        charts.trend_series(_scored(s, sf), "ZScore", FAULTY_MACHINES, _Z_LINES, CFG)
    ),
    # Stored results
    "publish_verify": publish_verify,
    "stored_run_summary": stored_run_summary,
    "stored_run_incremental": stored_run_incremental,
    "stored_run_untimed": stored_run_untimed,
}
