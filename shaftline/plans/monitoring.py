"""The whole condition-monitoring flow, from raw readings to stored results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shaftline.config import DEFAULT, Monitor
from shaftline.operators.baseline import (
    baseline,
    baseline_zscore,
    baselines_of,
    entities_without_baseline,
    keys_to_score,
    score_with,
    significant_day_count,
    significant_entities,
    worst_zscore,
)
from shaftline.operators.charts import max_bars, trend_series
from shaftline.operators.cleaning import clean, clean_and_observe, dedup, usable
from shaftline.operators.grading import (
    anomaly_day_count,
    danger_entities,
    flagged_days,
    is_restricted,
    worst_per_entity,
)
from shaftline.operators.rollup import daily_average, with_date
from shaftline.sources.scratch import scratch_path
from shaftline.sources.tables import (
    Receipt,
    drop_partitions,
    drop_table,
    publish,
    read_table,
    table_exists,
    write_table,
)


def daily_from_clean(cleaned: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    return daily_average(
        cleaned, cfg.key, cfg.time, cfg.daily_measures, cfg.date, cfg.exact_averages
    )


def daily_from_readings(readings: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """Clean and roll up, as one lazy plan."""
    return daily_from_clean(clean(readings, cfg), cfg)


def flagged_from_readings(readings: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    return flagged_days(daily_from_readings(readings, cfg), cfg)


def scored_from_readings(readings: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    return baseline_zscore(daily_from_readings(readings, cfg), **cfg.baseline_rule, cfg=cfg)


@dataclass(frozen=True)
class Tables:
    """The stored tables below one target folder.

    ``schemas``, where a run has filled it in, lets tables of no rows be read.
    """

    target: str
    schemas: Mapping[str, T.StructType] = field(default_factory=dict, compare=False)

    @property
    def clean(self) -> str:
        return f"{self.target}/clean"

    @property
    def daily(self) -> str:
        return f"{self.target}/daily"

    @property
    def flagged(self) -> str:
        return f"{self.target}/flagged"

    @property
    def scored(self) -> str:
        return f"{self.target}/scored"

    @property
    def baselines(self) -> str:
        """What each key is scored against, for the next update."""
        return f"{self.target}/baselines"

    @property
    def pending(self) -> str:
        """Where an update says what it is about to replace, until it has."""
        return f"{self.target}/pending"

    def report(self, name: str) -> str:
        return f"{self.target}/reports/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """One of the tables, or reports, by name."""
        path = self.report(name) if name in REPORTS else f"{self.target}/{name}"
        return read_table(spark, path, self.schemas.get(name))


@dataclass(frozen=True)
class Run:
    """Stored tables of a run, the receipt of the flagged days and, if the
    clean readings were stored, what was found and left by cleaning."""

    tables: Tables
    receipt: Receipt
    counts: Mapping[str, int] | None


# Reports stored by every run, whole and in the order they are shown in.
REPORTS = (
    "worst",
    "danger",
    "baseline",
    "significant",
    "worst_zscore",
    "vibration_trend",
    "max_vibration",
    "zscore_trend",
)
# Those with a row per key and day: stored by day like the daily tables, not sorted as a whole.
TRENDS = ("vibration_trend", "zscore_trend")
# Reports are small and independent jobs, so that many are written at a time.
_AT_ONCE = 4


def _reports(
    daily: DataFrame, flagged: DataFrame, scored: DataFrame, cfg: Monitor
) -> dict[str, DataFrame]:
    bounds = (bound for bound, _ in cfg.zones)
    lines = dict(zip(("BoundaryAB", "BoundaryBC", "BoundaryCD"), bounds))
    limits = {"LowerBound": -cfg.z_limit, "UpperBound": cfg.z_limit}
    frames = (
        worst_per_entity(daily, cfg=cfg),
        danger_entities(flagged, cfg=cfg).orderBy(cfg.key),
        baseline(daily, **cfg.baseline_rule, cfg=cfg).orderBy(cfg.key),
        significant_entities(scored, cfg=cfg).orderBy(cfg.key),
        worst_zscore(scored, cfg=cfg),
        trend_series(daily, cfg.vibration.name, cfg.highlight, lines, cfg, ordered=False),
        max_bars(daily, cfg=cfg),
        trend_series(scored, "ZScore", cfg.highlight, limits, cfg, ordered=False),
    )
    return dict(zip(REPORTS, frames))


def _store_reports(
    spark: SparkSession,
    tables: Tables,
    cfg: Monitor,
    layout: Mapping[str, Sequence[str]],
    days: Mapping[str, Sequence[object]] | None = None,
) -> Tables:
    """The reports, from stored daily tables; ``tables`` with their schemas.

    ``days`` are those whose rows of the trends are replaced, all without it.
    """
    frames = _reports(*(tables.read(spark, x) for x in ("daily", "flagged", "scored")), cfg)

    def store(name: str) -> None:
        frame, path = frames[name], tables.report(name)
        if name not in TRENDS:
            write_table(frame, path)
        elif days is None:
            write_table(frame, path, **layout, arrange=False)
        else:
            _replace_days(spark, frame.where(_on_days(days[name], cfg)), path, days[name], cfg)

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(store, frames))
    schemas = {name: frame.schema for name, frame in frames.items()}
    return Tables(tables.target, {**tables.schemas, **schemas})


def _replace_days(
    spark: SparkSession,
    frame: DataFrame,
    path: str,
    days: Sequence[object],
    cfg: Monitor,
    left: set | None = None,
    arrange: bool = False,
    sort_by: Sequence[str] | None = None,
) -> None:
    """Replace some days of a table stored by day; days without rows, that is all but
    ``left``, are removed. ``frame`` comes row by row from a table stored alike, unless
    ``arrange`` says that its rows have to be brought together."""
    write_table(
        frame,
        path,
        partition_by=[cfg.date],
        sort_by=[cfg.key] if sort_by is None else sort_by,
        arrange=arrange,
        only_given_partitions=True,
    )
    left = _days_of(frame, cfg) if left is None else left
    drop_partitions(spark, path, cfg.date, [day for day in days if day not in left])


def run_monitoring(
    spark: SparkSession,
    readings: DataFrame,
    target: str,
    cfg: Monitor = DEFAULT,
    store_clean: bool = True,
    by_day: bool = True,
) -> Run:
    """Clean, roll up, grade and score ``readings`` into tables below ``target``.

    The raw readings are read once. With ``store_clean`` that job writes the
    clean readings and counts nulls, sentinels, copies and the rows left, and
    the rollup starts from the stored table; without it the readings go straight to the daily
    table and the clean rows are never written. Everything after the daily
    table works on one row per machine and day. The reports of ``REPORTS`` are
    stored too, whole.

    The clean readings stay unpartitioned, since laying them out by day would
    shuffle all of them again. The daily tables are partitioned by day, unless
    ``by_day=False`` says that a fleet is too small to fill a file per day;
    grading keeps the layout of the daily table it reads and shuffles nothing.
    """
    tables = Tables(target)
    layout = {"partition_by": [cfg.date] if by_day else [], "sort_by": [cfg.key]}
    drop_table(spark, tables.baselines)

    if store_clean:
        observation = Observation()
        observed = clean_and_observe(readings, observation, cfg)
        write_table(observed, tables.clean)
        counts = observation.get
        cleaned = read_table(spark, tables.clean, observed.schema)
    else:
        counts = None
        cleaned = clean(readings, cfg)

    daily = daily_from_clean(cleaned, cfg)
    write_table(daily, tables.daily, **layout)
    daily = read_table(spark, tables.daily, daily.schema)

    flagged = flagged_days(daily, cfg)
    receipt = publish(
        flagged,
        tables.flagged,
        counts={"RestrictedDays": is_restricted(cfg)},
        arrange=False,
        **layout,
    )
    scored = baseline_zscore(daily, **cfg.baseline_rule, cfg=cfg)
    write_table(scored, tables.scored, **layout)
    schemas = {"clean": cleaned, "daily": daily, "flagged": flagged, "scored": scored}
    tables = Tables(target, {name: frame.schema for name, frame in schemas.items()})
    return Run(_store_reports(spark, tables, cfg, layout), receipt, counts)


def update_monitoring(
    spark: SparkSession,
    readings: DataFrame,
    target: str,
    cfg: Monitor = DEFAULT,
    whole_days: bool = False,
) -> Run:
    """Bring the tables below ``target`` up to date with more ``readings``.

    The first call starts the tables; any split of the readings over calls gives
    what one run over all of them gives. The clean readings are kept
    partitioned by day. Those of the days that ``readings`` touches are read
    back, copies are removed again, and just these days are rolled up, graded
    and scored anew. What each machine is scored against is kept beside the tables:
    only machines with a change within their baseline period are followed through all
    their days, and only the days they have are stored again; of all others the history is
    not read. (Small reports are made anew from the daily tables.)

    With ``whole_days`` the readings are all those of their days and replace
    them; a day left without a usable reading is removed. The number of days
    touched is bounded by the calendar. Readings without a time are a day of
    their own, the null one, as in a run.

    What an update replaces is written down first, and where its clean rows wait. If it
    fails between two tables, the next call replaces those clean rows again and
    brings all tables up to date for their days too.
    """
    if set(cfg.sentinels) - set(cfg.measures):
        # Blanked, two rows that were different could no longer be told apart.
        raise ValueError("updates need every sentinel to be in a measure")
    tables = Tables(target)
    dated = with_date(readings, cfg.time, cfg.date)
    batch = dated.where(usable(readings, cfg))
    schemas = {"clean": batch.schema}
    layout = {"partition_by": [cfg.date], "sort_by": [cfg.key]}

    unfinished = _pending(spark, tables, schemas["clean"], cfg)
    for waiting, days in unfinished:
        _replace_days(spark, waiting, tables.clean, days, cfg, sort_by=())
    own = _days_of(dated, cfg)
    again = {day for _, days in unfinished for day in days} - own
    days = _in_order(own | again)
    touched = _on_days(days, cfg)
    started = table_exists(spark, tables.clean)
    if started:
        kept = _on_days(_in_order(again), cfg) if whole_days else touched
        batch = read_table(spark, tables.clean, batch.schema).where(kept).unionByName(batch)

    # The partitions that are replaced are read by what replaces them.
    waiting = scratch_path(spark, "clean")
    write_table(dedup(batch), waiting, partition_by=[cfg.date])
    fresh = read_table(spark, waiting, schemas["clean"])
    left = _days_of(fresh, cfg)
    _note_pending(spark, tables, waiting, days)

    _replace_days(spark, fresh, tables.clean, days, cfg, left, sort_by=())
    daily = daily_from_clean(fresh.drop(cfg.date), cfg)
    schemas["daily"] = daily.schema
    # Without what the last update has left, all is scored.
    rebuild = bool(unfinished) or not table_exists(spark, tables.baselines)
    before = None if rebuild else _levels_before(spark, tables, daily.schema, touched, cfg)
    _replace_days(spark, daily, tables.daily, days, cfg, left, arrange=True)

    daily = read_table(spark, tables.daily, schemas["daily"])
    flagged = flagged_days(daily, cfg)
    schemas["flagged"] = flagged.schema
    if started:
        _replace_days(spark, flagged.where(touched), tables.flagged, days, cfg, left)
    else:
        write_table(flagged, tables.flagged, **layout, arrange=False)

    if before is None:
        scored = baseline_zscore(daily, **cfg.baseline_rule, cfg=cfg)
        write_table(scored, tables.scored, **layout)
        baselines, trends = baselines_of(read_table(spark, tables.scored, scored.schema), cfg), None
    else:
        scored, baselines, others = _scored_anew(spark, tables, daily, before, touched, cfg)
        again = _in_order(set(days) | others)
        rows = scored.where(_on_days(again, cfg))
        _replace_days(spark, rows, tables.scored, again, cfg, left | others, arrange=True)
        trends = {"vibration_trend": days, "zscore_trend": again}
    schemas["scored"] = scored.schema
    if baselines is not None:
        waiting = scratch_path(spark, "baselines")
        write_table(baselines, waiting)
        write_table(read_table(spark, waiting, baselines.schema), tables.baselines)

    tables = _store_reports(spark, Tables(target, schemas), cfg, layout, trends)
    drop_table(spark, tables.pending)
    counted = tables.read(spark, "flagged").agg(
        F.count(F.lit(1)), F.count_if(is_restricted(cfg))
    )
    n, restricted = counted.first()
    receipt = Receipt(tables.flagged, n, {"RestrictedDays": restricted}, schemas["flagged"])
    return Run(tables, receipt, None)


def _days_of(dated: DataFrame, cfg: Monitor) -> set:
    """Days of some rows, ``None`` for rows without one; the calendar bounds their number."""
    return {row[0] for row in dated.select(cfg.date).distinct().collect()}


def _in_order(days: set) -> list:
    return sorted(days, key=lambda day: (day is not None, day))


def _on_days(days: Sequence[object], cfg: Monitor) -> Column:
    day, known = F.col(cfg.date), [day for day in days if day is not None]
    inside = F.coalesce(day.isin(known), F.lit(False)) if known else F.lit(False)
    return inside | day.isNull() if None in days else inside


def _note_pending(spark: SparkSession, tables: Tables, waiting: str, days: Sequence[object]) -> None:
    """Write down where clean rows wait and which days they replace, in one file."""
    rows = [(waiting, day) for day in days]
    write_table(spark.createDataFrame(rows, "waiting string, day date").coalesce(1), tables.pending)


def _pending(
    spark: SparkSession, tables: Tables, schema: T.StructType, cfg: Monitor
) -> list[tuple[DataFrame, list]]:
    """What an earlier update has not finished: clean rows that wait, and their days."""
    if not table_exists(spark, f"{tables.pending}/_SUCCESS"):
        return []
    noted = read_table(spark, tables.pending).collect()
    paths = sorted({row["waiting"] for row in noted})
    return [
        (read_table(spark, path, schema), [row["day"] for row in noted if row["waiting"] == path])
        for path in paths
    ]


def _levels_before(
    spark: SparkSession, tables: Tables, schema: T.StructType, touched: Column, cfg: Monitor
) -> DataFrame:
    """The levels of the days that are about to be replaced, kept apart."""
    path = scratch_path(spark, "before")
    daily = read_table(spark, tables.daily, schema).where(touched)
    levels = daily.select(cfg.key, cfg.date, cfg.vibration.name)
    write_table(levels, path)
    return read_table(spark, path, levels.schema)


def _scored_anew(
    spark: SparkSession,
    tables: Tables,
    daily: DataFrame,
    before: DataFrame,
    touched: Column,
    cfg: Monitor,
) -> tuple[DataFrame, DataFrame | None, set]:
    """Scores against the baselines as they are now; the baselines, if any has changed;
    and the days beside the touched ones that have rows of such keys."""
    whole = baselines_of(baseline_zscore(daily, **cfg.baseline_rule, cfg=cfg), cfg)
    kept = read_table(spark, tables.baselines, whole.schema)
    after = daily.where(touched).select(*before.columns)
    path = scratch_path(spark, "changed")
    write_table(keys_to_score(before, after, kept, **cfg.baseline_rule, cfg=cfg), path)
    changed = read_table(spark, path, daily.select(cfg.key).schema)
    if changed.isEmpty():
        return score_with(daily, kept.drop("FirstDay"), cfg), None, set()
    own = daily.join(changed, cfg.key, "left_semi")
    anew = baselines_of(baseline_zscore(own, **cfg.baseline_rule, cfg=cfg), cfg)
    baselines = kept.join(changed, cfg.key, "left_anti").unionByName(anew)
    others = _days_of(own.where(~touched), cfg)
    return score_with(daily, baselines.drop("FirstDay"), cfg), baselines, others


def inspect_run(spark: SparkSession, tables: Tables, cfg: Monitor = DEFAULT) -> DataFrame:
    """One row of headline counts, re-read from the stored tables."""
    scored = tables.read(spark, "scored")
    counts = (
        anomaly_day_count(tables.read(spark, "flagged"), cfg),
        significant_day_count(scored, cfg=cfg),
        entities_without_baseline(scored, cfg),
    )
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return both.agg(*(F.max(name).alias(name) for name in both.columns))
