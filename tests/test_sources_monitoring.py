from __future__ import annotations

from datetime import date, datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from shaftline.__main__ import main
from shaftline.config import READINGS, Monitor
from shaftline.operators import baseline as bl
from shaftline.operators import cleaning, grading, rollup
from shaftline.plans import monitoring
from shaftline.sources import tables
from shaftline.sources.scratch import scratch_path

HEADER = ",".join(READINGS.names)


def csv(tmp_path, *lines, name="r.csv", header=HEADER) -> str:
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_csv_of_whole_seconds(spark, tmp_path):
    path = csv(
        tmp_path,
        "1,2026-01-01 00:15:00,0.8,45.2,12.1,1460.3,Running",
        "2,2026-01-01 00:30:00,,-999,,1455.0,",
    )
    df = tables.read_readings(spark, path)
    assert df.schema == READINGS
    assert [tuple(r) for r in df.orderBy("MachineID").collect()] == [
        (1, datetime(2026, 1, 1, 0, 15), 0.8, 45.2, 12.1, 1460.3, "Running"),
        (2, datetime(2026, 1, 1, 0, 30), None, -999.0, None, 1455.0, None),
    ]


def test_csv_inference_finds_the_same_values(spark, tmp_path):
    path = csv(tmp_path, "1,2026-01-01 00:15:00,0.8,45.2,12.1,1460.3,Running")
    inferred = tables.read_readings(spark, path, infer=True)
    assert dict(inferred.dtypes)["MachineID"] == "int"
    declared = tables.read_readings(spark, path)
    assert inferred.drop("Timestamp").first() == declared.drop("Timestamp").first()


def test_malformed_values_are_not_silently_dropped(spark, tmp_path):
    path = csv(tmp_path, "1,2026-01-01 00:15:00,oops,45.2,12.1,1460.3,Running")
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        tables.read_readings(spark, path).collect()
    lenient = tables.read_readings(spark, path, mode="PERMISSIVE").first()
    assert lenient.VibrationVelocity is None


def test_a_reordered_header_is_refused(spark, tmp_path):
    swapped = HEADER.replace("VibrationVelocity,BearingTemperature", "BearingTemperature,VibrationVelocity")
    path = csv(tmp_path, "1,2026-01-01 00:15:00,45.2,0.8,12.1,1460.3,Running", header=swapped)
    with pytest.raises(Py4JJavaError, match="header does not conform"):
        tables.read_readings(spark, path).collect()


def test_csv_of_fractional_seconds_and_other_notations(spark, tmp_path):
    path = csv(tmp_path, "1,2026-01-01 00:15:00.123456,0.8,45.2,12.1,1460.3,Running")
    assert tables.read_readings(spark, path).first().Timestamp == datetime(2026, 1, 1, 0, 15, 0, 123456)
    path = csv(tmp_path, "1,01/02/2026 00:15,0.8,45.2,12.1,1460.3,Running")
    df = tables.read_readings(spark, path, timestamp_format="dd/MM/yyyy HH:mm")
    assert df.first().Timestamp == datetime(2026, 2, 1, 0, 15)


def test_several_csv_files(spark, tmp_path):
    one = csv(tmp_path, "1,2026-01-01 00:15:00,0.8,45.2,12.1,1460.3,Running", name="a.csv")
    two = csv(tmp_path, "2,2026-01-01 00:15:00,0.8,45.2,12.1,1460.3,Idle", name="b.csv")
    assert tables.read_readings(spark, [one, two]).count() == 2


DAYS = [(m, date(2026, 1, d), float(m * d)) for m in (1, 2, 3) for d in (1, 2, 3, 4)]
DDL = "MachineID int, Date date, x double"


def test_write_and_read_back(spark, tmp_path, rows):
    df = spark.createDataFrame(DAYS, DDL)
    for i, options in enumerate(({}, {"partition_by": ["Date"], "sort_by": ["MachineID"]})):
        path = str(tmp_path / str(i))
        tables.write_table(df, path, **options)
        assert rows(tables.read_table(spark, path, df.schema)) == rows(df)
    assert {p.name for p in (tmp_path / "1").glob("Date=*")} == {f"Date=2026-01-0{d}" for d in (1, 2, 3, 4)}


def test_overwrite_leaves_nothing_behind(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(DAYS, DDL)
    tables.write_table(df, path, partition_by=["Date"])
    fewer = df.where("Date = '2026-01-01'")
    tables.write_table(fewer, path, partition_by=["Date"])
    assert rows(tables.read_table(spark, path, df.schema)) == rows(fewer)


def test_only_given_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(DAYS, DDL)
    tables.write_table(df, path, partition_by=["Date"])
    new = spark.createDataFrame([(9, date(2026, 1, 2), 0.5)], DDL)
    tables.write_table(new, path, partition_by=["Date"], only_given_partitions=True)
    assert rows(tables.read_table(spark, path, df.schema)) == rows(
        df.where("Date <> '2026-01-02'").union(new)
    )
    with pytest.raises(ValueError):
        tables.write_table(new, path, only_given_partitions=True)


def test_unpartitioned_write_does_not_shuffle(spark):
    df = spark.createDataFrame(DAYS, DDL)
    plain = tables._laid_out(df, (), (), True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plain
    kept = tables._laid_out(df, ["Date"], ["MachineID"], False)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    laid = tables._laid_out(df, ["Date"], ["MachineID"], True)
    assert "REBALANCE_PARTITIONS_BY_COL" in laid._jdf.queryExecution().executedPlan().toString()


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000, numPartitions=8).selectExpr(
        "CAST(id AS int) AS MachineID",
        "IF(id % 10 < 9, DATE '2026-01-01', DATE '2026-01-02') AS Date",
        "rand(7) AS x",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        tables.write_table(df, str(tmp_path / "t"), partition_by=["Date"], sort_by=["MachineID"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "Date=2026-01-01").glob("part-*"))) > 2
    assert spark.read.parquet(str(tmp_path / "t")).distinct().count() == 200_000


def test_stored_zones_are_filtered_in_the_scan(spark, tmp_path):
    daily = spark.createDataFrame(
        [(1, date(2026, 1, 1), 3.0, 50.0)], "MachineID int, Date date, AvgVibration double, AvgTemperature double"
    )
    tables.write_table(grading.flagged_days(daily), str(tmp_path / "f"), partition_by=["Date"])
    stored = grading.restricted_days(tables.read_table(spark, str(tmp_path / "f")))
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert "In(VibrationZone, [C,D])" in text


@pytest.mark.parametrize("options", [{}, {"partition_by": ["Date"], "sort_by": ["MachineID"]}])
def test_publish_and_verify(spark, tmp_path, options):
    df = spark.createDataFrame(DAYS, DDL)
    counts = {"Big": F.col("x") > 3}
    receipt = tables.publish(df, str(tmp_path / "p"), counts, **options)
    big = sum(x > 3 for *_, x in DAYS)
    assert (receipt.rows, receipt.counts) == (12, {"Big": big})
    assert tuple(tables.verify_publish(spark, receipt, counts).first()) == (12, big, 12, big, True)


def test_verify_notices_a_stale_publish(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame(DAYS, DDL)
    counts = {"Big": F.col("x") > 3}
    receipt = tables.publish(df, path, counts)
    # Another run leaves the same number of rows and a success marker.
    tables.publish(df.withColumn("x", F.lit(0.0)), path)
    seen = tables.verify_publish(spark, receipt, counts).first()
    assert (seen.Rows, seen.Big, seen.Verified) == (12, 0, False)


def test_verify_needs_the_counts_of_the_receipt(spark, tmp_path):
    receipt = tables.publish(spark.createDataFrame(DAYS, DDL), str(tmp_path / "p"))
    with pytest.raises(ValueError):
        tables.verify_publish(spark, receipt, {"Big": F.col("x") > 3})


def test_publish_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], DDL)
    receipt = tables.publish(df, str(tmp_path / "p"), {"Big": F.col("x") > 3})
    assert (receipt.rows, receipt.counts) == (0, {"Big": 0})
    assert tables.verify_publish(spark, receipt).first().Verified


def test_publish_counts_in_the_writing_stage(spark):
    df = spark.createDataFrame(DAYS, DDL)
    observed = tables._laid_out(df, ["Date"], [], True).observe(Observation(), F.count(F.lit(1)).alias("n"))
    text = observed._jdf.queryExecution().executedPlan().toString()
    assert text.index("CollectMetrics") < text.index("Exchange")


def test_missing_table(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "nowhere"))


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_scratch_uses_the_shared_folder(spark: SparkSession):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared + "/") and first != second


def test_scratch_refuses_a_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch_path(Settings(**{"spark.master": "spark://host:7077"}), "x")
    assert scratch_path(Settings(**{"spark.master": "local[2]"}), "x")


# A machine developing a fault over 30 days of 96 readings, without noise:
# vibration 0.8 + 4.5 p and temperature 45 + 50 p, p going from 0 to 1.
@pytest.fixture(scope="module")
def ramp(spark):
    return spark.range(30 * 96).select(
        F.lit(3).alias("MachineID"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 15 * CAST(id AS int))").alias(
            "Timestamp"
        ),
        F.expr("round(0.8D + id / 2880D * 4.5D, 3)").alias("VibrationVelocity"),
        F.expr("round(45D + id / 2880D * 50D, 2)").alias("BearingTemperature"),
        F.expr("round(12D + id / 2880D * 4D, 2)").alias("MotorCurrentDraw"),
        F.lit(1460.0).alias("RotationalSpeed"),
        F.lit("Running").alias("Status"),
    )


def test_closed_form_of_a_developing_fault(ramp):
    flagged = monitoring.flagged_from_readings(ramp).orderBy("Date").collect()
    assert "".join(r.VibrationZone for r in flagged) == "A" * 4 + "B" * 9 + "C" * 12 + "D" * 5
    alerts = [r.TemperatureAlert for r in flagged]
    assert alerts == ["Normal"] * 21 + ["Alarm"] * 6 + ["Trip"] * 3
    assert max(r.AvgVibration for r in flagged) == pytest.approx(5.224, abs=1e-3)
    assert max(r.AvgTemperature for r in flagged) == pytest.approx(94.16, abs=1e-2)

    scored = monitoring.scored_from_readings(ramp).orderBy("Date").collect()
    assert scored[0].BaselineMean == pytest.approx(1.3242, abs=1e-3)
    assert scored[0].BaselineStdDev == pytest.approx(0.3240, abs=1e-3)
    assert scored[-1].ZScore == pytest.approx(12.04, abs=0.01)
    assert [i for i, r in enumerate(scored) if r.ZScore > 3] == list(range(10, 30))


@pytest.mark.parametrize(
    "cfg, store_clean, by_day",
    [
        (Monitor(), True, True),
        (Monitor(baseline_cutoff=None), False, True),
        (Monitor(exact_averages=False), False, False),
    ],
)
def test_stored_run(spark, ramp, rows, tmp_path, cfg, store_clean, by_day):
    healthy = ramp.select(
        F.lit(1).alias("MachineID"),
        "Timestamp",
        F.expr("1D + (unix_seconds(CAST(Timestamp AS timestamp)) DIV 900 % 7) / 100").alias("VibrationVelocity"),
        F.lit(50.0).alias("BearingTemperature"),
        "MotorCurrentDraw",
        "RotationalSpeed",
        "Status",
    )
    dirty = ramp.limit(5).withColumn("VibrationVelocity", F.lit(-999.0))
    readings = ramp.union(healthy).union(healthy.limit(7)).union(dirty)
    run = monitoring.run_monitoring(spark, readings, str(tmp_path), cfg, store_clean, by_day)

    if store_clean:
        found = {"TotalRows": 5772, "DistinctRows": 5765, "FinalRows": 5760}
        assert found.items() <= run.counts.items()
        assert run.counts["SentinelVibrationVelocity"] == 5
    else:
        assert run.counts is None
    assert (tmp_path / "clean").exists() == store_clean
    for table in ("daily", "flagged", "scored"):
        assert len(list((tmp_path / table).glob("Date=*"))) == (30 if by_day else 0)
    assert run.receipt.rows == 60
    assert run.receipt.counts == {"RestrictedDays": 17}

    daily = rollup.daily_average(cleaning.clean(readings, cfg), exact=cfg.exact_averages)
    assert rows(tables.read_table(spark, run.tables.daily, daily.schema)) == rows(daily)
    flagged = grading.flagged_days(daily, cfg)
    assert rows(tables.read_table(spark, run.tables.flagged, flagged.schema)) == rows(flagged)
    scored = bl.baseline_zscore(daily, **cfg.baseline_rule, cfg=cfg)
    assert rows(tables.read_table(spark, run.tables.scored, scored.schema)) == rows(scored)
    assert tuple(monitoring.inspect_run(spark, run.tables, cfg).first()) == (17, 20, 0)
    assert [r[0] for r in run.tables.read(spark, "danger").collect()] == [3]
    assert run.tables.read(spark, "vibration_trend").count() == 60

    # A second run replaces the first.
    again = monitoring.run_monitoring(spark, ramp, str(tmp_path), cfg, store_clean, by_day)
    assert again.receipt.rows == 30
    assert tables.read_table(spark, run.tables.flagged).count() == 30


def test_shuffles_of_the_composed_flow(spark, ramp, tmp_path):
    """One shuffle of raw rows, one of partial sums, one of daily rows."""
    ramp.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    for df, shuffles in (
        (cleaning.clean(stored), 1),
        (monitoring.flagged_from_readings(stored), 2),
        (monitoring.scored_from_readings(stored), 3),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == text.count("Exchange") == shuffles
        assert text.count("FileScan") == 1
        assert "Python" not in text and "SortAggregate" not in text


def test_any_split_of_the_readings_equals_one_run(spark, ramp, rows, tmp_path):
    readings = ramp.union(ramp.limit(50))
    whole = monitoring.run_monitoring(spark, readings, str(tmp_path / "whole"))
    hour, day = F.hour("Timestamp"), F.dayofmonth("Timestamp")
    for batch in (day > 20, hour < 13, hour >= 11):  # days cut across, rows given twice
        run = monitoring.update_monitoring(spark, readings.where(batch), str(tmp_path / "parts"))
    assert run.receipt.counts == whole.receipt.counts
    for name in ("clean", "daily", "flagged", "scored", *monitoring.REPORTS):
        one = whole.tables.read(spark, name)
        assert rows(run.tables.read(spark, name).select(*one.columns)) == rows(one)


def some_readings(spark, *values, day="2027-03-01"):
    times = (f"{day} 0{k}:00:00" for k in range(len(values)))
    rows = [(1, t, v, 50.0, 12.0, 1460.0, "Running") for t, v in zip(times, values)]
    names = "MachineID int, Timestamp string, VibrationVelocity double, BearingTemperature double"
    df = spark.createDataFrame(rows, names + ", MotorCurrentDraw double, RotationalSpeed double, Status string")
    return df.withColumn("Timestamp", F.col("Timestamp").cast("timestamp_ntz"))


def test_days_behind_the_baselines_leave_the_history_alone(spark, ramp, tmp_path, rows, monkeypatch):
    """Neither scored nor stored anew, though a machine of its own first days comes along."""
    day = F.dayofmonth("Timestamp")
    readings = ramp.where(F.hour("Timestamp") % 8 == 0)
    other = readings.where(day >= 19).withColumn("MachineID", F.lit(8))
    target = tmp_path / "parts"
    monitoring.update_monitoring(spark, readings.where(day <= 18), str(target))

    def files() -> set[str]:
        names = ("scored", "reports/zscore_trend", "reports/vibration_trend")
        return {str(p) for n in names for p in (target / n).glob("Date=*/*.parquet") if str(p.parent)[-2:] < "19"}

    before = files()
    assert len({p.rsplit("/", 1)[0] for p in before}) == 54
    with monkeypatch.context() as patch:
        patch.setattr(monitoring, "baseline_zscore", lambda daily, **how: bl.baseline_zscore(daily, **how).where(
            F.raise_error(F.lit("scored anew")).isNull()))
        monitoring.update_monitoring(spark, readings.where(day == 19), str(target))
    run = monitoring.update_monitoring(spark, readings.where(day > 19).union(other), str(target))
    assert files() == before
    whole = monitoring.run_monitoring(spark, readings.union(other), str(tmp_path / "whole"))
    same_tables(rows, spark, run, whole)


def test_a_first_day_that_comes_late_or_goes_moves_the_baseline(spark, ramp, tmp_path, rows):
    day = F.dayofmonth("Timestamp")
    readings = ramp.where(F.hour("Timestamp") % 12 == 0)
    target = str(tmp_path / "parts")
    for batch in (day.between(4, 15), day <= 2):
        run = monitoring.update_monitoring(spark, readings.where(batch), target)
    given = readings.where(day.between(4, 15) | (day <= 2))
    same_tables(rows, spark, run, monitoring.run_monitoring(spark, given, str(tmp_path / "a")))
    gone = given.where(day == 1).withColumn("VibrationVelocity", F.lit(None).cast("double"))
    run = monitoring.update_monitoring(spark, gone, target, whole_days=True)
    left = given.where(day != 1)
    same_tables(rows, spark, run, monitoring.run_monitoring(spark, left, str(tmp_path / "b")))


def test_a_partial_batch_adds_to_its_day(spark, tmp_path):
    first, second = some_readings(spark, 1.0, 3.0), some_readings(spark, 0.0, 0.0, 5.0).offset(2)
    for batch in (first, second):
        run = monitoring.update_monitoring(spark, batch, str(tmp_path))
    assert [r.AvgVibration for r in run.tables.read(spark, "daily").collect()] == [3.0]


def test_a_replaced_day_without_usable_readings_is_removed(spark, tmp_path):
    both = some_readings(spark, 1.0, 2.0).union(some_readings(spark, 4.0, day="2027-03-02"))
    monitoring.update_monitoring(spark, both, str(tmp_path))
    unusable = some_readings(spark, -999.0, None)
    run = monitoring.update_monitoring(spark, unusable, str(tmp_path), whole_days=True)
    for name in ("clean", "daily", "flagged", "scored"):
        assert [str(r.Date) for r in run.tables.read(spark, name).collect()] == ["2027-03-02"]
    run = monitoring.update_monitoring(
        spark, some_readings(spark, 7.0, day="2027-03-02"), str(tmp_path), whole_days=True
    )
    assert [r.AvgVibration for r in run.tables.read(spark, "daily").collect()] == [7.0]


def same_tables(rows, spark, run, whole):
    for name in ("clean", "daily", "flagged", "scored", *monitoring.REPORTS):
        one = whole.tables.read(spark, name)
        assert rows(run.tables.read(spark, name).select(*one.columns)) == rows(one), name
    assert run.receipt.counts == whole.receipt.counts and run.receipt.rows == whole.receipt.rows


def test_updates_treat_readings_without_time_as_a_run_does(spark, ramp, tmp_path, rows):
    untimed = F.when((F.hour("Timestamp") != 3) | (F.col("MachineID") % 2 == 0), F.col("Timestamp"))
    readings = ramp.withColumn("Timestamp", untimed)
    whole = monitoring.run_monitoring(spark, readings, str(tmp_path / "whole"))
    assert whole.tables.read(spark, "daily").where("Date IS NULL").count() > 0
    known = F.col("Timestamp").isNotNull()
    for batch in (known & (F.col("MachineID") < 9), ~known, F.col("MachineID") >= 9):
        run = monitoring.update_monitoring(spark, readings.where(batch), str(tmp_path / "parts"))
    same_tables(rows, spark, run, whole)
    one = readings.where("MachineID = 3")
    replaced = monitoring.update_monitoring(spark, one, str(tmp_path / "parts"), whole_days=True)
    same_tables(rows, spark, replaced, monitoring.run_monitoring(spark, one, str(tmp_path / "one")))


@pytest.mark.parametrize(
    "at, whole_days", [("daily_from_clean", False), ("flagged_days", True), ("baseline_zscore", False)]
)
def test_an_update_that_failed_is_taken_up_by_the_next(spark, ramp, tmp_path, rows, monkeypatch, at, whole_days):
    """Whatever table it failed before, and though the next batch has other days."""
    day = F.dayofmonth("Timestamp")
    readings = ramp.where((F.hour("Timestamp") % 8 == 0) & (day <= 12))
    target = str(tmp_path / "parts")
    monitoring.update_monitoring(spark, readings.where(day <= 5), target)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(monitoring, at, fail)
        with pytest.raises(RuntimeError, match="lost"):
            monitoring.update_monitoring(spark, readings.where((day > 5) & (day <= 9)), target)
    run = monitoring.update_monitoring(spark, readings.where(day > 9), target, whole_days=whole_days)
    same_tables(rows, spark, run, monitoring.run_monitoring(spark, readings, str(tmp_path / "whole")))
    assert not tables.table_exists(spark, run.tables.pending)


def test_updates_refuse_sentinels_outside_the_measures(spark, ramp, tmp_path):
    cfg = Monitor(sentinels={"Status": -1.0})
    with pytest.raises(ValueError):
        monitoring.update_monitoring(spark, ramp, str(tmp_path), cfg)
    assert not list(tmp_path.iterdir())


def test_a_run_of_unusable_readings(spark, tmp_path):
    bad = some_readings(spark, -999.0, None)
    for k, act in enumerate((monitoring.run_monitoring, monitoring.update_monitoring)):
        run = act(spark, bad, str(tmp_path / str(k)))
        assert run.receipt.rows == 0
        assert tables.verify_publish(spark, run.receipt).first().Verified
        assert tuple(monitoring.inspect_run(spark, run.tables).first()) == (0, 0, 0)
        assert all(run.tables.read(spark, name).count() == 0 for name in monitoring.REPORTS)


def test_a_publish_of_no_partitions_is_verified(spark, tmp_path):
    receipt = tables.publish(spark.createDataFrame([], DDL), str(tmp_path / "p"), partition_by=["Date"])
    assert tables.verify_publish(spark, receipt).first().Verified


def test_reports_are_whole(spark, ramp, tmp_path):
    fleet = ramp.drop("MachineID").where("hour(Timestamp) = 0").crossJoin(
        spark.range(60).select(F.col("id").cast("int").alias("MachineID"))
    )
    run = monitoring.run_monitoring(spark, fleet.select(ramp.columns), str(tmp_path))
    assert run.tables.read(spark, "worst").count() == 60
    assert run.tables.read(spark, "worst_zscore").count() == 60
    assert [r[0] for r in run.tables.read(spark, "significant").collect()] == list(range(60))


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    head = "MachineID,Timestamp,VibrationVelocity,BearingTemperature,MotorCurrentDraw,RotationalSpeed,Status"
    good = "3,2026-01-01 00:00:00,1.0,50.0,12.0,1460.0,Running"
    lines = [head, good, "3,soon,1.0,50.0,12.0,1460.0,Running", good, "x,y"]
    (tmp_path / "r.csv").write_text("\n".join(lines) + "\n")
    readings, rejects = tables.read_with_rejects(spark, str(tmp_path / "r.csv"))
    assert readings.count() == 2 and readings.columns == READINGS.names
    assert sorted(r.Line for r in rejects.collect()) == sorted([lines[2], lines[4]])
    assert readings.count() + rejects.count() == len(lines) - 1


def test_command_line(spark, ramp, tmp_path, capsys):
    source, target, public = (str(tmp_path / name) for name in ("csv", "out", "public"))
    ramp.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(source, header=True)
    main([source, target, "--publish", public], spark)
    shown = capsys.readouterr().out
    assert "TotalRows: 2880\n" in shown and "FinalRows: 2880\n" in shown
    assert tables.read_table(spark, public).count() == 30
    assert "Verified" in shown and "true" in shown
    assert "significant (whole in" in shown

    # Parquet of another year, and lines that don't fit.
    parquet = str(tmp_path / "parquet")
    ramp.withColumn("Timestamp", F.expr("Timestamp + INTERVAL 1 YEAR")).write.parquet(parquet)
    main([parquet, target, "--parquet", "--no-clean-table"], spark)
    assert "FinalRows" in capsys.readouterr().out
    scored = tables.read_table(spark, f"{target}/scored")
    assert scored.where("ZScore IS NOT NULL").count() == 30
    main([source, target, "--rejects", str(tmp_path / "rejects"), "--update", "days"], spark)
    assert "RejectedLines: 0" in capsys.readouterr().out
