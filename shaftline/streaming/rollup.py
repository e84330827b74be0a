"""Daily averages of readings that arrive file by file.

Two streams, one behind the other. The first takes new files and divides their rows by a
watermark: rows in time go on, rows too late are kept in a table of their own instead of being
lost. The second removes copies and averages per machine and day; Spark's state store holds what
days within the watermark have seen so far. Both write one folder per batch and replace it
if a batch is run again, so that a restart adds nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shaftline.config import DEFAULT, READINGS, Monitor
from shaftline.functions.averages import rounded_average
from shaftline.operators.cleaning import usable
from shaftline.operators.ordering import seconds
from shaftline.sources.tables import table_exists

_BATCH, _KIND, _FRESH, _LATE = "batch", "kind", "fresh", "late"
_LEDGER = "batch bigint, latest timestamp_ntz, fresh bigint, late bigint"


@dataclass(frozen=True)
class Stream:
    """Where a stream keeps its tables, and how late a reading may be.

    A row is late if it is more than ``delay`` older than the latest reading of all
    batches before its own; rows without time are kept with the late ones. ``target`` is a
    folder that all executors share.
    """

    target: str
    schema: T.StructType = READINGS
    delay: str = "2 days"
    files_per_batch: int = 100
    cfg: Monitor = DEFAULT

    @property
    def rows(self) -> str:
        return f"{self.target}/rows"

    @property
    def ledger(self) -> str:
        return f"{self.target}/ledger"

    @property
    def daily(self) -> str:
        return f"{self.target}/daily"

    def checkpoint(self, name: str) -> str:
        return f"{self.target}/checkpoints/{name}"


def _ledger(spark: SparkSession, stream: Stream) -> DataFrame:
    if not table_exists(spark, stream.ledger):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).option("recursiveFileLookup", True).parquet(stream.ledger)


def watermark(spark: SparkSession, stream: Stream, batch: int) -> Column:
    """Time before which rows of ``batch`` are late; null for the first one."""
    latest = _ledger(spark, stream).where(F.col("batch") < batch).agg(F.max("latest")).first()[0]
    return F.lit(latest).cast("timestamp_ntz") - F.expr(f"INTERVAL {seconds(stream.delay)} SECONDS")


def _divide(rows: DataFrame, batch: int, stream: Stream) -> None:
    """Store a batch in two parts, and what it was in the ledger."""
    spark, time = rows.sparkSession, F.col(f"`{stream.cfg.time}`")
    late = time.isNull() | F.coalesce(time < watermark(spark, stream, batch), F.lit(False))
    folder = f"{stream.rows}/{_BATCH}={batch}"
    kinds = rows.withColumn(_KIND, F.when(late, _LATE).otherwise(_FRESH))
    kinds.write.mode("overwrite").partitionBy(_KIND).parquet(folder)
    stored = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField(_KIND, T.StringType())])).parquet(folder)
    counted = stored.agg(
        F.lit(batch).cast("bigint").alias("batch"),
        F.max(time).cast("timestamp_ntz").alias("latest"),
        F.count_if(F.col(_KIND) == _FRESH).alias("fresh"),
        F.count_if(F.col(_KIND) == _LATE).alias("late"),
    )
    counted.write.mode("overwrite").parquet(f"{stream.ledger}/{_BATCH}={batch}")


def accept(files: DataFrame, stream: Stream) -> StreamingQuery:
    """Divide a stream of readings into rows in time and late ones, batch by batch.

    The watermark of a batch is that of the batches before it, as the ledger has them, so a batch that
    is run again after a failure is divided as it was.
    """
    return (
        files.writeStream.foreachBatch(lambda rows, batch: _divide(rows, batch, stream))
        .option("checkpointLocation", stream.checkpoint("accept"))
        .trigger(availableNow=True)
        .start()
    )


def roll_up(spark: SparkSession, stream: Stream) -> StreamingQuery:
    """Average the rows in time per key and day; each batch stores the days it changed.

    Copies are removed among the rows of the days that are still open. State leaves the store once the
    watermark has passed its day. Averages are the exact ones of ``daily_average``. Spark cuts windows at
    midnight UTC, so that has to be the session's time zone.
    """
    cfg = stream.cfg
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError("set spark.sql.session.timeZone to UTC")
    day = F.window(cfg.time, "1 day")
    averages = [rounded_average(m.source, m.decimals, cfg.exact_averages).alias(m.name) for m in cfg.daily_measures]
    fresh = (
        spark.readStream.schema(stream.schema)
        .option("maxFilesPerTrigger", stream.files_per_batch)
        .parquet(f"{stream.rows}/{_BATCH}=*/{_KIND}={_FRESH}")
    )
    daily = (
        fresh.where(usable(fresh, cfg))
        .withColumn(cfg.time, F.col(f"`{cfg.time}`").cast("timestamp"))
        .withWatermark(cfg.time, stream.delay)
        .dropDuplicates()
        .groupBy(F.col(cfg.key), day.alias("day"))
        .agg(*averages)
        .select(cfg.key, F.to_date("day.start").alias(cfg.date), *(m.name for m in cfg.daily_measures))
    )

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{stream.daily}/{_BATCH}={batch}")

    return (
        daily.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", stream.checkpoint("roll-up"))
        .trigger(availableNow=True)
        .start()
    )


def advance(spark: SparkSession, source: str, stream: Stream, kind: str = "parquet") -> None:
    """Take in the files that came to ``source`` since the last call, to the end.

    Safe to call again after a failure or without new files.
    """
    files = (
        spark.readStream.format(kind)
        .schema(stream.schema)
        .option("maxFilesPerTrigger", stream.files_per_batch)
        .load(source)
    )
    accept(files, stream).awaitTermination()
    if not table_exists(spark, stream.ledger):
        return
    if _ledger(spark, stream).where("fresh > 0").isEmpty():
        return
    roll_up(spark, stream).awaitTermination()


def streamed_daily(spark: SparkSession, stream: Stream) -> DataFrame:
    """Key, day and averages as the latest batch that changed them stored them."""
    cfg = stream.cfg
    names = [m.name for m in cfg.daily_measures]
    fields = [stream.schema[cfg.key], T.StructField(cfg.date, T.DateType())]
    fields += [T.StructField(n, T.DoubleType()) for n in names]
    schema = T.StructType([*fields, T.StructField(_BATCH, T.LongType())])
    if not table_exists(spark, stream.daily):
        return spark.createDataFrame([], schema).drop(_BATCH)
    changes = spark.read.schema(schema).parquet(stream.daily)
    last = F.max_by(F.struct(*names), F.col(_BATCH)).alias("last")
    return changes.groupBy(cfg.key, cfg.date).agg(last).select(cfg.key, cfg.date, "last.*")


def late_rows(spark: SparkSession, stream: Stream) -> DataFrame:
    """Rows that came after the watermark had passed them, with their batch."""
    fields = [*stream.schema.fields, T.StructField(_BATCH, T.LongType()), T.StructField(_KIND, T.StringType())]
    if not table_exists(spark, stream.rows):
        return spark.createDataFrame([], T.StructType(fields)).drop(_KIND)
    rows = spark.read.schema(T.StructType(fields)).parquet(stream.rows)
    return rows.where(F.col(_KIND) == _LATE).drop(_KIND)
