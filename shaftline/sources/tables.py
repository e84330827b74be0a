"""Reading sensor files, and storing and publishing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shaftline.config import READINGS


def read_readings(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = READINGS,
    infer: bool = False,
    mode: str = "FAILFAST",
    timestamp_format: str | None = None,
) -> DataFrame:
    """CSV readings with a header.

    The schema is declared, which saves the extra pass inference makes over
    the files; the header is checked against it, and a malformed value fails
    the read instead of turning into a null that cleaning would drop
    (``mode="PERMISSIVE"`` turns that off). ``infer=True`` takes types from
    the data. ``timestamp_format`` is only needed for times that are not
    written as ``2026-01-31 12:30:00``, with or without fractions.
    """
    reader = spark.read.option("header", True)
    if timestamp_format is not None:
        reader = reader.option("timestampFormat", timestamp_format)
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("mode", mode).option("enforceSchema", False).csv(path)


REJECT = "Line"


def read_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = READINGS,
    timestamp_format: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """CSV readings, and the lines that don't fit the schema, as text.

    A malformed line neither ends the read nor turns into nulls: it is in the
    second frame, with one column ``Line``. Each frame is a scan of its own.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", REJECT)
    if timestamp_format is not None:
        reader = reader.option("timestampFormat", timestamp_format)
        reader = reader.option("timestampNTZFormat", timestamp_format)
    lines = reader.schema(T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())]))
    parsed = lines.csv(path)
    # Spark parses, and so rejects, only columns that are used; this, always true,
    # uses all of them.
    everything = (F.col(f"`{c}`").cast("string") for c in schema.names)
    beside = F.length(F.concat_ws("", *everything)) >= 0
    good = parsed.where(F.col(REJECT).isNull() & beside)
    bad = parsed.where(F.col(REJECT).isNotNull() & beside)
    return good.select(*(f"`{c}`" for c in schema.names)), bad.select(REJECT)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A stored Parquet table; ``schema`` pins types and order of its columns."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# The name Spark gives to the partition of null.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system for ``path``, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[object]) -> None:
    """Delete the partitions of these values, where there are any.

    Writing only given partitions leaves those alone that no row is left for. ``None``
    is the partition of rows without a value.
    """
    for value in values:
        named = _NO_VALUE if value is None else value
        drop_table(spark, f"{path}/{column}={named}")


def drop_table(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def _laid_out(
    df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], arrange: bool
) -> DataFrame:
    """Rows of one partition value together, in files of the advised size.

    Rebalancing lets adaptive execution merge small partition values and split
    a large one over several tasks; a plain repartition would write it in one.
    """
    if partition_by and arrange:
        df = df.hint("rebalance", *partition_by)
    order = [*partition_by, *sort_by]
    return df.sortWithinPartitions(*order) if order else df


def _save(
    df: DataFrame, path: str, partition_by: Sequence[str], only_given_partitions: bool = False
) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if only_given_partitions else "static"
        )
    writer.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    arrange: bool = True,
    only_given_partitions: bool = False,
) -> None:
    """Replace the Parquet table at ``path``.

    Without ``partition_by`` rows stay where they are: no shuffle. With it they
    are brought together by partition value, unless ``arrange=False`` says they
    already are, as when they come row by row from a table partitioned alike.
    ``only_given_partitions`` replaces just the partition values ``df`` has.
    Rows are never sorted globally.
    """
    if only_given_partitions and not partition_by:
        raise ValueError("only_given_partitions needs partition_by")
    arranged = _laid_out(df, partition_by, sort_by, arrange)
    _save(arranged, path, partition_by, only_given_partitions)


@dataclass(frozen=True)
class Receipt:
    """What one publish wrote: its address, the row count, further counts, and the
    schema, without which a publish of no rows could not be read back."""

    uri: str
    rows: int
    counts: Mapping[str, int]
    schema: T.StructType | None = None


def publish(
    df: DataFrame,
    uri: str,
    counts: Mapping[str, Column] | None = None,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    arrange: bool = True,
) -> Receipt:
    """Replace the table at any Hadoop file-system URI and count what was written.

    One job writes and counts: rows, and for each entry of ``counts`` the rows
    meeting its condition. Counting happens in the stage that writes, so a
    retried task or a lost executor does not count twice. Files of an earlier
    publish do not survive. The layout is as in ``write_table``.
    """
    conditions = dict(counts or {})
    observation = Observation()
    observed = _laid_out(df, partition_by, sort_by, arrange).observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(condition).alias(f"n_{name}") for name, condition in conditions.items()),
    )
    _save(observed, uri, partition_by)
    seen = observation.get
    return Receipt(uri, seen.get("rows", 0), {n: seen.get(f"n_{n}", 0) for n in conditions}, df.schema)


def verify_publish(
    spark: SparkSession, receipt: Receipt, counts: Mapping[str, Column] | None = None
) -> DataFrame:
    """Read a publish back and compare it with its receipt.

    One row: found and expected rows, the same for each of ``counts``, and
    ``Verified``. The counts are of the contents, so a marker file left by an
    older run proves nothing.
    """
    conditions = dict(counts or {})
    missing = set(conditions) - set(receipt.counts)
    if missing:
        raise ValueError(f"the receipt has no count of {sorted(missing)}")
    found = read_table(spark, receipt.uri, receipt.schema).agg(
        F.count(F.lit(1)).alias("Rows"),
        *(F.count_if(condition).alias(name) for name, condition in conditions.items()),
    )
    expected = {"Rows": receipt.rows} | {name: receipt.counts[name] for name in conditions}
    verified = F.lit(True)
    for name, value in expected.items():
        verified = verified & (F.col(name) == F.lit(value))
    return found.select(
        "*",
        *(F.lit(value).cast("bigint").alias(f"Expected{name}") for name, value in expected.items()),
        verified.alias("Verified"),
    )
