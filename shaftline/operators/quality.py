"""What is in a table and how dirty it is.

Each count is one global aggregate: partial per task, then a single row per
task to merge. Only exact duplicates need a shuffle of rows, and there copies
collapse map-side first, so a row repeated a billion times costs one row per
task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COPIES = "__copies"


def _is_float(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def quoted(name: str) -> Column:
    """The column of just that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``Rows``."""
    return df.agg(F.count(F.lit(1)).alias("Rows"))


def preview(df: DataFrame, n: int, order_by: list[str | Column] | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` a top-n that keeps n rows per task."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and nullability.

    Known without reading a row: the plan holds no scan.
    """
    columns = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema, start=1)
    ]
    return df.sparkSession.createDataFrame(
        columns, "Position int, ColumnName string, DataType string, Nullable boolean"
    )


def table_profile(df: DataFrame) -> DataFrame:
    """``schema_profile`` and ``column_counts`` of a stored table, side by side.

    Types and nullability come from the table as it is stored, if ``df`` was read without
    a pinned schema; rows, nulls and NaNs are counted in one pass over it.
    """
    fields = {
        i: (field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema, start=1)
    }

    def of_field(k: int) -> Column:
        known = F.create_map(*(F.lit(x) for i, own in fields.items() for x in (i, own[k])))
        return F.element_at(known, F.col("Position"))

    return column_counts(df).select(
        "Position",
        "ColumnName",
        of_field(0).alias("DataType"),
        of_field(1).alias("Nullable"),
        "Rows",
        "Nulls",
        "NaNs",
    )


def column_counts(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls and NaNs, in one pass."""
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema):
        column = quoted(field.name)
        counts.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        nans = F.count_if(F.isnan(column)) if _is_float(field) else F.lit(0).cast("bigint")
        counts.append(nans.alias(f"nans_{i}"))
    found = [
        F.struct(
            F.lit(i + 1).alias("Position"),
            F.lit(field.name).alias("ColumnName"),
            F.col("rows").alias("Rows"),
            F.col(f"nulls_{i}").alias("Nulls"),
            F.col(f"nans_{i}").alias("NaNs"),
        )
        for i, field in enumerate(df.schema)
    ]
    return df.agg(*counts).select(F.inline(F.array(*found)))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with, under each column's own name, how many values are null.

    NaN is a value, not a null; ``column_counts`` counts it apart.
    """
    return df.agg(*(F.count_if(quoted(c).isNull()).alias(c) for c in df.columns))


def sentinel_counts(df: DataFrame, sentinels: Mapping[str, float]) -> DataFrame:
    """One row with, per column, how often its sentinel value occurs."""
    return df.agg(*(F.count_if(quoted(c) == F.lit(v)).alias(c) for c, v in sentinels.items()))


def copies_of_rows(df: DataFrame, copies: str = _COPIES) -> DataFrame:
    """Each distinct row once, with how many copies of it there are."""
    return df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias(copies))


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: total, distinct and duplicate rows, from a single shuffle."""
    return (
        copies_of_rows(df)
        .agg(
            F.coalesce(F.sum(_COPIES), F.lit(0)).alias("TotalRows"),
            F.count(F.lit(1)).alias("DistinctRows"),
        )
        .withColumn("DuplicateRows", F.col("TotalRows") - F.col("DistinctRows"))
    )


def weighed_counts(
    columns: Sequence[str], sentinels: Mapping[str, float], copies: str = _COPIES
) -> list[Column]:
    """Aggregates over distinct rows and their ``copies`` that equal counting
    over all rows: rows, distinct rows, nulls per column, sentinels per column."""

    def weighed(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(copies))), F.lit(0))

    return [
        F.coalesce(F.sum(copies), F.lit(0)).alias("TotalRows"),
        F.count(F.lit(1)).alias("DistinctRows"),
        *(weighed(quoted(c).isNull()).alias(f"Null{c}") for c in columns),
        *(weighed(quoted(c) == F.lit(v)).alias(f"Sentinel{c}") for c, v in sentinels.items()),
    ]


def quality_report(df: DataFrame, sentinels: Mapping[str, float]) -> DataFrame:
    """Duplicates, nulls and sentinels of a table in one pass and one shuffle."""
    return (
        copies_of_rows(df)
        .agg(*weighed_counts(df.columns, sentinels))
        .withColumn("DuplicateRows", F.col("TotalRows") - F.col("DistinctRows"))
    )
