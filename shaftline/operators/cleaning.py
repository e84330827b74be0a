"""Removing exact copies, sentinel values and incomplete rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shaftline.config import DEFAULT, Monitor
from shaftline.operators.quality import copies_of_rows, quoted, weighed_counts

_COPIES = "__copies"


def dedup(df: DataFrame) -> DataFrame:
    """Keep one of each group of rows that agree in **every** column.

    The shuffle key is the whole row, so a hot machine or day spreads over all
    partitions, and copies collapse in each task before anything is shuffled.
    """
    return df.dropDuplicates()


def sentinel_to_null(df: DataFrame, sentinels: Mapping[str, float]) -> DataFrame:
    """Turn each column's sentinel value into null."""
    return df.withColumns({c: F.nullif(quoted(c), F.lit(v)) for c, v in sentinels.items()})


def drop_incomplete(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Drop rows in which any of ``measures`` is null or NaN."""
    return df.where(_whole(df, measures))


def _whole(df: DataFrame, measures: Sequence[str]) -> Column:
    """Whether none of ``measures`` is null or NaN.

    Spark orders NaN above infinity, so ``<= inf`` is one plain comparison,
    known to the file scan, that neither NaN nor null meets. The condition is
    null, not false, for a null measure.
    """
    conditions = [F.lit(True)]
    for name in measures:
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            conditions.append(quoted(name) <= F.lit(float("inf")))
        else:
            conditions.append(quoted(name).isNotNull())
    return reduce(lambda a, b: a & b, conditions)


def usable(df: DataFrame, cfg: Monitor = DEFAULT) -> Column:
    """Whether a row has every measure, none of them NaN or its sentinel."""
    measured = [name for name in cfg.measures if name in cfg.sentinels]
    sentinels = (quoted(name) != F.lit(cfg.sentinels[name]) for name in measured)
    return reduce(lambda a, b: a & b, sentinels, _whole(df, cfg.measures))


def _other_sentinels(cfg: Monitor) -> dict[str, float]:
    return {c: v for c, v in cfg.sentinels.items() if c not in cfg.measures}


def clean(df: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """Remove exact copies, blank sentinels, drop incomplete rows - in that order.

    Equal to ``drop_incomplete(sentinel_to_null(dedup(df)))``. Whether a row
    survives depends on that row alone, so unusable rows are filtered *before*
    the shuffle with comparisons the file scan understands; the survivors hold
    no sentinel in a measure, and only sentinels in other columns are blanked.
    """
    distinct = dedup(df.where(usable(df, cfg)))
    others = _other_sentinels(cfg)
    return sentinel_to_null(distinct, others) if others else distinct


def _report(original: Column, distinct: Column, final: Column) -> list[Column]:
    removed = original - final
    return [
        original.alias("OriginalRows"),
        distinct.alias("DedupedRows"),
        final.alias("FinalRows"),
        (original - distinct).alias("DuplicatesRemoved"),
        (distinct - final).alias("IncompleteRemoved"),
        removed.alias("TotalRemoved"),
        F.round(F.try_divide(removed * F.lit(100.0), original), 2).alias("PercentRemoved"),
    ]


def cleaning_report(df: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """One row: rows before, after removing copies and after dropping incomplete
    ones, what each step removed, and the percentage (null for no input)."""
    keep = usable(df, cfg).alias("keep")
    copies = copies_of_rows(df, _COPIES)
    return (
        copies.select(_COPIES, keep)
        .agg(
            F.coalesce(F.sum(_COPIES), F.lit(0)).alias("original"),
            F.count(F.lit(1)).alias("distinct"),
            F.count_if("keep").alias("final"),
        )
        .select(*_report(F.col("original"), F.col("distinct"), F.col("final")))
    )


def both_reports(df: DataFrame, cfg: Monitor = DEFAULT) -> DataFrame:
    """``quality_report`` and ``FinalRows`` in one row, from one pass and one shuffle."""
    keep = usable(df, cfg)
    return (
        copies_of_rows(df, _COPIES)
        .agg(*weighed_counts(df.columns, cfg.sentinels, _COPIES), F.count_if(keep).alias("FinalRows"))
        .withColumn("DuplicateRows", F.col("TotalRows") - F.col("DistinctRows"))
    )


def clean_and_observe(
    df: DataFrame, observation: Observation, cfg: Monitor = DEFAULT
) -> DataFrame:
    """``clean`` whose one action also counts what it found and removed.

    Once the returned frame has been written, ``observation`` has the counts
    of ``quality_report`` and ``FinalRows``; it stays empty for no rows. They
    are counted behind the shuffle, in the stage that writes, so a recomputed
    shuffle stage does not count twice. Unusable rows travel through the
    shuffle to be counted, which saves a second read of the raw data.
    """
    keep = usable(df, cfg)
    cleaned = (
        copies_of_rows(df, _COPIES)
        .observe(
            observation,
            *weighed_counts(df.columns, cfg.sentinels, _COPIES),
            F.count_if(keep).alias("FinalRows"),
        )
        .where(keep)
        .drop(_COPIES)
    )
    others = _other_sentinels(cfg)
    return sentinel_to_null(cleaned, others) if others else cleaned
