"""Each row with the latest earlier row of another table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shaftline.operators.ordering import SLICE, microseconds, time_slice

_STATE, _ROW, _AT, _SLICE, _SIDE = "__state", "__row", "__at", "__slice", "__side"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    tolerance: int | None = None,
    width: int = SLICE,
) -> DataFrame:
    """Every row of ``left`` with the columns of the row of ``right`` that has its ``key`` and
    the latest ``right_time`` not after its ``left_time``.

    Of rows of ``right`` with one key and time the greatest by its other columns, in their order,
    counts. With ``tolerance`` a row more than so many seconds older does not. Rows of ``left`` without match, key
    or time keep nulls; repeated rows stay repeated. Columns of ``right`` must have names of their own but for ``key``.

    Both tables are merged in slices of ``width`` seconds of a key, which spreads a key that owns
    most of the rows. The last row of ``right`` in each slice is carried forward to the slices
    behind it; that pass has one row per key and slice.
    """
    clashing = (set(left.columns) & set(right.columns)) - {key}
    if clashing:
        raise ValueError(f"columns of both tables: {sorted(clashing)}")
    extra = [c for c in right.columns if c != key]
    tied = [right_time, *(c for c in extra if c != right_time)]
    state = F.struct(*(F.col(f"`{c}`") for c in tied))

    placed = F.col(f"`{key}`").isNotNull() & F.col(f"`{left_time}`").isNotNull()
    whole = left.select(
        F.col(f"`{key}`").alias(key),
        F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias(_ROW),
        placed.alias("__placed"),
        microseconds(F.col(f"`{left_time}`")).alias(_AT),
        time_slice(F.col(f"`{left_time}`"), width).alias(_SLICE),
    )
    rows = whole.where("__placed").drop("__placed")
    states = right.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{right_time}`").isNotNull()).select(
        F.col(f"`{key}`").alias(key),
        state.alias(_STATE),
        microseconds(F.col(f"`{right_time}`")).alias(_AT),
        time_slice(F.col(f"`{right_time}`"), width).alias(_SLICE),
    )
    none = F.lit(None)
    row_type, state_type = whole.schema[_ROW].dataType, states.schema[_STATE].dataType

    # One row per key and slice: the last state in it, and the one carried into it.
    ends = states.groupBy(key, _SLICE).agg(F.max(F.struct(_AT, _STATE)).alias("end"))
    asked = rows.select(key, _SLICE).distinct()
    slices = ends.join(asked.withColumn("asked", F.lit(True)), [key, _SLICE], "full")
    earlier = Window.partitionBy(key).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slices.withColumn("carried", F.last("end", ignorenulls=True).over(earlier))
        .where("asked AND carried IS NOT NULL")
        .select(key, _SLICE, F.col(f"carried.{_STATE}").alias(_STATE), F.col(f"carried.{_AT}").alias(_AT))
    )

    merged = (
        rows.select(key, _SLICE, _AT, F.lit(1).alias(_SIDE), _ROW, none.cast(state_type).alias(_STATE))
        .unionByName(
            states.unionByName(carried).select(
                key, _SLICE, _AT, F.lit(0).alias(_SIDE), none.cast(row_type).alias(_ROW), _STATE
            )
        )
    )
    so_far = (
        Window.partitionBy(key, _SLICE)
        .orderBy(_AT, _SIDE, _STATE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = merged.withColumn("found", F.last(_STATE, ignorenulls=True).over(so_far)).where(F.col(_SIDE) == 1)
    if tolerance is not None:
        age = F.col(_AT) - microseconds(F.col("found")[right_time])
        found = found.withColumn("found", F.when(age <= tolerance * 1_000_000, F.col("found")))
    apart = whole.where("NOT __placed").select(_ROW, none.cast(state_type).alias("found"))
    both = found.select(_ROW, "found").unionByName(apart)
    return both.select(
        *(F.col(_ROW)[c].alias(c) for c in left.columns), *(F.col("found")[c].alias(c) for c in extra)
    )
