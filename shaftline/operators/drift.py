"""Slow changes of each machine: moving average and cumulative sums, reading by reading.

Both are recurrences over all readings of a key. What a slice of time does to them is
a small map: the average becomes ``a * before + b``, a sum ``max(c, before + d)``, or, after a
restart, a constant. Slices are summed up as such maps, the maps are applied one after the
other per key, and each slice is then followed through from its own start. So a key
that owns most readings spreads over its slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shaftline.config import DEFAULT, Monitor
from shaftline.operators.ordering import SLICE, microseconds, time_slice


@dataclass(frozen=True)
class Drift:
    """``weight`` of a new reading in the moving average; the sums add what exceeds ``target`` by
    more than ``slack``, upwards and downwards."""

    target: float
    slack: float
    weight: float = 0.2


State = tuple[float | None, float, float]
_START: State = (None, 0.0, 0.0)


def follow(values: list[float | None], restarts: list[bool], state: State, drift: Drift) -> Iterator[State]:
    """The recurrences themselves, from ``state`` on. A restart forgets everything
    before its reading; a reading without value changes nothing."""
    average, up, down = state
    keep = 1.0 - drift.weight
    for value, restart in zip(values, restarts):
        if restart:
            average, up, down = _START
        if value is not None:
            average = value if average is None else keep * average + drift.weight * value
            above = value - drift.target
            up = max(0.0, up + above - drift.slack)
            down = max(0.0, down - above - drift.slack)
        yield average, up, down


_MAP = "a double, b double, fresh double, up double, up_least double, down double, down_least double, constant boolean"


def slice_map(values: list[float | None], restarts: list[bool], drift: Drift) -> dict[str, object]:
    """What a slice does to any state before it.

    ``fresh`` is the average if there was none, null if there is still none.
    """
    average, up, down = _START
    for average, up, down in follow(values, restarts, _START, drift):
        pass
    told = [v for v in values if v is not None]
    constant = any(restarts)
    keep = 1.0 - drift.weight
    moved = 0.0
    for value in told:
        moved = keep * moved + drift.weight * value
    over = sum(v - drift.target - drift.slack for v in told)
    under = sum(drift.target - v - drift.slack for v in told)
    return {
        "a": keep ** len(told), "b": moved, "fresh": average,
        "up": over, "up_least": up, "down": under, "down_least": down, "constant": constant,
    }


def apply_map(state: State, change: dict[str, object]) -> State:
    average, up, down = state
    if change["constant"]:
        return change["fresh"], change["up_least"], change["down_least"]
    return (
        change["fresh"] if average is None else change["a"] * average + change["b"],
        max(change["up_least"], up + change["up"]),
        max(change["down_least"], down + change["down"]),
    )


def _values(column: pa.ChunkedArray) -> list[float | None]:
    numbers = column.to_numpy()
    missing = np.isnan(numbers)
    return [None if m else v for v, m in zip(numbers.tolist(), missing.tolist())]


def drift(
    readings: DataFrame,
    value: str,
    settings: Drift,
    restart: Column | None = None,
    width: int = SLICE,
    cfg: Monitor = DEFAULT,
) -> DataFrame:
    """Key, time and ``value`` of every reading with ``Ewma``, ``CusumUp`` and ``CusumDown``.

    Readings of a key go by time, equal times by value and then those that do not ``restart``
    first. NaN and null values change nothing and keep what was before them; ``Ewma`` is null until a
    first value. Readings without key or time are left out. Of slices, one row per key and slice
    is followed in order; the calendar bounds their number.
    """
    key, time = F.col(f"`{cfg.key}`"), F.col(f"`{cfg.time}`")
    restarts = F.coalesce(restart, F.lit(False)) if restart is not None else F.lit(False)
    measured = F.col(f"`{value}`").cast("double")
    timed = readings.where(key.isNotNull() & time.isNotNull()).select(
        key.alias("key"), time_slice(time, width).alias("slice"), microseconds(time).alias("at"),
        time.alias("t"), F.coalesce(measured, F.lit(float("nan"))).alias("v"), restarts.alias("r"),
        measured.alias("kept"),
    )
    key_type = timed.schema["key"].dataType.simpleString()
    time_type = timed.schema["t"].dataType.simpleString()
    order = [("at", "ascending"), ("v", "ascending"), ("r", "ascending")]

    def to_map(group: pa.Table) -> pa.Table:
        group = group.sort_by(order)
        made = slice_map(_values(group["v"]), group["r"].to_pylist(), settings)
        return pa.table({"key": group["key"][:1], "slice": group["slice"][:1], **{k: pa.array([v], pa.bool_() if k == "constant" else pa.float64()) for k, v in made.items()}})

    maps = timed.select("key", "slice", "at", "v", "r").groupBy("key", "slice").applyInArrow(
        to_map, f"key {key_type}, slice bigint, {_MAP}"
    )

    def through(group: pa.Table) -> pa.Table:
        group = group.sort_by("slice")
        state, before = _START, []
        for change in group.to_pylist():
            before.append(state)
            state = apply_map(state, change)
        averages, ups, downs = zip(*before)
        return pa.table({"key": group["key"], "slice": group["slice"],
                         "average": pa.array(averages, pa.float64()), "up": pa.array(ups, pa.float64()), "down": pa.array(downs, pa.float64())})

    starts = maps.groupBy("key").applyInArrow(
        through, f"key {key_type}, slice bigint, average double, up double, down double"
    )
    # The starts of slices under names of their own: both sides come from one table.
    starts = starts.select(F.col("key").alias("k"), F.col("slice").alias("s"), "average", "up", "down")

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(order)
        state = tuple(right[c][0].as_py() for c in ("average", "up", "down"))
        states = follow(_values(left["v"]), left["r"].to_pylist(), state, settings)
        averages, ups, downs = zip(*states)
        return pa.table({"key": left["key"], "t": left["t"], "kept": left["kept"],
                         "Ewma": pa.array(averages, pa.float64()), "CusumUp": pa.array(ups, pa.float64()), "CusumDown": pa.array(downs, pa.float64())})

    followed = timed.groupBy("key", "slice").cogroup(starts.groupBy("k", "s")).applyInArrow(
        walk, f"key {key_type}, t {time_type}, kept double, Ewma double, CusumUp double, CusumDown double"
    )
    return followed.select(
        F.col("key").alias(cfg.key), F.col("t").alias(cfg.time), F.col("kept").alias(value),
        "Ewma", "CusumUp", "CusumDown",
    )
