"""Rows that lie in intervals of another table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shaftline.operators.ordering import microseconds

_LEVEL, _BIN = "__level", "__bin"
# Each level of bins is so many times as wide as the one below it.
_STEP = 8
_LEVELS = 20
_WIDEST = 4e18
# An interval is filed at most so many levels below its own: in up to 513 bins.
_LOWER = 3


def _width(level: Column, base: int) -> Column:
    return F.least(F.lit(float(base)) * F.pow(F.lit(float(_STEP)), level), F.lit(_WIDEST)).cast("bigint")


def typical_length(intervals: DataFrame, start: str, end: str) -> int:
    """Microseconds that half of the intervals are no longer than; one at least."""
    length = microseconds(F.col(f"`{end}`")) - microseconds(F.col(f"`{start}`"))
    middle = intervals.agg(F.percentile_approx(F.when(length > 0, length), 0.5).alias("middle")).first()[0]
    return max(1, int(middle or 1))


def filing_levels(found: Mapping[int, tuple[int, float]], points: int, base: int) -> dict[int, int]:
    """The level at which the intervals of each level are filed, so that fewest rows meet.

    ``found`` has number and summed length of the intervals of each level. A level costs a copy of each of
    the ``points``; intervals filed below their own level cost a copy for each of its bins they are in.
    """

    def copies(level: int, at: int) -> float:
        n, length = found[level]
        return n + length / min(float(base) * _STEP**at, _WIDEST)

    levels = sorted(found)
    # The least cost of all levels below the k-th, and the way they are filed.
    least: list[tuple[float, dict[int, int]]] = [(0.0, {})]
    for k in range(1, len(levels) + 1):
        ways = []
        for i in range(k):
            if levels[k - 1] - levels[i] <= _LOWER:
                cost, filed = least[i]
                cost += points + sum(copies(level, levels[i]) for level in levels[i:k])
                ways.append((cost, {**filed, **{level: levels[i] for level in levels[i:k]}}))
        least.append(min(ways, key=lambda way: way[0]))
    return least[-1][1]


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    time: str,
    start: str,
    end: str,
    closed: bool = False,
    base: int | None = None,
) -> DataFrame:
    """Each row of ``points`` beside each row of ``intervals`` whose ``start`` is at or before its
    ``time`` and whose ``end`` is after it (or, ``closed``, at it), for equal columns ``on``, if any.

    An interval is filed in bins about as wide as itself, which are at most two: the typical
    length (``base`` microseconds, measured if not given) is the narrowest, and each level of
    bins is eight times as wide. A point looks into one bin of each level that is in use. So every pair
    is met once, and a key that owns most rows spreads over its bins. Where the intervals of a level are few
    beside the points, which are counted for that, they are filed in more of the narrower bins of a level
    below instead, and points have no copy for theirs (``filing_levels``). Rows with a null among ``on``, ``time``, ``start`` or ``end``, and
    intervals that end before they start, match nothing. Repeated rows match each for themselves.
    Other columns must have names of their own.
    """
    clashing = (set(points.columns) & set(intervals.columns)) - set(on)
    if clashing:
        raise ValueError(f"columns of both tables: {sorted(clashing)}")
    base = base or typical_length(intervals, start, end)
    at, low, high = (microseconds(F.col(f"`{c}`")) for c in (time, start, end))

    level = F.greatest(F.lit(0), F.ceil(F.log(F.greatest((high - low) / F.lit(base), F.lit(1.0))) / F.log(F.lit(float(_STEP)))))
    # Logarithms are rounded: no interval may be longer than its bin.
    level = level + F.when(_width(level, base) < high - low, 1).otherwise(0)
    real = (low <= high) if closed else (low < high)
    filed = intervals.where(real).withColumn(_LEVEL, F.least(level, F.lit(_LEVELS)).cast("int"))
    timed = points.where(F.col(f"`{time}`").isNotNull())

    sizes = filed.groupBy(_LEVEL).agg(F.count(F.lit(1)), F.sum((high - low).cast("double")))
    found = {n: (rows, length) for n, rows, length in sizes.collect()}  # _LEVELS + 1 at most
    at_level = filing_levels(found, timed.count() if len(found) > 1 else 0, base)
    lower = {n: to for n, to in at_level.items() if n != to}
    if lower:
        to_level = F.create_map(*(F.lit(n) for pair in lower.items() for n in pair))
        filed = filed.withColumn(_LEVEL, F.coalesce(to_level[F.col(_LEVEL)], _LEVEL))
    width = _width(F.col(_LEVEL), base)
    last = F.floor((high if closed else high - 1) / width).cast("bigint")
    filed = filed.withColumn(_BIN, F.explode(F.sequence(F.floor(low / width).cast("bigint"), last)))

    used = sorted(set(at_level.values()))
    levels = F.array(*(F.lit(n) for n in used)) if used else F.array().cast("array<int>")
    looking = timed.withColumn(_LEVEL, F.explode(levels))
    looking = looking.withColumn(_BIN, F.floor(at / _width(F.col(_LEVEL), base)).cast("bigint"))

    met = looking.join(filed, [*on, _LEVEL, _BIN])
    inside = (low <= at) & ((at <= high) if closed else (at < high))
    return met.where(inside).drop(_LEVEL, _BIN)
