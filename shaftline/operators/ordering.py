"""Slices of time, so that what has to be read in order is not all of one key.

A key can own a third of all readings. Operators that follow each key through time
therefore work on slices (key, span of time), and carry a few values per slice from one to the
next in a second, small pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of a slice: what a task holds of one key at a time.
SLICE = 86_400


def seconds(duration: str | int) -> int:
    """Whole seconds of durations like ``'90 minutes'``, ``'1 day'`` or ``3600``."""
    if isinstance(duration, int):
        return duration
    units = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}
    number, unit = duration.split()
    return int(number) * units[unit.rstrip("s")]


def microseconds(time: Column) -> Column:
    """Microseconds since 1970 of a timestamp or date; one without zone is read in the
    session's."""
    return F.unix_micros(time.cast("timestamp"))


def time_slice(time: Column, width: int) -> Column:
    """Number of the slice of ``width`` seconds that a time is in."""
    return F.floor(microseconds(time) / F.lit(width * 1_000_000)).cast("bigint")
