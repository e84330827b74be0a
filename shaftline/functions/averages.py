"""Averages that do not depend on the order rows are summed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readings that are a whole number of units below this are counted as longs.
_MOST_UNITS = float(2**43)
# Low bits are summed apart from high bits, so that neither sum outgrows a long
# before a group has 2**40 readings; Spark raises an error if one ever does.
_LOW_BITS = 20
# Other readings below this are summed as decimals of these digits, and so are sums.
_MOST = 1e12
_READING = "decimal(38,18)"
_SUM = "decimal(36,18)"


def rounded_average(column: str, decimals: int, exact: bool = True) -> Column:
    """Aggregate: ``avg(column)`` rounded half-up to ``decimals``.

    A sum of doubles changes in its last bits with the order of the tasks, so
    an average that lies on a rounding tie can come out differently after a
    retry. The exact form adds every reading with its own decimal value, to 18
    decimals, and rounds once, the mean. A reading that is a whole number of
    ``10 ** -decimals`` is added as a long and any other as a decimal: the same
    value either way, only faster as a long. NaN and infinities follow IEEE
    arithmetic.

    No reading ends a job. A group with a reading of 1e12 or more (but for whole numbers of
    units below 2**43), or whose sum is 1e18 or more, gets the average of doubles, whose last
    digits are not exact; null, if its decimals add up to more than 1e20.

    ``exact=False`` is the plain ``round(avg(column))``.
    """
    reading = F.col(column).cast("double")
    if not exact:
        return F.round(F.avg(reading), decimals)

    scale = float(10**decimals)
    rounded = F.rint(reading * F.lit(scale))
    # The double nearest to the whole number of units is the reading itself.
    whole = (F.abs(rounded) < F.lit(_MOST_UNITS)) & (rounded / F.lit(scale) == reading)
    units = F.when(whole, rounded.cast("bigint"))
    high = F.sum(F.shiftright(units, _LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit(2**_LOW_BITS - 1).cast("bigint")))
    small = F.abs(reading) < F.lit(_MOST)
    others = F.try_sum(F.when(small & ~whole, reading.cast(_READING)))
    n_others = F.count_if(small & ~whole)
    odd = F.sum(F.when(~small & ~whole, reading))

    unit = F.lit(f"{10**-decimals:.{decimals}f}").cast(f"decimal({decimals + 1},{decimals})")
    counted = high.cast("decimal(20,0)") * F.lit(2**_LOW_BITS) + low
    # Null where it is 1e18 or more, or where the decimals have overflowed.
    total = F.when(high.isNull(), F.lit(0).cast(_SUM)).otherwise(
        (counted * unit).try_cast(_SUM)
    ) + F.when(n_others == 0, F.lit(0).cast(_SUM)).otherwise(others.try_cast(_SUM))
    plain = F.coalesce(counted.cast("double") / F.lit(scale), F.lit(0.0)) + F.when(
        n_others == 0, F.lit(0.0)
    ).otherwise(others.cast("double"))
    n = F.nullif(F.count(reading), F.lit(0))
    # The mean is total / readings; in units, total / step. Bound by a lambda, they
    # are not spelled out, and compiled, once for each time they are used.
    found = F.struct(
        total.alias("total"),
        (n.cast("decimal(20,0)") * unit).alias("step"),
        odd.alias("odd"),
        plain.alias("plain"),
        n.alias("n"),
    )
    return F.element_at(F.transform(F.array(found), lambda sums: _mean(sums, decimals)), 1)


def _mean(sums: Column, decimals: int) -> Column:
    total, step, odd = sums["total"], sums["step"], sums["odd"]
    below = F.call_function("div", total, step)
    away = F.when(2 * F.abs(total % step) >= step, F.signum(total).cast("bigint")).otherwise(0)
    inexact = (sums["plain"] + F.coalesce(odd, F.lit(0.0))) / sums["n"]
    return F.when(odd.isNotNull() | total.isNull(), F.round(inexact, decimals)).otherwise(
        (below + away) / F.lit(float(10**decimals))
    )
