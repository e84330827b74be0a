"""Label ladders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def grade(
    value: Column,
    steps: Sequence[tuple[float, str]],
    otherwise: str,
    side: str,
) -> Column:
    """Label ``value`` by the first step whose bound it meets.

    ``side="le"`` reads bounds as inclusive upper limits (steps ascending),
    ``side="ge"`` as inclusive lower limits (steps descending). A null value
    meets no bound and takes the ``otherwise`` label, and so does NaN for
    ``"le"``; Spark orders NaN above every number, so for ``"ge"`` NaN meets
    the first bound.
    """
    if side not in ("le", "ge"):
        raise ValueError(f"side must be 'le' or 'ge', not {side!r}")
    if not steps:
        raise ValueError("a ladder needs at least one step")
    bounds = [bound for bound, _ in steps]
    if bounds != sorted(bounds, reverse=side == "ge"):
        raise ValueError(f"steps are out of order for side={side!r}: {bounds}")

    def meets(bound: float) -> Column:
        return value <= F.lit(bound) if side == "le" else value >= F.lit(bound)

    (first, label), *rest = steps
    ladder = F.when(meets(first), F.lit(label))
    for bound, label in rest:
        ladder = ladder.when(meets(bound), F.lit(label))
    return ladder.otherwise(F.lit(otherwise))
