"""What differs between two publishes of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that are in one of the two tables more often than in the other, and ``Copies``: how many
    more there are in ``after``, negative if fewer.

    The positive ones are ``after EXCEPT ALL before``, the negative ones the reverse, from one shuffle by the
    whole row, so no key is hot, and copies are counted before it. Nulls equal each other, and
    so do NaNs. Columns are matched by name; both tables must have the same.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the two tables have different columns")
    if "Copies" in before.columns:
        raise ValueError("a column is named Copies")
    signed = before.withColumn("Copies", F.lit(-1).cast("bigint")).unionByName(
        after.withColumn("Copies", F.lit(1).cast("bigint"))
    )
    columns = [F.col(f"`{c}`") for c in before.columns]
    return signed.groupBy(*columns).agg(F.sum("Copies").alias("Copies")).where("Copies <> 0")


def reconcile(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """``differences`` with ``Change``: 'changed' for rows whose ``key`` has rows on both sides of it, else
    'added' or 'removed'.

    Which keys have both is counted per key, one row each, and joined to the differing rows only; nulls in a key
    equal each other.
    """
    rows = differences(before, after)
    names = [F.col(f"`{c}`") for c in key]
    mark = F.struct(*names).alias("__key")
    both = (
        rows.groupBy(mark)
        .agg(F.min("Copies").alias("least"), F.max("Copies").alias("most"))
        .where("least < 0 AND most > 0")
        .select("__key", F.lit(CHANGED).alias("__both"))
    )
    marked = rows.withColumn("__key", F.struct(*names))
    joined = marked.join(both, marked["__key"].eqNullSafe(both["__key"]), "left")
    side = F.when(F.col("Copies") > 0, ADDED).otherwise(REMOVED)
    return joined.select(*rows.columns, F.coalesce("__both", side).alias("Change"))


def reconcile_counts(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``Change``, its ``Rows`` with copies on either side, and ``Keys``. No row for a change that has none."""
    names = [F.col(f"`{c}`") for c in key]
    per_key = changes.groupBy("Change", *names).agg(F.sum(F.abs("Copies")).alias("rows"))
    return per_key.groupBy("Change").agg(
        F.sum("rows").alias("Rows"), F.count(F.lit(1)).alias("Keys")
    )
