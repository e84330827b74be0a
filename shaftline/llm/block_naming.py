"""Exact duplicates by naming fixed-size blocks.

Texts are cut into blocks of equal size. Blocks get integer names in sorted
order, equal blocks the same one; then pairs of adjacent names are named the same
way, level after level, until each document is one name. Documents are copies
if and only if they have as many blocks and the same last name.

Only DataFrame operations are used. Block contents are shuffled once, when
Spark sorts them to prove that no two different blocks share the 128-bit key
they travel under; should two ever do, the keys are drawn anew. Everything else
moves keys and integers, and each level reads tables the one before has stored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.llm.common import SPACE, keep_documents, stored

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    """White space runs as one space each; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def block_key(block: Column, seed: int) -> Column:
    """128 bits that stand for a block once they are proven to tell blocks apart."""
    return F.struct(
        F.xxhash64(F.lit(2 * seed), block).alias("a"),
        F.xxhash64(F.lit(2 * seed + 1), block).alias("b"),
    )


def _blocks(text: Column, size: int) -> Column:
    """Blocks of the UTF-8 bytes; an empty text is one empty block."""
    raw = text.cast("binary")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / F.lit(size)).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.substring(raw, i * size + 1, F.lit(size))
    )


def _named(keys: DataFrame, columns: list[str], what: str) -> DataFrame:
    """Distinct ``columns`` with integer names in their sorted order."""
    ordered = keys.select(*columns).distinct().orderBy(*columns)
    return stored(ordered.withColumn("name", F.monotonically_increasing_id()), what)


def identities(
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    key: Callable[[Column, int], Column] = block_key,
) -> DataFrame:
    """``row``, ``doc_id``, ``text_sha256``, ``n_blocks`` and ``name`` of every row;
    rows with equal normalised texts, and no others, agree in the last two.

    Every row counts, copies of a row too; ``row`` numbers them. A null text is
    the empty one.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    contents = texts.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block"))
    for seed in count():
        shared = (
            contents.distinct()
            .select(key(F.col("block"), seed).alias("key"))
            .groupBy("key")
            .count()
            .where("count > 1")
        )
        if shared.count() == 0:
            break
    keyed = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        F.transform(_blocks(F.col("text"), block_bytes), lambda b: key(b, seed)).alias("keys"),
    )
    rows = stored(keyed, "block-keys")

    at = rows.select(
        "row", F.size("keys").alias("n_blocks"), F.posexplode("keys").alias("pos", "key")
    ).select("row", "n_blocks", "pos", "key.a", "key.b")
    names = _named(at, ["a", "b"], "block-names")
    named = stored(at.join(names, ["a", "b"]).select("row", "n_blocks", "pos", "name"), "named")
    longest = named.agg(F.max("n_blocks")).first()[0] or 1
    done = [named.where("n_blocks = 1")]
    width = 1
    while width < longest:
        pairs = (
            named.where(F.col("n_blocks") > width)
            .groupBy("row", "n_blocks", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                # The last one of an odd number has no right neighbour.
                F.coalesce(
                    F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)
                ).alias("b"),
            )
        )
        pairs = stored(pairs, "pairs")
        names = _named(pairs, ["a", "b"], "pair-names")
        joined = pairs.join(names, ["a", "b"]).select("row", "n_blocks", "pos", "name")
        named = stored(joined, "named")
        width *= 2
        # Names of different levels may be the same number, but then the
        # documents differ in their number of blocks.
        done.append(named.where((F.col("n_blocks") > width // 2) & (F.col("n_blocks") <= width)))
    whole = done[0]
    for level in done[1:]:
        whole = whole.unionByName(level)
    return rows.drop("keys").join(whole.select("row", "n_blocks", "name"), "row")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.

    Of equal texts the row with the smallest ``doc_id`` stays, one with a null
    id only if there is no other; of rows that share id and text too, one.
    A group of copies is aggregated in each task before it is shuffled, and
    only integers are joined back to its rows, which Spark splits where one
    group has many.
    """
    named = stored(identities(docs, block_bytes), "identities")
    groups = stored(
        named.groupBy("n_blocks", "name").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("keep"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "groups",
    )
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    found = stored(exact_duplicates(docs), "exact-duplicates")
    copies = (
        found.groupBy("doc_id", F.col("text_sha256").alias("text_key"))
        .agg(F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept"))
        .where("kept")
    )
    return keep_documents(docs, copies, F.sha2(normalised(F.col("text")), 256))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text) AS kept,
       sha256(text) AS text_sha256
FROM t
"""
