"""Near duplicates by min-max hashing.

A document is its set of distinct 5-word shingles. Each permutation is evaluated
once and gives two values, the least and the greatest one over the set; three
permutations make a band of six. Documents that agree in a band are candidates:

1. Equal sets are one class. Only classes go on, so copies cost one row a task.
2. In each bucket of a band, every class is compared with the bucket's first.
3. Verified links give components. Where a bucket still holds more than one
   component, its members outside the first one's are compared with a few
   members of that one, which ties most of them to it.
4. Whatever then is still outside is held against all members of other
   components, so no candidate link between components goes unseen. Where the
   rows meet, a bit of each value of a longer signature tells which of these
   pairs can't reach the threshold.

Links are confirmed on full sets. Within a component nothing needs comparing:
more links there would not change the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.llm.common import (
    fingerprint,
    keep_documents,
    lower_words,
    map_arrow,
    of_bounded_size,
    stored,
)

WORDS = 5
PERCENT = 75
# A pair at the threshold agrees in a band with 0.75 ** 6 = 0.178 and in none of
# 48 with 0.0001; at 0.8 it is missed with 5e-7.
BANDS = 48
PER_BAND = 3
# Ids up to this many are broadcast to pick their texts; more go by a shuffle.
BROADCAST_IDS = 500_000

# Permutations of the longer signature that candidates get, and longs that hold a
# bit of each of its values. A pair at the threshold differs in 256 of the 2048
# bits, give or take 15; one that differs in more than 323 (four and a half
# deviations) is not looked at. That loses 3 links at the threshold in a million,
# far fewer than the bands do.
LONGER = 1024
BIT_LONGS = 2 * LONGER // 64
MOST_BITS_APART = 323
# Members of a bucket's first component that those outside it meet first.
WITNESSES = 4

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    A text of fewer words is one shingle as a whole; without words there is none.
    """
    import xxhash

    words = lower_words(text)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out + own[k : n - width + 1 + k])
    return np.unique(out)


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    factors = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors[:, None], rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def minmax(shingles: np.ndarray, permutations: int = BANDS * PER_BAND) -> np.ndarray:
    """Least and greatest value under each permutation, two to a row."""
    factors, shifts = _permutations(permutations)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(factors), 2), np.uint32)
    out[:, 0], out[:, 1] = np.iinfo(np.uint32).max, 0
    step = max(1, 600_000 // permutations)
    for at in range(0, len(short), step):
        values = factors * short[None, at : at + step] + shifts
        np.minimum(out[:, 0], values.min(axis=1), out=out[:, 0])
        np.maximum(out[:, 1], values.max(axis=1), out=out[:, 1])
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key a band; bands share no keys but by chance."""
    values = signature.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(values.shape[1]):
        key = _mixed(key + values[:, k])
    return key.view(np.int64)


def signature_bits(shingles: np.ndarray) -> np.ndarray:
    """A bit of each value of the longer signature, packed into longs: equal values
    agree, others with even chance."""
    values = minmax(shingles, LONGER).ravel().astype(np.uint64) + np.uint64(1)
    return np.packbits((_mixed(values) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``text_key``, ``n_shingles``, ``set_key`` and ``bands``
    of every row; ``set_key`` is a 128-bit digest of the set."""
    none = np.zeros(0, np.int64)

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch):
            sizes, keys, bands = [], [], []
            for text in part["text"].to_pylist():
                own = shingle_set(text)
                sizes.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                bands.append(band_keys(minmax(own)) if len(own) else none)
            yield {
                "row": part["row"],
                "doc_id": part["doc_id"],
                "text_key": part["text_key"],
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            }

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        fingerprint(F.col("text")).alias("text_key"),
        "text",
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        rows,
        per_batch,
        f"row bigint, doc_id {kind}, text_key string, n_shingles bigint, set_key binary, "
        "bands array<bigint>",
    )


def _first(*columns: str) -> Column:
    """Least by ``doc_id``, null ids last, then by row."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", *columns))


def _similar_sizes(a: str, b: str) -> Column:
    """Whether two sets can reach the threshold by their sizes."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _shingles_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``shingles`` and ``bits`` (arrays of bigint) of some classes.

    ``nodes`` has the id and text key of a row that stands for each class.
    """
    wanted = nodes.select("node", F.col("rep_id").alias("__id"), F.col("rep_key").alias("__key"))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    keyed = docs.select("doc_id", "text", fingerprint(F.col("text")).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    # Repeated rows give a class more than one text, all equal.
    texts = keyed.join(wanted, same).select("node", "text").dropDuplicates(["node"])

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch):
            sets = [shingle_set(t) for t in part["text"].to_pylist()]
            bits = [signature_bits(own) for own in sets]
            yield {
                "node": part["node"],
                "shingles": pa.array([own.view(np.int64) for own in sets], pa.list_(pa.int64())),
                "bits": pa.array(bits, pa.list_(pa.int64())),
            }

    return map_arrow(texts, per_batch, "node bigint, shingles array<bigint>, bits array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return (
        pairs.join(of_a, "a").join(of_b, "b").where(100 * common >= PERCENT * union).select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it reaches, for all nodes of
    ``edges(a, b)`` but the least ones themselves.

    Every node in turn is tied to its least neighbour instead of its greater
    ones, then its lesser ones to the least, until nothing changes; the rounds
    grow with the logarithm of the longest chain. No task holds a component.
    """

    def state(df: DataFrame) -> tuple[int, int]:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(turned.where("a <> b").distinct(), "links")
    before = state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = stored(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        current = stored(small.where("a <> b").distinct(), "small-star")
        after = state(current)
        if after == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = after


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``,
    ``kept`` and ``text_key``.

    ``component_id`` is the smallest ``doc_id`` reachable over links. A null or
    wordless text has no shingles and is alone. A row with a null id is kept
    only if nothing it is linked with has one; of rows that share an id and a
    component one is kept.
    """
    rows = stored(sketches(docs), "sketches")
    classes = rows.where("n_shingles > 0").groupBy("set_key").agg(
        _first("text_key").alias("rep"),
        F.first("bands").alias("bands"),
        F.first("n_shingles").alias("n"),
    )
    classes = stored(
        classes.select(
            F.monotonically_increasing_id().alias("node"),
            "set_key",
            F.col("rep.doc_id").alias("rep_id"),
            F.col("rep.text_key").alias("rep_key"),
            "bands",
            "n",
        ),
        "classes",
    )
    banded = classes.select("node", "n", F.explode("bands").alias("key"))
    buckets = (
        banded.groupBy("key")
        .agg(F.min(F.struct("node", "n")).alias("first"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    members = banded.join(buckets, "key").select("key", "node", "n", "first")
    members = stored(members, "bucket-members")
    involved = members.select("node").distinct()
    sets = stored(_shingles_of(docs, classes.join(involved, "node", "left_semi")), "sets")

    pairs = (
        members.where("node <> first.node")
        .where(_similar_sizes("n", "first.n"))
        .select(F.col("first.node").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    links = stored(_verified(pairs, sets), "star-links")
    label = components(links)
    bits = sets.select("node", "bits").join(classes.select("node", "bands"), "node")
    for pairs_in in (_with_witnesses, _with_all):
        pairs = stored(pairs_in(_mixed_buckets(members, label, bits)), "across")
        # No pair with a witness does not mean none at all.
        if pairs.isEmpty():
            continue
        links = stored(links.unionByName(_verified(pairs, sets)), "links-so-far")
        label = stored(components(links), "labels")

    in_component = classes.join(label, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component")
    )
    in_component = stored(in_component, "set-components")
    joined = rows.drop("bands").join(in_component, "set_key", "left")
    # Documents without shingles are components of their own.
    alone = F.when(F.col("component").isNull(), F.col("row"))
    joined = stored(joined.withColumn("alone", alone), "in-components")
    heads = stored(joined.groupBy("component", "alone").agg(_first().alias("head")), "heads")
    c = joined.alias("c")
    h = heads.alias("h")
    same = F.col("c.component").eqNullSafe(F.col("h.component"))
    same &= F.col("c.alone").eqNullSafe(F.col("h.alone"))
    return c.join(h, same).select(
        "c.doc_id",
        "c.n_shingles",
        F.col("h.head.doc_id").alias("component_id"),
        (F.col("c.row") == F.col("h.head.row")).alias("kept"),
        "c.text_key",
    )


def _mixed_buckets(members: DataFrame, label: DataFrame, bits: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one component: ``key``, ``node``, ``n``,
    ``component``, ``one`` (the component of least number there) and ``bits``.

    Buckets of a single component, however large, are left out before rows meet.
    """
    placed = members.join(label, "node", "left").select(
        "key", "node", "n", F.coalesce("component", "node").alias("component")
    )
    placed = stored(placed, "placed")
    mixed = (
        placed.groupBy("key")
        .agg(F.min("component").alias("one"), F.max("component").alias("other"))
        .where("one <> other")
        .select("key", "one")
    )
    return stored(placed.join(mixed, "key").join(bits, "node"), "mixed-buckets")


def _side(rows: DataFrame, x: str) -> DataFrame:
    return rows.select(
        "key",
        F.col("node").alias(x),
        F.col("n").alias(f"n_{x}"),
        F.col("component").alias(f"c_{x}"),
        F.col("bands").alias(f"bands_{x}"),
        *(F.col("bits")[i].alias(f"bits_{x}_{i}") for i in range(BIT_LONGS)),
    )


def _pairs(a: DataFrame, b: DataFrame, once: bool) -> DataFrame:
    """Pairs of one bucket and different components that may reach the threshold.

    With ``once``, which is right where both are in all their buckets, a pair
    comes out of the first bucket it shares only.
    """
    a, b = _side(a, "a"), _side(b, "b")
    apart = F.lit(0)
    for i in range(BIT_LONGS):
        apart += F.bit_count(F.col(f"bits_a_{i}").bitwiseXOR(F.col(f"bits_b_{i}")))
    pair = (a["key"] == b["key"]) & (a["c_a"] != b["c_b"]) & _similar_sizes("n_a", "n_b")
    pair &= apart <= MOST_BITS_APART
    if once:
        pair &= F.array_intersect("bands_a", "bands_b")[0] == a["key"]
    return (
        a.join(b, pair)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _with_witnesses(mixed: DataFrame) -> DataFrame:
    """Members outside the first component of a bucket with a few of its members,
    drawn by hash and so others in every bucket."""
    own = ("node", "n", "component", "bits", "bands")
    drawn = mixed.where("component = one").groupBy("key").agg(
        *(
            F.max(F.struct(F.xxhash64(F.lit(k), "key", "node"), *own)).alias(f"w{k}")
            for k in range(WITNESSES)
        )
    )
    some = drawn.select("key", F.explode(F.array(*drawn.columns[1:])).alias("w"))
    some = some.select("key", *(f"w.{c}" for c in own)).distinct()
    return _pairs(mixed.where("component <> one"), some, once=False)


def _with_all(mixed: DataFrame) -> DataFrame:
    """The same with all members of other components. Two members outside the
    first component are looked for from both sides."""
    # A pair's first shared bucket may have the component of one of the two as
    # its first; the other then looks for partners there, so neither is missed.
    return _pairs(mixed.where("component <> one"), mixed, once=True)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns kept."""
    found = stored(near_duplicates(docs), "near-duplicates")
    kept = (
        found.groupBy("doc_id", "text_key")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept"))
        .where("kept")
    )
    return keep_documents(docs, kept, fingerprint(F.col("text")))


def op10_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return near_duplicates(docs).drop("text_key")
