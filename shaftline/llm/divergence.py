"""How far each source of a language strays from the other sources, word by word.

Two passes over the texts. The first counts documents per term and keeps the terms
of enough documents, exactly. These get minimal perfect hashes, in shards that are
broadcast with their keys; the second pass looks every token up, compares it with the
key stored in its slot, and counts in a dense array of slots per group. All arithmetic is on
whole numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, of_bounded_size, stored

# Documents of a language that a term must be in.
LEAST_DOCUMENTS = 30
# Terms of the ranking of a group.
TOP_TERMS = 50
# Keys of one perfect hash, on average, and bytes of hashes broadcast at a time; a
# larger vocabulary takes more rounds over the texts.
SHARD_KEYS = 32_768
ROUND_BYTES = 64 << 20
# A worker passes on what it has counted beyond so many terms or bytes of text.
HELD_TERMS = 250_000
HELD_BYTES = 64 << 20
# Slots of one block of counts, and sources of one side of a block of pairs.
BLOCK_SLOTS = 512
BLOCK_SOURCES = 64
_SMOOTH = 5
_UNIT = 1_000_000_000

_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, in UTF-8, A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def _named(docs: DataFrame) -> DataFrame:
    """Language, source and text, where null is the empty string."""
    return docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))


class _Tally:
    """Counts of terms per group, until there are too many of them to hold."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.counts: dict[tuple, Counter] = defaultdict(Counter)
        self.bytes = 0

    def full(self) -> bool:
        held = sum(map(len, self.counts.values()))
        return held > HELD_TERMS or self.bytes > HELD_BYTES


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang`` and ``term`` (binary) of the terms in at least ``least`` documents of
    a language. Documents are counted per task before anything is shuffled."""
    find_library(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()

        def out() -> Iterator[pa.RecordBatch]:
            for (lang,), counts in tally.counts.items():
                columns = [[lang] * len(counts), list(counts), list(counts.values())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()))],
                    ["lang", "term", "n"],
                )
            tally.clear()

        for batch in batches:
            for part in of_bounded_size(batch):
                for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
                    tally.counts[lang,].update(set(terms(text)))
                    tally.bytes += len(text)
                if tally.full():
                    yield from out()
        yield from out()

    counted = _named(docs).select("lang", "text").mapInArrow(run, "lang string, term binary, n bigint")
    found = counted.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least).select("lang", "term")


# ---------------------------------------------------------------------------
# Minimal perfect hashes
# ---------------------------------------------------------------------------


def _hashes(keys: Sequence[bytes], seed: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(k, seed) for k in keys), np.uint64, len(keys))


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    x = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def build_hash(keys: Sequence[bytes]) -> tuple[int, list[int], np.ndarray]:
    """Seed, sizes of levels and their bits, for distinct ``keys``.

    On each level the keys alone in their place are set, and the others go on to the next;
    the number of bits set before a key's own is its slot. Should two keys share a
    64-bit hash, another seed is taken.
    """
    for seed in count():
        left = _hashes(keys, seed)
        if len(np.unique(left)) == len(left):
            break
    sizes: list[int] = []
    bits: list[np.ndarray] = []
    while len(left):
        size = max(64, 2 * len(left))
        at = _places(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return seed, sizes, np.concatenate([np.zeros(0, bool), *bits])


@dataclass
class Shard:
    """One perfect hash with its keys, in the order of their slots."""

    seed: int
    sizes: list[int]
    packed: bytes
    keys: bytes
    ends: np.ndarray
    first: int
    bits: np.ndarray | None = None
    rank: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.ends)

    def open(self) -> None:
        if self.bits is None:
            packed = np.frombuffer(self.packed, np.uint8)
            self.bits = np.unpackbits(packed, count=sum(self.sizes)).astype(bool)
            self.rank = np.cumsum(self.bits, dtype=np.int32) - 1
            self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def slots(self, keys: Sequence[bytes], verify: bool = True) -> np.ndarray:
        """Slot of each key, -1 of those that are not the ones stored."""
        self.open()
        hashes = _hashes(keys, self.seed)
        slot = np.full(len(hashes), -1, np.int64)
        left, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = base + _places(hashes[left], level, size)
            hit = self.bits[at]
            slot[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        if verify:
            found = np.flatnonzero(slot >= 0)
            starts, ends = self.starts[slot[found]].tolist(), self.ends[slot[found]].tolist()
            for i, a, b in zip(found.tolist(), starts, ends):
                if self.keys[a:b] != keys[i]:
                    slot[i] = -1
        return slot


@dataclass
class Vocabulary:
    """Shards of one round, by language; ``parts`` of a language in all rounds."""

    shards: dict[str, dict[int, Shard]] = field(default_factory=dict)
    parts: dict[str, int] = field(default_factory=dict)

    def slots(self, lang: str, keys: Sequence[bytes]) -> Iterator[tuple[Shard, np.ndarray, np.ndarray]]:
        """For each shard: which of ``keys`` it holds, and their slots in it."""
        own, parts = self.shards.get(lang, {}), self.parts.get(lang, 1)
        number = None if parts == 1 else np.fromiter((zlib.crc32(k) % parts for k in keys), np.int64, len(keys))
        for k, shard in own.items():
            asked = np.arange(len(keys)) if number is None else np.flatnonzero(number == k)
            slot = shard.slots(keys if number is None else [keys[i] for i in asked.tolist()])
            held = slot >= 0
            yield shard, asked[held], slot[held]


_SHARD = "lang string, shard int, seed bigint, sizes array<int>, bits binary, keys array<binary>"


def hash_shards(vocabulary: DataFrame, sizes: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """A perfect hash per shard of the terms (``lang``, ``term``) of each language."""
    find_library(vocabulary.sparkSession)

    def build(group: pa.Table) -> pa.Table:
        keys = group["term"].to_pylist()
        seed, levels, bits = build_hash(keys)
        lang, shard = group["lang"][0].as_py(), group["shard"][0].as_py()
        packed = np.packbits(bits).tobytes()
        made = Shard(seed, levels, packed, b"", np.zeros(0, np.int64), 0)
        made.ends = np.zeros(len(keys), np.int64)
        order = np.empty(len(keys), np.int64)
        order[made.slots(keys, verify=False)] = np.arange(len(keys))
        row = [lang, shard, seed, levels, packed, [keys[i] for i in order.tolist()]]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()))
        names = ["lang", "shard", "seed", "sizes", "bits", "keys"]
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

    parts = F.ceil(F.col("terms") / shard_keys).cast("int")
    dealt = vocabulary.join(sizes, "lang").select(
        "lang", F.pmod(F.crc32("term"), parts).cast("int").alias("shard"), "term"
    )
    return dealt.groupBy("lang", "shard").applyInArrow(build, _SHARD)


def _rounds(shards: DataFrame, round_bytes: int) -> Iterator[tuple[Vocabulary, dict]]:
    """Vocabularies of at most ``round_bytes``, or one shard, to broadcast one after the other.

    The driver holds a few numbers of every shard, one for ``SHARD_KEYS`` terms, and the
    keys of one round.
    """
    keys = F.aggregate("keys", F.lit(0).cast("bigint"), lambda n, k: n + F.octet_length(k) + 8)
    listed = shards.select(
        "lang", "shard", F.size("keys").alias("n"), (keys + F.octet_length("bits")).alias("bytes")
    )
    plan = sorted(tuple(r) for r in listed.collect())
    parts = Counter(lang for lang, *_ in plan)
    first, total, at, rounds, held = {}, Counter(), 0, [], 0
    for lang, shard, n, size in plan:
        if not rounds or held + size > round_bytes:
            rounds.append(defaultdict(list))
            held = 0
        held += size
        rounds[-1][lang].append(shard)
        first[lang, shard] = total[lang]
        total[lang] += n
    for chosen in rounds:
        wanted = reduce(
            Column.__or__,
            ((F.col("lang") == lang) & F.col("shard").between(own[0], own[-1]) for lang, own in chosen.items()),
        )
        vocabulary = Vocabulary(parts=dict(parts))
        for row in shards.where(wanted).toArrow().to_pylist():
            ends = np.cumsum([len(k) for k in row["keys"]], dtype=np.int64)
            vocabulary.shards.setdefault(row["lang"], {})[row["shard"]] = Shard(
                row["seed"], row["sizes"], row["bits"], b"".join(row["keys"]), ends,
                first[row["lang"], row["shard"]],
            )
        yield vocabulary, first


def recount(docs: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``lang``, ``source``, ``slot`` and ``n``: occurrences of the terms in ``shards``.

    Slots are numbered through the shards of a language. Each round broadcasts some shards,
    whose size is checked, and reads the texts once; nearly always one round has them all.
    """
    spark = docs.sparkSession
    find_library(spark)
    counted = spark.createDataFrame([], "lang string, source string, slot bigint, n bigint")
    for vocabulary, _ in _rounds(shards, round_bytes):
        counted = counted.unionByName(_round(_named(docs), spark.sparkContext.broadcast(vocabulary)))
    return counted.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))


def _round(docs: DataFrame, broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = broadcast.value
        tally = _Tally()
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def count_slots() -> None:
            for (lang, source), counts in tally.counts.items():
                keys = list(counts)
                n = np.fromiter(counts.values(), np.int64, len(keys))
                for shard, asked, slot in vocabulary.slots(lang, keys):
                    own = dense.setdefault((lang, source, shard.first), np.zeros(len(shard), np.int64))
                    own[slot] += n[asked]  # each key has a slot of its own
            tally.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source, first), own in dense.items():
                slot = np.flatnonzero(own)
                if len(slot):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(slot), pa.string()),
                            pa.array([source] * len(slot), pa.string()),
                            pa.array(slot + first),
                            pa.array(own[slot]),
                        ],
                        ["lang", "source", "slot", "n"],
                    )
            dense.clear()

        for batch in batches:
            for part in of_bounded_size(batch):
                rows = zip(*(part[c].to_pylist() for c in ("lang", "source", "text")))
                for lang, source, text in rows:
                    if lang in vocabulary.shards:
                        tally.counts[lang, source].update(terms(text))
                        tally.bytes += len(text)
                if tally.full():
                    count_slots()
                    if sum(own.nbytes for own in dense.values()) > HELD_BYTES:
                        yield from out()
        count_slots()
        yield from out()

    return docs.mapInArrow(run, "lang string, source string, slot bigint, n bigint")


# ---------------------------------------------------------------------------
# Shares and distances
# ---------------------------------------------------------------------------


def _share(n: Column, total: Column, terms_: Column) -> Column:
    """1 + floor(10^9 * (n + 5) / (total + 5 * terms)), in whole numbers."""
    whole = (n + F.lit(_SMOOTH)).cast("decimal(20,0)") * F.lit(_UNIT).cast("decimal(10,0)")
    below = F.nullif(total + terms_ * F.lit(_SMOOTH), F.lit(0)).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", whole, below)


def _pair_parts(group: pa.Table) -> pa.Table:
    """Distances of the sources of two blocks over one block of slots."""
    x, at, p = (group[c].to_numpy() for c in ("x", "at", "p"))
    lang, a, b = (group[c][0].as_py() for c in ("lang", "a", "b"))
    width = group["width"][0].as_py()
    marks = at < 0
    order = np.argsort(x[marks])
    members = x[marks][order]
    shares = np.repeat(np.nan_to_num(p[marks][order]).astype(np.int64)[:, None], width, axis=1)
    real = ~marks
    shares[np.searchsorted(members, x[real]), at[real]] = p[real].astype(np.int64)
    left = np.flatnonzero(members // BLOCK_SOURCES == a)
    right = np.flatnonzero(members // BLOCK_SOURCES == b)
    first, second, value = [], [], []
    for i in left.tolist():
        others = right[members[right] > members[i]]
        first.append(np.full(len(others), members[i]))
        second.append(members[others])
        value.append(np.abs(shares[others] - shares[i]).sum(axis=1, dtype=np.int64))
    columns = [np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64) for c in (first, second, value)]
    names = ["lang", "x", "y", "value"]
    return pa.table([pa.array([lang] * len(columns[0]), pa.string()), *map(pa.array, columns)], names=names)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def source_divergence(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    shard_keys: int = SHARD_KEYS,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair``: the distance of a source to each other source of its language, summed over
    all kept terms. Part ``term``: the ``top`` terms that a source has a larger share of
    than its language.

    Null texts, languages and sources count as empty strings; a text of several megabytes is
    tallied like any other, in memory of its size. Every row is a document, repeated ones too. Ties in value
    go by item. A source without terms has the shares of no counts, and a language without
    kept terms distances of 0. No documents give no rows. Other columns are not read.
    """
    vocabulary = stored(kept_terms(docs, least), "kept-terms")
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    shards = stored(hash_shards(vocabulary, sizes, shard_keys), "hash-shards")
    counts = stored(recount(docs, shards, round_bytes), "slot-counts")

    # One row per source, numbered within its language.
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        _named(docs).select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .fillna(0, ["total", "terms"])
    )
    in_lang = Window.partitionBy("lang")
    groups = stored(
        groups.withColumns(
            {
                "x": F.row_number().over(in_lang.orderBy("source")).cast("bigint") - 1,
                "sources": F.count(F.lit(1)).over(in_lang),
            }
        ),
        "sources",
    )
    shares = counts.join(groups, ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("terms"))
    )

    # Shares of the whole language, and the terms behind the slots.
    before = F.sum(F.size("keys")).over(in_lang.orderBy("shard")) - F.size("keys")
    named = shards.select("lang", before.alias("first"), "keys").select(
        "lang", "first", F.posexplode("keys").alias("nth", "term")
    )
    whole = named.select("lang", (F.col("first") + F.col("nth")).alias("slot"), "term")
    lang_sizes = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("terms").alias("terms"))
    in_all = (
        counts.groupBy("lang", "slot").agg(F.sum("n").alias("m"))
        .join(lang_sizes, "lang")
        .join(whole, ["lang", "slot"])
        .select("lang", "slot", F.col("term").cast("string").alias("item"),
                _share(F.col("m"), F.col("all"), F.col("terms")).alias("q"))
    )
    above = shares.join(in_all, ["lang", "slot"]).where("p > q")
    best = _ranked(above.select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value")))
    by_term = best.where(F.col("rank") <= top).withColumn("part", F.lit("term"))

    # Blocks of sources against blocks of sources, over blocks of slots. A mark per source
    # and block has the share of terms that do not occur.
    blocks = F.greatest(F.ceil(F.col("terms") / BLOCK_SLOTS), F.lit(1).cast("bigint"))
    marks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    marks = marks.select(
        "lang", "x", "sources", "terms", "block", F.lit(-1).cast("bigint").alias("at"),
        _share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms")).alias("p"),
    )
    cells = shares.select(
        "lang", "x", "sources", "terms",
        F.floor(F.col("slot") / BLOCK_SLOTS).alias("block"),
        (F.col("slot") % BLOCK_SLOTS).alias("at"),
        "p",
    )
    own = F.floor(F.col("x") / BLOCK_SOURCES)
    last = F.floor((F.col("sources") - 1) / BLOCK_SOURCES)
    tiles = (
        marks.unionByName(cells)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .select(
            "lang", F.least(own, "other").alias("a"), F.greatest(own, "other").alias("b"), "block", "x", "at", "p",
            F.least(F.lit(BLOCK_SLOTS), F.col("terms") - F.col("block") * BLOCK_SLOTS).alias("width"),
        )
    )
    parts = tiles.groupBy("lang", "a", "b", "block").applyInArrow(
        _pair_parts, "lang string, x bigint, y bigint, value bigint"
    )
    apart = parts.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
    both = apart.withColumn(
        "ways",
        F.explode(F.array(F.struct(F.col("x").alias("me"), F.col("y").alias("it")),
                          F.struct(F.col("y").alias("me"), F.col("x").alias("it")))),
    ).select("lang", "ways.me", "ways.it", "value")
    names = groups.select("lang", F.col("x").alias("me"), "source")
    others = groups.select("lang", F.col("x").alias("it"), F.col("source").alias("item"))
    pairs = both.join(names, ["lang", "me"]).join(others, ["lang", "it"])
    by_pair = _ranked(pairs.select("lang", "source", "item", "value")).withColumn("part", F.lit("pair"))
    return by_pair.unionByName(by_term).select("lang", "source", "part", "item", "value", "rank")


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf}/documents.parquet"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
tokens AS (SELECT r, lang, source, unnest(found) AS term FROM docs),
kept AS (
  SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN sizes USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) t
    ON t.lang = g.lang AND t.source = g.source),
langs AS (SELECT lang, max(v) AS v, sum(total) AS total FROM groups GROUP BY lang),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT AS p
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
whole AS (
  SELECT lang, term,
    1 + (1000000000::HUGEINT * (m + 5)) // (total + 5 * v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS m FROM counts GROUP BY lang, term) JOIN langs USING (lang)),
pairs AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(d.value, 0) AS value
  FROM groups g JOIN groups h ON h.lang = g.lang AND h.source <> g.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
    GROUP BY a.lang, a.source, b.source) d
  ON d.lang = g.lang AND d.source = g.source AND d.item = h.source),
best AS (
  SELECT lang, source, term AS item, p - q AS value FROM shares JOIN whole USING (lang, term)
  WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM best)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
