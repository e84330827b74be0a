"""Words grouped with the more frequent word that they are one letter away from.

Words are blocked by length and by how many of their letters fall into each of a few sets. One
edit changes the length by one at most, and the squared distance of letter counts to
1 (inserted or deleted) or 2 (replaced), so only neighbouring blocks are multiplied:
their Gram matrix gives all distances at once, and pairs at the right distance are
compared letter by letter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, of_bounded_size, stored

LEAST_LETTERS = 5
LEAST_COUNT = 3
# One in so many documents has a letter of a word deleted.
DELETION = 97
# How many times as frequent as a word its form is.
FORM_TIMES = 2
# Sets of letters (code point modulo the number of sets) that blocks go by.
SETS = 5
# Words of one tile of a block, on average.
TILE_WORDS = 1_024
# A worker passes on what it has counted beyond so many words or bytes of text.
HELD_WORDS = 250_000
HELD_BYTES = 64 << 20
# Letters of candidate pairs that are compared at a time.
COMPARED = 8 << 20

# A run's letters are single bytes in Latin-1; anything else parts runs.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, in Latin-1, A-Z lowered."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def shortened(prefix: int, run: bytes) -> bytes | None:
    """The run without one letter, if the checksum of document and run says so;
    ``prefix`` is the checksum of the document's id and a colon."""
    check = crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if check % DELETION:
        return None
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """``word`` (Latin-1) and ``n`` of the words of at least ``letters`` letters that occur
    at least ``least`` times. Counted per task before anything is shuffled."""
    find_library(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            found = [(w, n) for w, n in counts.items() if n > 0 and len(w) >= letters]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())],
                ["word", "n"],
            )
            counts.clear()

        for batch in batches:
            for part in of_bounded_size(batch):
                for name, text in zip(part["name"].to_pylist(), part["text"].to_pylist()):
                    found = runs(text)
                    counts.update(found)
                    size += len(text or "")
                    prefix = crc32(f"{name}:".encode())
                    own = set(found)
                    if text.isascii() if text else True:
                        hit = [w for w in own if not crc32(w, prefix) % DELETION]
                    else:
                        hit = [w for w in own if shortened(prefix, w) is not None]
                    for word in hit:
                        n = found.count(word)
                        counts[word] -= n
                        counts[shortened(prefix, word)] += n
                if len(counts) > HELD_WORDS or size > HELD_BYTES:
                    yield from out()
                    size = 0
        yield from out()

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    counted = docs.select(name, "text").mapInArrow(run, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _with_cell(words: DataFrame) -> DataFrame:
    """``word``, ``n`` and ``cell``: how many letters of the word are in each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["word"].to_pylist()
            letters = np.frombuffer(b"".join(found), np.uint8).astype(np.int64)
            row = np.repeat(np.arange(len(found)), [len(w) for w in found])
            held = np.bincount(row * SETS + letters % SETS, minlength=len(found) * SETS)
            cells = [",".join(map(str, c)) for c in held.reshape(-1, SETS).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["n"], pa.array(cells, pa.string())], ["word", "n", "cell"]
            )

    return words.mapInArrow(run, "word binary, n bigint, cell string")


def _tiles(words: DataFrame, tile_words: int) -> DataFrame:
    """``cell``, ``tile`` and its words in order, with their counts. A block of many
    words, or of long ones, is dealt to several tiles."""
    celled = _with_cell(words)
    weight = F.count(F.lit(1)) * F.greatest(F.max(F.octet_length("word")), F.lit(1_024)) / 1_024
    sizes = celled.groupBy("cell").agg(F.ceil(weight / tile_words).alias("tiles"))
    dealt = celled.join(sizes, "cell").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")))
    held = F.sort_array(F.collect_list(F.struct("word", "n")))
    return dealt.groupBy("cell", "tile").agg(held.alias("held")).select(
        "cell", "tile", F.col("held.word").alias("words"), F.col("held.n").alias("ns")
    )


def _neighbours(cell: Column) -> Column:
    """Half of the blocks next to one, itself included, so that each two meet once: one
    letter more in a set, or one letter of a set for one of a later set."""
    held = F.transform(F.split(cell, ","), lambda c: c.cast("int"))
    moves = [()]
    moves += [((i, 1),) for i in range(SETS)]
    moves += [((i, 1), (j, -1)) for i in range(SETS) for j in range(i + 1, SETS)]
    keys = []
    for move in moves:
        step = dict(move)
        keys.append(F.concat_ws(",", *((held[s] + F.lit(step.get(s, 0))).cast("string") for s in range(SETS))))
    return F.array(*keys)


def _letter_counts(letters: np.ndarray) -> np.ndarray:
    n, length = letters.shape
    at = (np.arange(n)[:, None] * 256 + letters).ravel()
    return np.bincount(at, minlength=n * 256).reshape(n, 256)


def candidates(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two tiles of letters whose letter counts are as far apart as one edit
    makes them, from the product of their counts."""
    left, right = _letter_counts(a), _letter_counts(b)
    used = np.flatnonzero(left.any(axis=0) & right.any(axis=0))
    kind = np.float32 if max(a.shape[1], b.shape[1]) < 4_000 else np.float64  # exact below 2**24
    gram = left[:, used].astype(kind) @ right[:, used].astype(kind).T
    apart = 2 if a.shape[1] == b.shape[1] else 1
    squares = [np.einsum("ij,ij->i", x, x).astype(kind) for x in (left, right)]
    gram *= 2
    gram += apart
    return np.nonzero(gram == squares[0][:, None] + squares[1][None, :])


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one edit; ``b`` has as many letters or one more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    length = a.shape[1]
    before, after = a != b[:, :-1], a != b[:, 1:]
    first = np.where(before.any(axis=1), before.argmax(axis=1), length)
    last = np.where(after.any(axis=1), length - 1 - after[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two tiles that are one edit apart; ``b`` has as many letters or one more."""
    i, j = candidates(a, b)
    step = max(1, COMPARED // max(1, a.shape[1]))
    kept = [one_edit(a[i[s : s + step]], b[j[s : s + step]]) for s in range(0, len(i), step)]
    same = np.concatenate([np.zeros(0, bool), *kept])
    return i[same], j[same]


def _best(own: np.ndarray, near: np.ndarray, near_n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per row in ``own``: how many rows are near, and which is the most frequent, the
    first one of equals."""
    order = np.lexsort((near, -near_n, own))
    rows, first, n = np.unique(own[order], return_index=True, return_counts=True)
    return rows, n, near[order][first]


_NEAR = "word binary, n_near bigint, best_n bigint, best binary"


def near_words(words: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` of the words that have near ones."""
    find_library(words.sparkSession)
    tiles = stored(_tiles(words, tile_words), "word-tiles")
    left = tiles.select("*", F.explode(_neighbours(F.col("cell"))).alias("key"))
    right = tiles.select(F.col("cell").alias("key"), *(F.col(c).alias(f"{c}_b") for c in ("tile", "words", "ns")))
    inside = F.col("cell") == F.col("key")
    met = left.join(right, "key").where(~inside | (F.col("tile") <= F.col("tile_b")))
    met = met.select("words", "ns", "words_b", "ns_b", (inside & (F.col("tile") == F.col("tile_b"))).alias("same"))

    def parts(column: pa.ListArray, counts: pa.ListArray, row: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        own = column[row].values
        n = len(own)
        letters = np.frombuffer(b"".join(own.to_pylist()), np.uint8).reshape(n, -1)
        return letters, counts[row].values.to_numpy(zero_copy_only=False), own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[pa.Array]] = []

            def add(words_: pa.Array, ns: np.ndarray, names: pa.Array, own, near) -> None:
                if len(own):
                    rows, n, best = _best(own, near, ns[near])
                    out.append([words_.take(pa.array(rows)), pa.array(n, pa.int64()),
                                pa.array(ns[best], pa.int64()), names.take(pa.array(best))])

            for row, same in enumerate(batch["same"].to_pylist()):
                a, a_n, a_words = parts(batch["words"], batch["ns"], row)
                b, b_n, b_words = parts(batch["words_b"], batch["ns_b"], row)
                i, j = near_pairs(a, b)
                if same:  # both directions are among the pairs
                    add(a_words, b_n, b_words, i, j)
                else:
                    add(a_words, b_n, b_words, i, j)
                    add(b_words, a_n, a_words, j, i)
            if out:
                arrays = [pa.concat_arrays(column) for column in zip(*out)]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "best_n", "best"])

    found = met.mapInArrow(run, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("below"), "best"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("first"))
        .select("word", "n_near", (-F.col("first.below")).alias("best_n"), F.col("first.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last form behind each word of ``forms`` (``word``, ``form``).

    Every step doubles how far a word looks. A form is at least twice as frequent as its word, so the
    number of steps grows with the logarithm of the logarithm of the counts.
    """
    ahead = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not ahead.where("moved").isEmpty():
        next_ = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = ahead.select("word", "root").join(next_, "root", "left").select(
            "word",
            F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved"),
        )
        ahead = stored(ahead, "forms")
    return ahead.select("word", "root")


def spelling_variants(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all words.

    A null or empty text has no words, and a null ``doc_id`` counts as an empty string
    where letters are deleted. Every row is a document, repeated ones too. Of equally frequent near words
    the first by code points is the form. A text, or a word, of several megabytes is held
    as it is, by one task. No documents give no rows. Other columns are not read.
    """
    words = stored(word_counts(docs), "words")
    near = stored(near_words(words, tile_words), "near-words")
    formed = words.join(near, "word", "left").withColumn(
        "form", F.when(F.col("best_n") >= FORM_TIMES * F.col("n"), F.col("best"))
    )
    formed = stored(formed, "formed-words")
    last = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(last, "word", "left").select(
        *(F.decode(c, "ISO-8859-1").alias(c) for c in ("word", "form")),
        F.decode(F.coalesce("root", "word"), "ISO-8859-1").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf}/documents.parquet"))
