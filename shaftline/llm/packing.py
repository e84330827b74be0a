"""Best-fit-decreasing packing of token sequences.

The packer never holds documents: equal lengths are alike, so best-fit
decreasing runs over the histogram of lengths (at most ``capacity`` rows,
whatever the corpus) and places whole runs of equal pieces into whole runs of
equal bins at once. A segment tree over remaining capacities finds the tightest
open bins. The result is a plan by rank: "pieces ranked a to b of length n go to
bins c and on, k to a bin, from offset o". Pieces find their place by their rank
among those of equal length, which Spark counts in salted groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, map_arrow, of_bounded_size, stored, tokenizer_path
from shaftline.llm.tokens import REMEMBERED, encoder

END = 1
CAPACITY = 4096
# Groups that the pieces of one length are ranked in.
SALTS = 64


class OpenBins:
    """Runs of open bins by remaining capacity, under a segment tree.

    A leaf says whether any bin has just that much room; an inner node, whether
    one below it has.
    """

    def __init__(self, capacity: int) -> None:
        self.size = 1 << (capacity + 1).bit_length()
        self.any = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            self.runs[room].append((first, n))
            self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, False)
        return run

    def _mark(self, room: int, value: bool) -> None:
        at = room + self.size
        self.any[at] = value
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """Least room of an open bin that holds ``length``."""
        at = length + self.size
        if self.any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


@dataclass
class Placed:
    """Pieces of ``length`` from rank ``rank`` on, ``per_bin`` to a bin from bin
    ``first`` on, the first of each bin at ``offset``."""

    length: int
    rank: int
    first: int
    per_bin: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Placed]:
    """Best-fit decreasing over ``{length: pieces}``, by runs.

    Equal to placing the pieces one by one, longest first, each into the
    tightest bin that holds it: a bin that took one piece is tighter than its
    equals, so it takes as many as fit before the next bin is touched.
    """
    open_, placed, bins = OpenBins(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = open_.tightest(length)
            if room is None:
                room = capacity
                run, n = bins, -(-left // (capacity // length))
                bins += n
            else:
                run, n = open_.take(room)
            per_bin = room // length
            full = min(n, left // per_bin)
            offset = capacity - room
            if full:
                placed.append(Placed(length, rank, run, per_bin, offset))
                open_.add(room - per_bin * length, run, full)
                rank += full * per_bin
                left -= full * per_bin
            if full < n and left:  # fewer than a bin holds
                placed.append(Placed(length, rank, run + full, per_bin, offset))
                open_.add(room - left * length, run + full, 1)
                rank, left, full = rank + left, 0, full + 1
            open_.add(room, run + full, n - full)
    return placed


def pieces_of_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    end: int = END,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked
    for, ``ids`` of every document's pieces.

    A document longer than ``capacity`` is cut into pieces of that length, the
    last of which may be shorter; a null or empty text is the end id alone.
    ``remembered`` is how many segments a worker keeps the ids of, twice: memory
    that saves encoding them again.
    """
    path = vocabulary or tokenizer_path("word_bpe_49k.json")
    last = np.array([end], "<u4").tobytes()
    step = 4 * capacity

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        encode = encoder(path, False, remembered, special=True)
        for part in of_bounded_size(batch):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, coded in enumerate(encode([t or "" for t in part["text"].to_pylist()])):
                coded += last
                for k, at in enumerate(range(0, len(coded), step)):
                    own = coded[at : at + step]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(np.frombuffer(own, "<i4"))
            out = {
                "doc_id": part["doc_id"].take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            yield out | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if with_ids else {})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""
    return map_arrow(docs.select("doc_id", "text"), per_batch, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` of each.

    ``pieces`` should be stored: it is read for the histogram and again for the
    places. Every piece has 1 to ``capacity`` tokens. Copies of a row are placed
    like any other rows; no rows, no sequences.
    """
    find_library(pieces.sparkSession)
    salted = pieces.withColumn(
        "__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts))
    )
    # capacity * salts rows at most.
    counts = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("n")).collect()
    table = np.zeros((capacity + 1, salts), np.int64)
    for length, salt, n in counts:
        table[length, salt] = n
    before = np.cumsum(table, axis=1) - table
    placed = plan({k: int(n) for k, n in enumerate(table.sum(axis=1)) if n}, capacity)
    placed.sort(key=lambda p: (p.length, p.rank))
    # Ranks of one length lie apart from those of any other.
    span = int(table.sum()) + 1
    keys = np.array([p.length * span + p.rank for p in placed], np.int64)
    ranks, firsts, per_bins, offsets = (
        np.array([getattr(p, name) for p in placed], np.int64)
        for name in ("rank", "first", "per_bin", "offset")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = before[length, batch["__salt"].to_numpy()] + batch["__nth"].to_numpy() - 1
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            nth = rank - ranks[at]
            columns = {c: batch[c] for c in batch.schema.names if not c.startswith("__")}
            columns["sequence_id"] = pa.array(firsts[at] + nth // per_bins[at])
            columns["offset"] = pa.array(offsets[at] + nth % per_bins[at] * length)
            yield pa.RecordBatch.from_pydict(columns)

    group = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("__nth", F.row_number().over(group))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of all documents with the sequence and offset each goes to."""
    return pack(stored(pieces_of_documents(docs, remembered=remembered), "pieces"))


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf}/documents.parquet"))
