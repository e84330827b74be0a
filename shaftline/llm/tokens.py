"""Token ids in ORC files.

Texts are cut where the vocabulary always has a token boundary, and each distinct
segment is encoded once per Python worker. ORC stores the ids in stripes with integer run-length encoding, with a
row index and a Bloom filter on ``doc_id``, so that stripes are read in parallel
and a look-up of some documents skips all others by metadata.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, map_arrow, of_bounded_size, tokenizer_path
from shaftline.sources.scratch import scratch_path

END = 2
# Segments of one generation; a worker remembers two, up to about 300 MB.
REMEMBERED = 800_000
# Bytes of one generation where they are counted: a segment may be a line of any length.
HELD_BYTES = 176 << 20
# Bytes of text that are cut at a time there.
CUT_BYTES = 1_000_000
# New segments that are encoded at a time.
TOGETHER = 250
# What a segment takes in memory, about: in all, and more for each character.
_ENTRY, _CHARACTER = 150, 6
# White space next to white space, where a token may hold more than one of them.
_RUN = re.compile(r"\s\s")
# A segment with white space at an end, but for a line end in front, or next to other.
_ODD = re.compile(r"^$|^\n?(?!\n)\s|\s$|\s\s")
# Letters with a sign behind them that is a token of its own wherever letters and signs are parted.
_ENDED = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+[,.]")
_encoders: dict[tuple, "Encoder"] = {}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    Texts are cut where every token ends, at single spaces and line ends, and
    each distinct segment is encoded once. ``spaced`` vocabularies put a space
    into the token behind it and have a token for a line end; the others drop
    white space. Their segments are told apart here by their first character:
    one that starts with a line end has it in front, any other a space.

    The strings of special tokens are ordinary text, or with ``special`` become these tokens,
    as is the library's default. ``held`` bounds the segments of a generation in bytes besides
    their number ``remembered``.
    """

    def __init__(
        self, path: str, spaced: bool, remembered: int = REMEMBERED, special: bool = False, held: int | None = None
    ) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added if token.special] if special else []
        self.spaced = spaced
        self.remembered = remembered
        self.held, self.holding = held, 0
        # Segments seen lately, and those seen before them: what comes up again
        # moves on to the new generation, the rest is forgotten with the old one.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # Segments seen that have white space where they were cut.
        self.odd: set[str] = set()
        # Segments are encoded many at a time, parted by a token of its own.
        self.parting = "\n" if spaced else " \u2605 "
        (self.part_id,) = self._ids(self.parting)
        self.line_end = np.array([self.part_id], "<u4").tobytes()
        # Words with one of these behind them need no encoding beside the words.
        parts_signs = spaced and isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and self.tokenizer.pre_tokenizer.use_regex
        self.signs = {sign: self._whole(sign) for sign in ",."} if parts_signs and self.tokenizer.normalizer is None else {}

    def _ids(self, text: str) -> list[int]:
        # The fast way keeps no offsets, which nobody asks for.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _whole(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def _marked(self, text: str) -> bool:
        """Whether a text has the string of a special token that counts as one."""
        return any(mark in text for mark in self.special)

    def _uncut(self, text: str) -> bytes:
        if not self._marked(text):
            return self._whole(text)
        self.tokenizer.encode_special_tokens = False
        try:
            return self._whole(text)
        finally:
            self.tokenizer.encode_special_tokens = True

    def segments(self, text: str) -> list[str]:
        if not self.spaced:
            return text.replace("\n", " ").split(" ")
        return ("\n" + text).replace("\n", " \n")[1:].split(" ")

    def _learn(self, new: set[str]) -> None:
        """Encode new segments; of those that end in a sign only the words in front of it, once each."""
        if not self.signs:
            self.known.update(self._encoded(list(new)))
            return
        ended = [part for part in new if _ENDED.fullmatch(part)]
        alone = new.difference(ended)
        words = {part[:-1] for part in ended}
        passing = words.difference(alone).difference(self.known)
        coded = self._encoded([*alone, *passing])
        known, signs = self.known, self.signs
        known.update([(part, (coded.get(part[:-1]) or known[part[:-1]]) + signs[part[-1]]) for part in ended])
        for word in passing:
            del coded[word]
        known.update(coded)

    def _encoded(self, new: list[str]) -> dict[str, bytes]:
        """Ids of segments; those that are plain words are encoded ``TOGETHER`` at a time."""
        coded: dict[str, bytes] = {}
        plain: dict[bool, list[str]] = {False: [], True: []}
        if self.spaced:
            plain = {False: [part for part in new if part[:1] != "\n"], True: [part[1:] for part in new if part[:1] == "\n"]}
            for bare, words in plain.items():
                if "" in words:
                    words.remove("")
                    coded.update({"\n": self.line_end} if bare else {"": self._whole("")})
        else:
            for part in new:
                if part and not part[0].isspace() and not part[-1].isspace():
                    plain[False].append(part)
                else:
                    coded[part] = self._whole(part)
        for bare, words in plain.items():
            lead = " " if self.spaced and not bare else ""
            first, front = (self.line_end, "\n") if bare else (b"", "")
            between = self.parting + lead
            for at in range(0, len(words), TOGETHER):
                some = words[at : at + TOGETHER]
                ids = np.array(self._ids(lead + between.join(some)), "<u4")
                cuts = np.flatnonzero(ids == self.part_id).tolist()
                if len(cuts) != len(some) - 1:  # a word holds the token that parts them
                    coded.update((front + w, first + self._whole(lead + w)) for w in some)
                    continue
                raw = ids.tobytes()
                starts, ends = [0, *(4 * c + 4 for c in cuts)], [*(4 * c for c in cuts), len(raw)]
                found = [raw[a:b] for a, b in zip(starts, ends)]
                if bare:
                    some, found = [front + word for word in some], [first + ids for ids in found]
                coded.update(zip(some, found))
        return coded

    def _parted(self, texts: Sequence[str]) -> tuple[list[list[str]], set[str]]:
        """Segments of each text that can be cut, of others none; and all that are new.

        White space next to white space shows in the few distinct segments, so texts need not
        be searched for it: a segment is empty, or has some at an end.
        """
        parted = [[] if self._marked(text) else self.segments(text) for text in texts]
        known = self.known
        new = set().union(*parted).difference(known)
        if not self.spaced:
            return parted, new
        bodies = [part[1:] if part[0] == "\n" else part for part in new if part and part != "\n"]
        # Parts that are words and nothing else, as most are, need not be searched one by one.
        if "" in new or " ".join(bodies).split() != bodies:
            search = _ODD.search
            self.odd.update([part for part in new if search(part) and part != "\n"])
        for i, (text, parts) in enumerate(zip(texts, parted)):
            if "\n\n" in text or "\n " in text or not self.odd.isdisjoint(parts):
                parted[i] = []
        new -= self.odd
        if len(self.odd) > 1_000:
            self.odd.clear()
        return parted, new

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        parted, new = self._parted(texts)
        cut = [bool(parts) for parts in parted]
        full = self.held is not None and self.holding > self.held
        if full or len(self.known) + len(new) > self.remembered:
            self.known, self.before, self.holding = {}, self.known, 0
            new = set().union(*parted)
        again = new & self.before.keys()
        self.known.update((part, self.before[part]) for part in again)
        self._learn(new - again)
        if self.held is not None:
            self.holding += _ENTRY * len(new) + _CHARACTER * sum(map(len, new))
        find = self.known.__getitem__
        # The first segment had a line end put in front.
        skip = 4 if self.spaced else 0
        return [
            b"".join(map(find, parts))[skip:] if ok else self._uncut(text)
            for text, parts, ok in zip(texts, parted, cut)
        ]


def encoder(
    path: str, spaced: bool, remembered: int = REMEMBERED, special: bool = False, held: int | None = None
) -> Encoder:
    """One encoder per worker and vocabulary; it lives as long as the worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (path, spaced, remembered, special, held)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int, the end id last) of every row.

    A null or empty text is the end id alone. Null and repeated ``doc_id`` are
    kept as they are; other columns are not read. A worker remembers segments in
    ``HELD_BYTES`` twice, and holds a long text besides, so texts without spaces take no more.
    """
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")
    last = np.array([end], "<u4").tobytes()

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        encode = encoder(path, True, special=True, held=HELD_BYTES)
        for part in of_bounded_size(batch, size=CUT_BYTES):
            coded = [c + last for c in encode([t or "" for t in part["text"].to_pylist()])]
            offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
            ids = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            yield {"doc_id": part["doc_id"], "ids": pa.ListArray.from_arrays(offsets, ids)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), per_batch, f"doc_id {kind}, ids array<int>")


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end: int = END,
    stripe_bytes: int = 16 << 20,
    rows_per_index_entry: int = 1_000,
) -> None:
    """Encode ``docs`` into ORC files below ``path``, in ascending ``doc_id`` order.

    Texts are dealt by ranges of ``doc_id`` (nulls first), so file after file
    and row after row the ids ascend; ``block`` numbers the files and ``nth`` the
    rows in one. ORC picks run-length and delta encodings for the ids itself.
    """
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    coded = encode_documents(dealt, vocabulary, end)
    numbered = coded.select(
        F.spark_partition_id().alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"),
        "doc_id",
        F.size("ids").alias("n_tokens"),
        "ids",
    )
    (
        numbered.write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", rows_per_index_entry)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_files(
    spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None
) -> DataFrame:
    """``block``, ``nth``, ``doc_id``, ``n_tokens`` and ``ids`` from the files.

    ``doc_ids`` reads some documents only: the condition goes into the scan,
    where footers, row indexes and Bloom filters skip what can't match.
    """
    rows = spark.read.schema(
        "block int, nth bigint, doc_id bigint, n_tokens int, ids array<int>"
    ).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids before a document: those of earlier blocks (one
    row a file is summed for that) and those before it in its own block, where
    rows stand in order.
    """
    find_library(spark)
    rows = read_token_files(spark, path)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": batch["block"],
                    "nth": batch["nth"],
                    "doc_id": batch["doc_id"],
                    "n_tokens": pa.array(np.diff(at), pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    digest = rows.mapInArrow(
        check, "block int, nth bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    )
    totals = rows.groupBy("block").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        "block",
        (F.sum("total").over(Window.orderBy("block")) - F.col("total")).alias("before"),
    )
    in_block = Window.partitionBy("block").orderBy("nth")
    start = F.col("before") + F.sum("n_tokens").over(in_block) - F.col("n_tokens")
    return digest.join(before, "block").select(
        "doc_id", start.alias("start"), "n_tokens", "ids_crc32"
    )


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf}/documents.parquet"), path)
    return token_digest(spark, path)
