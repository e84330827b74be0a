"""SentencePiece encoding and decoding by Viterbi in numpy, many words at once.

The best segmentation of a word is the one with the highest sum of piece scores.
Words of equal length advance together: hashes of all their substrings of one
length, from prefix hashes, are looked up in the sorted hashes of the pieces of
that length, and position after position one vectorised maximum stores where the
best last piece starts. No piece goes from one word into the next, so texts are
cut at spaces and each distinct word is encoded once per worker.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shaftline.llm.common import map_arrow, of_bounded_size, tokenizer_path

SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# What an unknown character costs more than the worst piece.
UNKNOWN_PENALTY = 10.0
# Words a worker remembers before it starts anew.
REMEMBERED = 800_000
# Characters of the words that advance together.
TOGETHER = 1 << 20
_models: dict[str, "Pieces"] = {}


class Pieces:
    """The pieces of a model file, by length and hash."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.of_byte = {i: b for b, i in enumerate(self.bytes)}
        normal = [i for i in range(n) if i not in special and not model.is_byte(i)]
        self.scores = _log_scores(np.array([model.get_score(i) for i in range(n)]))
        self.unknown = float(self.scores[normal].min()) - UNKNOWN_PENALTY
        if any(SPACE in self.text[i].lstrip(SPACE) or "\n" in self.text[i] for i in normal):
            raise ValueError("pieces that go over a space or a line end are not supported")
        self.known: dict[str, bytes] = {}
        self._file(normal)

    def _file(self, normal: list[int]) -> None:
        by_length = defaultdict(list)
        for i in normal:
            by_length[len(self.text[i])].append(i)
        base = 0x9E3779B97F4A7C15
        while True:
            self.base, self.tables, clash = np.uint64(base), {}, False
            for length, ids in by_length.items():
                hashes = self._prefixes(_code_points([self.text[i] for i in ids]))[:, -1]
                order = np.argsort(hashes)
                hashes, own = hashes[order], np.array(ids)[order]
                clash |= bool((hashes[1:] == hashes[:-1]).any())
                self.tables[length] = (hashes, own, self.scores[own])
            if not clash:
                return
            base += 2

    def _prefixes(self, points: np.ndarray) -> np.ndarray:
        """Polynomial hashes of all prefixes, modulo 2 ** 64."""
        out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        for j in range(points.shape[1]):
            out[:, j + 1] = out[:, j] * self.base + points[:, j]
        return out

    def _advance(self, words: list[str]) -> list[list[int]]:
        """Ids of words of one length, -1 for a character that is no piece."""
        points = _code_points(words)
        n, size = points.shape
        prefixes = self._prefixes(points)
        lengths = sorted((x for x in self.tables if x <= size), reverse=True)
        score = np.full((len(lengths), n, size + 1), -np.inf)
        piece = np.full((len(lengths), n, size + 1), -1, np.int32)
        powers = np.full(size + 1, self.base)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        for k, length in enumerate(lengths):
            hashes, ids, own = self.tables[length]
            found = prefixes[:, length:] - prefixes[:, :-length] * powers[length]
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            hit = hashes[at] == found
            score[k, :, length:][hit] = own[at[hit]]
            piece[k, :, length:][hit] = ids[at[hit]]
        if 1 not in lengths:
            lengths, score = [*lengths, 1], np.concatenate([score, score[:1] * 0 - np.inf])
            piece = np.concatenate([piece, piece[:1] * 0 - 1])
        single = score[-1, :, 1:]
        single[np.isneginf(single)] = self.unknown
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        chosen = np.zeros((n, size + 1), np.int8)
        rows = np.arange(n)
        for end in range(1, size + 1):
            first = next(k for k, x in enumerate(lengths) if x <= end)
            starts = [end - x for x in lengths[first:]]
            sums = best[:, starts].T + score[first:, :, end]
            # Of equal sums the first: the longest last piece.
            pick = sums.argmax(axis=0)
            best[:, end] = sums[pick, rows]
            chosen[:, end] = pick + first
        ends = np.full(n, size)
        steps = []
        length_of = np.array(lengths)
        while (live := ends > 0).any():
            pick = chosen[rows, ends]
            steps.append(np.where(live, piece[pick, rows, ends], -2))
            ends = np.where(live, ends - length_of[pick], 0)
        back = np.array(steps[::-1]).T
        return [[i for i in row if i != -2] for row in back.tolist()]

    def _ids(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        by_length = defaultdict(list)
        for word in words:
            by_length[len(word)].append(word)
        for length, group in by_length.items():
            step = max(1, TOGETHER // (length * len(self.tables)))
            for at in range(0, len(group), step):
                some = group[at : at + step]
                yield from zip(some, self._advance(some))

    def _encode_words(self, words: list[str]) -> None:
        for word, ids in self._ids(words):
            at, out = 0, []
            for i in ids:
                if i < 0:
                    out += [self.bytes[b] for b in word[at].encode("utf-8", "surrogatepass")]
                    at += 1
                elif word.startswith(self.text[i], at):
                    out.append(i)
                    at += len(self.text[i])
                else:
                    raise ArithmeticError(f"two substrings share a hash in {word!r}")
            self.known[word] = np.array(out, "<u4").tobytes()

    def words(self, text: str) -> list[str]:
        """Parts of a text no piece goes over: at line ends and before spaces."""
        if not text:
            return []
        lines = (SPACE + text.replace(" ", SPACE)).split("\n")
        parts = []
        for line in lines:
            if SPACE + SPACE in line:
                parts += _CHUNK.findall(line)
            else:
                head, *rest = line.split(SPACE)
                parts += [head] if head else []
                parts += [SPACE + word for word in rest]
            parts.append("\n")
        return parts[:-1]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parted = [self.words(text) for text in texts]
        known = self.known
        new = list({w for parts in parted for w in parts if w not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({w for parts in parted for w in parts})
        self._encode_words(new)
        return [b"".join(map(known.__getitem__, parts)) for parts in parted]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of some ids; the space put before its first word is taken off."""
        raw = b"".join(
            bytes([self.of_byte[i]]) if i in self.of_byte else self.text[i].encode() for i in ids
        )
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def _log_scores(scores: np.ndarray) -> np.ndarray:
    """Scores that add up along a text.

    A unigram model has log-probabilities. A merge model has merge ranks, as
    whole numbers from 0 down, whose sums mean nothing; frequency falls with
    rank, so they are read as -log(1 + rank).
    """
    ranks = (scores <= 0).all() and (scores == np.rint(scores)).all()
    return -np.log1p(-scores) if ranks else scores


def _code_points(words: list[str]) -> np.ndarray:
    """Words of equal length as rows of code points."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.reshape(len(words), -1).astype(np.uint64)


def pieces(path: str) -> Pieces:
    """One model per worker and file."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode_pieces(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row; no ids for a null or
    empty text. Other columns are not read, repeated rows are encoded alike."""
    path = model or tokenizer_path("piece_bpe_32k.model")

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch):
            coded = pieces(path).encode([t or "" for t in part["text"].to_pylist()])
            offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
            ids = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            yield {"doc_id": part["doc_id"], "ids": pa.ListArray.from_arrays(offsets, ids)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), per_batch, f"doc_id {kind}, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``; null ids are no text."""
    path = model or tokenizer_path("piece_bpe_32k.model")

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        texts = [None if i is None else pieces(path).decode(i) for i in batch["ids"].to_pylist()]
        yield {"doc_id": batch["doc_id"], "text": pa.array(texts, pa.string())}

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(encoded.select("doc_id", "ids"), per_batch, f"doc_id {kind}, text string")


def piece_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row: number of ids, of those that stand for single bytes, their CRC-32,
    and that of the text they decode to."""
    path = model or tokenizer_path("piece_bpe_32k.model")

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        own = pieces(path)
        single = np.zeros(len(own.text), bool)
        single[own.bytes] = True
        lists = batch["ids"]
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        at = np.cumsum([0, *(len(x) for x in lists)])
        fallback = np.concatenate([[0], np.cumsum(single[ids])])
        rows = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
        texts = [own.decode(row.tolist()) for row in rows]
        yield {
            "doc_id": batch["doc_id"],
            "n_tokens": pa.array(np.diff(at), pa.int64()),
            "n_byte_tokens": pa.array(np.diff(fallback[at]), pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(row.tobytes()) for row in rows], pa.int64()),
            "decoded_crc32": pa.array(
                [zlib.crc32(t.encode("utf-8", "replace")) for t in texts], pa.int64()
            ),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        encode_pieces(docs, path),
        per_batch,
        f"doc_id {kind}, n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint, "
        "decoded_crc32 bigint",
    )


def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return piece_digest(spark.read.parquet(f"{sf}/documents.parquet"))
