"""Quality rules on repetition, from suffix arrays.

The texts of a batch are sorted as one sequence of words by prefix doubling;
the document is part of a word's first rank, so no match crosses documents.
Longest common prefixes of neighbours in that order give for each position the
longest piece that occurs again in its document. Those that no longer piece to
their left contains are the maximal repeats; their spans are united, and the
verdict limits the share of the text they cover and the longest of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shaftline.llm.common import map_arrow, of_bounded_size, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """What a text may have at most, and how many words it needs.

    A repeat counts from ``window`` words on; ``repeat_words`` limits, in percent
    of words, what such repeats cover, ``covered_bytes`` the same in percent of the
    bytes of all words, and ``longest`` the length of one repeat in words.
    """

    window: int = 5
    fewest_words: int = 10
    repeat_words: int = 20
    covered_bytes: int = 25
    longest: int = 100


LIMITS = Limits()


def suffix_ranks(first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... elements; in the last,
    all differ.

    ``first`` ranks single elements and differs between documents; ``end`` is
    where an element's document ends. Each round sorts only suffixes that are
    still tied.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], np.diff(first[order]) != 0]))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(new, np.diff(np.append(new, n)))
    levels, h = [rank.astype(np.int32)], 1
    tied = order[np.bincount(rank, minlength=n)[rank[order]] > 1]
    while len(tied):
        after = tied + h
        inside = after < end[tied]
        # Behind the end of a document comes what is smaller than any rank.
        key = rank[tied] * (n + 1)
        key[inside] += rank[after[inside]] + 1
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        old = rank[tied]
        at = np.arange(len(tied))
        starts_old = np.concatenate([[True], np.diff(old) != 0])
        starts_new = np.concatenate([[True], np.diff(key) != 0])
        group = np.maximum.accumulate(np.where(starts_old, at, 0))
        part = np.maximum.accumulate(np.where(starts_new, at, 0))
        rank = rank.copy()
        rank[tied] = old + part - group
        levels.append(rank.astype(np.int32))
        size = np.diff(np.append(np.flatnonzero(starts_new), len(tied)))
        tied = tied[np.repeat(size, size) > 1]
        h *= 2
    return levels


def longest_matches(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position the length of the longest piece from it on that occurs
    once more in its document.

    That is the longer of its common prefixes with the neighbours in suffix
    order, found by halving steps over the ranks.
    """
    n = len(first)
    if n == 0:
        return np.zeros(0, np.int64)
    levels = suffix_ranks(first, end)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    alike = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[alike], b[alike]
    got = np.zeros(len(alike), np.int64)
    stop_a, stop_b = end[a], end[b]
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + got, b + got
        ok = np.flatnonzero((x < stop_a) & (y < stop_b))
        same = ok[levels[k][x[ok]] == levels[k][y[ok]]]
        got[same] += 1 << k
    lcp[alike] = got
    most = np.zeros(n, np.int64)
    most[suffixes[1:]] = lcp
    np.maximum.at(most, suffixes[:-1], lcp)
    return most


def maximal_repeats(most: np.ndarray, begins: np.ndarray, least: int) -> np.ndarray:
    """Positions where a maximal repeat of ``least`` elements or more starts: the
    match there reaches further than the one from the position before."""
    before = np.concatenate([[0], most[:-1]])
    before[begins] = 0
    return np.flatnonzero((most >= least) & (most >= before))


def _batch(texts: list[str | None], limits: Limits) -> dict[str, list[object]]:
    split = [words(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    begins = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    flat = [w for own in split for w in own]
    ids: dict[bytes, int] = {}
    for w in flat:
        ids.setdefault(w, len(ids))
    number = np.fromiter(map(ids.__getitem__, flat), np.int64, n)
    width = np.fromiter((len(w) for w in flat), np.int64, n)
    doc = np.repeat(np.arange(len(texts)), sizes)
    most = longest_matches(doc * (len(ids) + 1) + number, np.repeat(begins + sizes, sizes))
    spans = maximal_repeats(most, begins[sizes > 0], limits.window)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, spans, 1)
    np.add.at(depth, spans + most[spans], -1)
    covered = np.cumsum(depth[:-1]) > 0

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[begins + sizes] - total[begins]

    repeat_words = per_text(covered)
    covered_bytes, all_bytes = per_text(np.where(covered, width, 0)), per_text(width)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc, most)
    out: dict[str, list[object]] = {
        "n_words": sizes.tolist(),
        "word_chars": [len(t) - sum(map(t.count, BLANKS)) if t else 0 for t in texts],
        "n_symbols": [sum(map(t.count, SYMBOLS)) if t else 0 for t in texts],
        "n_dup_lines": [_repeated_lines(t) if t and "\n" in t else 0 for t in texts],
        "n_repeat_words": repeat_words.tolist(),
    }
    base = (sizes < limits.fewest_words) | (100 * repeat_words > limits.repeat_words * sizes)
    method = (100 * covered_bytes > limits.covered_bytes * all_bytes) | (longest > limits.longest)
    out |= {
        "base_failed": base.tolist(),
        "kept": (~base & ~method).tolist(),
        "longest_repeat": longest.tolist(),
        "covered_bytes": covered_bytes.tolist(),
    }
    return out


def _repeated_lines(text: str) -> int:
    seen = Counter(line for line in text.split("\n") if line.strip(BLANKS))
    return sum(seen.values()) - len(seen)


_RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, longest_repeat bigint, "
    "covered_bytes bigint"
)


def repetition(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counts and verdict for every row of ``docs``.

    Each text is judged by itself, so rows stay where they are. A null or empty
    text has no words and fails; copies of a row get the same verdict; columns
    other than ``doc_id`` and ``text`` are not read.
    """

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch, size=2_000_000):
            yield {"doc_id": part["doc_id"]} | _batch(part["text"].to_pylist(), limits)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), per_batch, f"doc_id {kind}, {_RESULT}")


def drop_repetitive(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Rows of ``docs`` whose text the rules keep, all columns as they were.

    Rows pass through whole and are filtered in place, without a shuffle.
    """

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch, size=2_000_000):
            kept = pa.array(_batch(part["text"].to_pylist(), limits)["kept"], pa.bool_())
            chosen = part.filter(kept)
            yield dict(zip(chosen.schema.names, chosen.columns))

    return map_arrow(docs, per_batch, docs.schema)


def op2_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return repetition(spark.read.parquet(f"{sf}/documents.parquet"))
