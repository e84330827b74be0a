"""Brown class-based n-gram scores.

Words belong to classes; a text's probability is that of its sequence of classes,
times that of each word given its class. Exchange clustering assigns the classes:
each unit in turn is offered to every class and moves to the one that raises the
likelihood of the training text most.

Units are what is clustered: every word that the training texts hold ``LEAST`` times
or more, and for rarer and unseen words their ending, one of ``ENDINGS``. All other
figures are over all words: each has its own emission count, and a class passes
on a discount to words it has not seen.

Texts are parted into tokens once and stored in chunks of about ``CHUNK`` tokens, numbered by the distinct
words of the chunk; counts and units are joined to these words, and every later pass is over
numbers. Classes of up to ``HELD`` units, a byte each, go along with the tasks; more are a
table that is joined to the words of the chunks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, lower_words, of_bounded_size, stored

CLASSES = 64
LEAST = 3
ENDINGS = 256
# Two sweeps, in which each unit has its turn once, that raise the likelihood by less than this
# share of what all sweeps have raised it by are the last ones.
TOLERANCE = 0.02
TRANSITION_SMOOTHING = 0.1
HELD_OUT_FOLD, FOLDS = 2, 7
CHUNK = 1 << 21
HELD = 1 << 25
# Distinct keys a task gathers before it passes them on, and counts it compares at a time.
GATHERED = 1 << 20
BLOCK = 1 << 14
# Counts of neighbours that are looked up instead of calculated with.
SMALL = 16
# Units in one row of counts, at most, and rows they are spread over if there are that many.
TOGETHER, BLOCKS = 1 << 11, 1 << 10
# Tokens a task counts at a time.
COUNTED = 1 << 16
# No word is empty, so the empty one stands for the end of a text. It is unit 0, and word 0
# of each chunk; endings follow, then words of their own.
END = b""
FIRST_OWN = 1 + ENDINGS


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; one without an id is not."""
    digest = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(digest, F.lit(FOLDS)) == HELD_OUT_FOLD, F.lit(False))


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def _ending_column(word: Column) -> Column:
    last = F.substring(word, F.greatest(F.lit(1), F.octet_length(word) - 2), F.lit(3))
    return F.pmod(F.crc32(last), F.lit(ENDINGS))


def _list(values: pa.Array) -> pa.ListArray:
    """One row with all of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _planes(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as many bytes each as the largest one needs, which the first byte says, all
    lowest bytes first: the high ones are mostly zeros, which files and shuffles compress away."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    kind = np.int32 if width < 4 else np.int64
    planes = numbers.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)[:, :width].T
    return bytes([width]) + planes.tobytes()


def _from_planes(raw: pa.Scalar | bytes) -> np.ndarray:
    data = np.frombuffer(raw if isinstance(raw, bytes) else raw.as_buffer(), np.uint8)
    width = int(data[0])
    planes = data[1:].reshape(width, -1)
    kind = np.int32 if width < 4 else np.int64
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    for i, plane in enumerate(planes):
        out[:, i] = plane
    return out.view(kind).ravel()


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-case words of all texts, one behind the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)  # white space at the ends of a text leaves an empty one
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return flat.filter(real).cast(pa.binary()), np.diff(before[ends], prepend=0)


def chunked(docs: DataFrame) -> DataFrame:
    """``docs`` as rows of whole documents with about ``CHUNK`` tokens: the distinct ``words`` and how
    often each is in training texts, ``tokens`` of training documents as numbers of words (``_planes``), an end behind
    each document, ``others`` of those held out, and ``lengths``, ``doc_ids`` and ``held`` per document, training
    documents first."""
    find_library(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        tokens: list[pa.DictionaryArray] = []
        lengths: list[np.ndarray] = []
        ids: list[pa.Array] = []
        held: list[pa.Array] = []

        def row() -> pa.RecordBatch:
            # Words are numbered as they come up, behind the end.
            of = pa.concat_arrays([t.dictionary for t in tokens]).dictionary_encode()
            number, starts = of.indices.to_numpy(), np.cumsum([0, *(len(t.dictionary) for t in tokens)])
            sizes, out = np.concatenate(lengths).astype(np.int32), pa.concat_arrays(held)
            flat = np.zeros(sizes.sum(), np.int32)
            is_word = np.ones(len(flat), bool)
            is_word[np.cumsum(sizes) - 1] = False
            flat[is_word] = np.concatenate([number[t.indices.to_numpy() + at] for t, at in zip(tokens, starts)]) + 1
            words = pa.concat_arrays([pa.array([END], pa.binary()), of.dictionary])
            apart = out.to_numpy(zero_copy_only=False)
            trained = np.repeat(~apart, sizes)
            documents = np.argsort(apart, kind="stable")
            # Frequent words get low numbers, the end 0.
            often = np.bincount(flat, minlength=len(words))
            often[0] = len(flat) + 1
            order = np.argsort(-often, kind="stable")
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words))
            columns = {
                "chunk": pa.array([next(numbers)], pa.int64()),
                "words": _list(words.take(pa.array(order))),
                "n": _list(pa.array(np.bincount(flat[trained], minlength=len(words)).astype(np.int64)[order])),
                "tokens": pa.array([_planes(place[flat[trained]])], pa.binary()),
                "others": pa.array([_planes(place[flat[~trained]])], pa.binary()),
                "lengths": _list(pa.array(sizes[documents])),
                "doc_ids": _list(pa.concat_arrays(ids).take(pa.array(documents))),
                "held": _list(pa.array(apart[documents])),
            }
            for gathered in (tokens, lengths, ids, held):
                gathered.clear()
            return pa.RecordBatch.from_pydict(columns)

        gathered = 0
        for batch in batches:
            for part in of_bounded_size(batch):
                words, n = _words(part["text"])
                ends, start = np.cumsum(n), 0
                totals = np.cumsum(n + 1)
                while start < len(n):
                    done = totals[start - 1] if start else 0
                    end = min(int(np.searchsorted(totals, CHUNK - gathered + done)) + 1, len(n))
                    first = int(ends[start - 1]) if start else 0
                    tokens.append(words.slice(first, int(ends[end - 1]) - first).dictionary_encode())
                    lengths.append(n[start:end] + 1)
                    ids.append(part["doc_id"].slice(start, end - start))
                    held.append(part["out"].slice(start, end - start))
                    gathered += int(totals[end - 1] - done)
                    start = end
                    if gathered >= CHUNK:
                        yield row()
                        gathered = 0
        if lengths:
            yield row()
        pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("out"), "text").mapInArrow(
        run,
        "chunk bigint, words array<binary>, n array<bigint>, tokens binary, others binary, lengths array<int>, "
        f"doc_ids array<{kind}>, held array<boolean>",
    )


def word_counts(chunks: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all training texts, one end for each of them; a word costs one
    row a chunk."""
    listed = chunks.select("n", F.posexplode("words").alias("at", "word"))
    rows = listed.select("word", F.col("n")[F.col("at")].alias("n")).where("n > 0")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def numbered(counts: DataFrame) -> tuple[DataFrame, int]:
    """``word``, ``n`` and ``unit`` of all counted words, and how many units there are.

    Numbers are given per partition of the stored words and moved together by the sizes of
    the partitions before.
    """
    own = (F.col("n") >= LEAST) & (F.col("word") != F.lit(END))
    placed = stored(counts.where(own).withColumn("id", F.monotonically_increasing_id()), "units")
    part = F.shiftright("id", 33)
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())
    starts, at = [], FIRST_OWN
    for p in sorted(sizes):
        starts.append((p, at))
        at += sizes[p]
    columns = dict(zip(("part", "start"), np.array(starts, np.int64).reshape(-1, 2).T))
    offsets = counts.sparkSession.createDataFrame(pa.table(columns))
    mask = F.lit((1 << 33) - 1)
    units = (
        placed.withColumn("part", part)
        .join(F.broadcast(offsets), "part")  # one row a partition
        .select("word", "n", (F.col("start") + F.col("id").bitwiseAND(mask)).alias("unit"))
    )
    shared = counts.where(~own).select("word", "n", _shared_unit(F.col("word")).alias("unit"))
    return units.unionByName(shared), at


def _shared_unit(word: Column) -> Column:
    return F.when(word == F.lit(END), F.lit(0)).otherwise(1 + _ending_column(word)).cast("bigint")


def coded_chunks(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """``chunks`` with count ``n`` and ``units`` of each of their words instead of the word
    (``_planes``). What is joined by word goes back to its chunk in one row a task."""
    listed = chunks.select("chunk", F.posexplode("words").alias("at", "word"))
    unit = F.coalesce("unit", _shared_unit(F.col("word"))).alias("unit")
    # Neither side is sorted: a task's share of the distinct words is small.
    joined = listed.join(words.hint("shuffle_hash"), "word", "left")
    found = joined.select("chunk", "at", F.coalesce("n", F.lit(0)).alias("n"), unit)

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = {c: np.concatenate([b[c].to_numpy() for b in held]) for c in ("chunk", "at", "n", "unit")}
        order = np.argsort(columns["chunk"], kind="stable")
        chunk = columns["chunk"][order]
        starts = np.flatnonzero(np.diff(chunk, prepend=-1))
        out: dict[str, object] = {"chunk": pa.array(chunk[starts])}
        for c in ("at", "n", "unit"):
            parts = np.split(columns[c][order], starts[1:])
            out[c] = pa.array([_planes(part) for part in parts], pa.binary())
        return pa.RecordBatch.from_pydict(out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > GATHERED:
                yield rows(held)
                held = []
        if sum(b.num_rows for b in held):
            yield rows(held)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch[name] for name in kept}
            for c in ("n", "units"):
                columns[c] = []
            for facts in batch["facts"].to_pylist():
                at = np.concatenate([_from_planes(f["at"]) for f in facts])
                for c, name in (("n", "n"), ("units", "unit")):
                    values = np.empty(len(at), np.int64)
                    values[at] = np.concatenate([_from_planes(f[name]) for f in facts])
                    columns[c].append(_planes(values))
            for c in ("n", "units"):
                columns[c] = pa.array(columns[c], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    packed = found.mapInArrow(pack, "chunk bigint, at binary, n binary, unit binary")
    facts = packed.groupBy("chunk").agg(F.collect_list(F.struct("at", "n", "unit")).alias("facts"))
    kept = ("chunk", "tokens", "others", "lengths", "doc_ids", "held")
    doc_ids = chunks.schema["doc_ids"].dataType.simpleString()
    return chunks.select(*kept).join(facts, "chunk").mapInArrow(
        place,
        f"chunk bigint, tokens binary, others binary, lengths array<int>, doc_ids {doc_ids}, held array<boolean>, "
        "n binary, units binary",
    )


class HeldClasses:
    """The class of each unit, in every task."""

    def __init__(self, classes: np.ndarray) -> None:
        self.classes = classes
        self.units = len(classes)

    def onto(self, coded: DataFrame) -> DataFrame:
        return coded

    def look_up(self) -> Callable[[pa.RecordBatch, int], np.ndarray]:
        classes = self.classes
        return lambda batch, i: classes[_numbers(batch, "units", i)].astype(np.int64)

    def moved(self, moves: DataFrame) -> HeldClasses:
        # Up to HELD units pass through the driver.
        table = moves.select(F.col("unit").cast("int"), F.col("class").cast("tinyint")).toArrow()
        classes = self.classes.copy()
        classes[table["unit"].to_numpy()] = table["class"].to_numpy()
        return HeldClasses(classes)


class TabledClasses:
    """The same as a table, for any number of units."""

    def __init__(self, classes: DataFrame, units: int) -> None:
        self.classes = classes
        self.units = units

    def onto(self, coded: DataFrame) -> DataFrame:
        def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    units = _numbers(batch, "units", i).astype(np.int64)
                    chunk = np.full(len(units), batch["chunk"][i].as_py())
                    at = np.arange(len(units), dtype=np.int32)
                    columns = {"chunk": chunk, "at": at, "unit": units}
                    yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

        listed = coded.select("chunk", "units").mapInArrow(one_by_one, "chunk bigint, at int, unit bigint")
        per_chunk = (
            listed.join(self.classes, "unit")
            .groupBy("chunk")
            .agg(F.sort_array(F.collect_list(F.struct("at", "class"))).alias("x"))
        )
        return coded.join(per_chunk.select("chunk", F.col("x.class").alias("classes")), "chunk")

    def look_up(self) -> Callable[[pa.RecordBatch, int], np.ndarray]:
        return lambda batch, i: _values(batch, "classes", i).astype(np.int64)

    def moved(self, moves: DataFrame) -> TabledClasses:
        now = F.coalesce("to", "class").alias("class")
        both = self.classes.join(moves.withColumnRenamed("class", "to"), "unit", "left")
        return TabledClasses(stored(both.select("unit", now), "classes"), self.units)


Classes = HeldClasses | TabledClasses


def first_classes(words: DataFrame, n_units: int, classes: int) -> Classes:
    """Words that end alike start in one class."""
    unit = F.col("unit")
    own = words.where(unit >= FIRST_OWN).select("unit", (1 + _ending_column(F.col("word")) % classes).alias("class"))
    if n_units > HELD:
        shared = words.sparkSession.range(FIRST_OWN).select(
            F.col("id").alias("unit"),
            F.when(F.col("id") == 0, F.lit(0)).otherwise(1 + (F.col("id") - 1) % classes).alias("class"),
        )
        both = own.unionByName(shared).selectExpr("unit", "CAST(class AS int) AS class")
        return TabledClasses(stored(both, "classes"), n_units)
    of = np.zeros(n_units, np.int8)
    of[1:FIRST_OWN] = 1 + np.arange(ENDINGS) % classes
    return HeldClasses(of).moved(own)


# What is read of the chunks in a sweep.
_TRAINING = ("chunk", "tokens", "units")


def _values(batch: pa.RecordBatch, column: str, i: int) -> np.ndarray:
    return batch[column][i].values.to_numpy(zero_copy_only=False)


def _numbers(batch: pa.RecordBatch, column: str, i: int) -> np.ndarray:
    return _from_planes(batch[column][i])


def _runs(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts. Where both fit one number, numbers
    are sorted instead of places."""
    bits = int(n.max(initial=0)).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits < 64:
        both = np.sort(keys << bits | n)
        keys, n = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def class_table(coded: DataFrame, assigned: Classes, classes: int) -> np.ndarray:
    """How often a word of one class follows one of another in the training texts."""
    size, look_up = classes + 1, assigned.look_up()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                c = look_up(batch, i).astype(_slot_kind(size))[_numbers(batch, "tokens", i)]
                ahead = 0  # a text starts behind an end
                for at in range(0, len(c), COUNTED):
                    some = c[at : at + COUNTED]
                    pairs = some.astype(np.int64)
                    pairs[0] += ahead * size
                    pairs[1:] += np.multiply(some[:-1], size, dtype=np.int64)
                    table += np.bincount(pairs, minlength=size * size)
                    ahead = int(some[-1])
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(at), "n": pa.array(table[at])})

    counted = assigned.onto(coded.select(*_TRAINING)).mapInArrow(add, "pair bigint, n bigint")
    table = np.zeros(size * size)
    for pair, n in counted.groupBy("pair").agg(F.sum("n")).collect():
        table[pair] = n
    return table.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(table: np.ndarray) -> float:
    """Class part of the log-likelihood of the training text."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=1)).sum() - _xlogx(table.sum(0)).sum())


def _steps(sums: np.ndarray) -> np.ndarray:
    """By how much ``_xlogx`` of each count rises with 1 to ``SMALL`` more: most entries are that small,
    and logarithms are what an offer costs."""
    more = np.arange(1.0, SMALL + 1)[None, :, None]
    return _xlogx(sums[:, None, :] + more) - _xlogx(sums.astype(float))[:, None, :]


def _by_turn(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where entries, which come by row, go so that the first ones of all rows are together, then the second
    ones and so on, each with the rows of most entries ahead; how many each turn has; and those rows in order."""
    n = np.bincount(row, minlength=rows)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(rows, np.int64)
    rank[order] = np.arange(rows)
    turn = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    sizes = np.bincount(turn)
    return (np.cumsum(sizes) - sizes)[turn] + rank[row], sizes, order[: sizes[0] if len(sizes) else 0]


def _rises(totals: np.ndarray, more: np.ndarray, own: np.ndarray, small: np.ndarray) -> np.ndarray:
    """By how much ``_xlogx`` of all ``totals`` rises with ``more`` for each row, which its ``own`` one holds
    already. ``small`` are the ``_steps`` of the totals."""
    whole = np.clip(more, 1, SMALL).astype(np.int64)
    out = small[whole - 1]
    large = np.flatnonzero(more != whole)
    out[large] = _xlogx(totals + more[large, None]) - _xlogx(totals)
    mine = totals[own]
    out[np.arange(len(own)), own] = _xlogx(mine) - _xlogx(mine - more)
    return out


def best_classes(
    table: np.ndarray,
    own: np.ndarray,
    row: np.ndarray,
    slot: np.ndarray,
    n: np.ndarray,
    draw: np.ndarray | int = 0,
    small: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """The class each of some units belongs in, given all other units; its own on a tie, or else
    the one that ``draw`` picks: units that move at once should not all take the first empty class.

    ``own`` are their classes. Their neighbours come as entries, by ``row`` (which unit): ``n`` of class
    ``slot`` before it, ``slot`` - size behind it, and itself behind itself for ``slot`` 2 * size, where size is that
    of the table. Only entries that there are cost a comparison with each class. Class 0 is
    the end's alone. ``small`` are the ``_steps`` of the table and of its transpose, if they are at hand.
    """
    size, rows = len(table), len(own)
    each = np.arange(rows)
    dense = np.zeros((rows, 2 * size + 1))
    dense[row, slot] = n
    before, after, twice = dense[:, :size], dense[:, size:-1], dense[:, -1]
    gain = np.zeros((rows, size))
    for side, sums, other in ((slot < size, table, after), ((slot >= size) & (slot < 2 * size), table.T, before)):
        r = row[side]
        place, sizes, order = _by_turn(r, rows)
        by_turn = np.empty(len(r), np.int64)
        by_turn[place] = np.flatnonzero(side)
        r, x, m = row[by_turn], slot[by_turn] % size, n[by_turn].astype(float)
        mine, at = own[r], np.arange(len(r))
        steps = _steps(sums) if small is None else small[sums is not table]
        whole = np.clip(m, 1, SMALL).astype(np.int64)
        change = steps.reshape(-1, size).take(x * SMALL + whole - 1, axis=0)
        # Counts of the pairs with class x, without those of the unit.
        held = sums[x, mine].astype(float)
        change[at, mine] = _xlogx(held) - _xlogx(held - m)
        one_by_one = np.flatnonzero((m != whole) | (x == mine))
        r_, x_, m_, mine_ = r[one_by_one], x[one_by_one], m[one_by_one], mine[one_by_one]
        rest = sums[x_].astype(float)
        without = _xlogx(sums.astype(float))[x_]
        same = np.flatnonzero(x_ == mine_)
        rest[same] -= other[r_[same]]
        rest[same, mine_[same]] += twice[r_[same]]
        rest[np.arange(len(r_)), mine_] -= m_
        without[same] = _xlogx(rest[same])
        without[np.arange(len(r_)), mine_] = _xlogx(rest[np.arange(len(r_)), mine_])
        m_[same] -= twice[r_[same]]
        change[one_by_one] = _xlogx(rest + m_[:, None]) - without
        change[at, x] = 0.0
        # Adding up by turns goes over whole rows of memory; a sum for each unit would not.
        summed, start = np.zeros((len(order), size)), 0
        for k in sizes.tolist():
            summed[:k] += change[start : start + k]
            start += k
        gain[order] += summed
    # Pairs within a class change only for classes beside the unit.
    both = before + after + twice[:, None]
    both[each, own] -= 2 * twice
    at, c = np.nonzero(both)
    corner, mine = np.diag(table).astype(float)[c], c == own[at]
    corner[mine] += (twice - before[each, own] - after[each, own])[at[mine]]
    gain[at, c] += _xlogx(corner + both[at, c]) - _xlogx(corner)
    for axis, of_unit in ((1, after.sum(axis=1)), (0, before.sum(axis=1))):
        totals = table.sum(axis=axis).astype(float)
        gain -= _rises(totals, of_unit, own, _steps(totals[None, :])[0])
    gain[:, 0] = -np.inf
    best = gain >= gain.max(axis=1, keepdims=True) - 1e-9
    nth = np.cumsum(best, axis=1)
    drawn = (nth == (draw % nth[:, -1] + 1)[:, None]).argmax(axis=1)
    return np.where(best[each, own], own, drawn)


def best_class(
    table: np.ndarray, own: int, before: np.ndarray, after: np.ndarray, twice: float
) -> int:
    """``best_classes`` for one unit with all counts of its neighbours' classes."""
    counts = np.concatenate([before, after, [twice]])
    slots = np.flatnonzero(counts)
    row = np.zeros(len(slots), np.int64)
    return int(best_classes(table, np.array([own]), row, slots, counts[slots])[0])


def _packed(keys: np.ndarray, n: np.ndarray, size: int, together: int) -> Iterator[pa.RecordBatch]:
    """Counts by (unit, class, slot), in order, as one row for ``together`` units that follow each other: which
    they are, their classes and how many slots each has, then all slots and counts. Counts below 255 take a byte, larger ones
    are listed apart."""
    if not len(keys):
        return
    kind = _slot_kind(size)
    own, slot = np.divmod(keys, 2 * size + 1)
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    unit, of = np.divmod(own[starts], size)
    block, place = np.divmod(unit, together)
    units = np.flatnonzero(np.diff(block, prepend=-1))
    entries, large = starts[units], np.flatnonzero(n >= 255)

    def cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
        offsets = (np.append(at, len(values)) * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])

    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array(block[units]),
            "units": cut(place.astype(np.uint16), units),
            "classes": cut(of.astype(kind), units),
            "sizes": cut(np.diff(np.append(starts, len(keys))).astype(kind), units),
            "slots": cut(slot.astype(kind), entries),
            "counts": cut(np.minimum(n, 255).astype(np.uint8), entries),
            "large": cut(n[large], np.searchsorted(large, entries)),
        }
    )


def _slot_kind(size: int) -> type:
    return np.uint8 if 2 * size < 256 else np.int32


def _unpacked(rows: pa.RecordBatch, size: int, together: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (unit, class, slot) and counts of such rows."""

    def flat(column: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(rows[column].to_pylist()), kind)

    kind = _slot_kind(size)
    of_row = pc.binary_length(rows["units"]).to_numpy(zero_copy_only=False) // 2
    unit = np.repeat(rows["block"].to_numpy() * together, of_row) + flat("units", np.uint16)
    own = unit * size + flat("classes", kind)
    keys = np.repeat(own * (2 * size + 1), flat("sizes", kind)) + flat("slots", kind)
    n = flat("counts", np.uint8).astype(np.int64)
    n[n == 255] = flat("large", np.int64)
    return keys, n


def _neighbours(
    tokens: np.ndarray, units: np.ndarray, classes: np.ndarray, size: int, sweep: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys (unit, class, slot), in order, and counts of the neighbours that the units whose turn it is
    have in a chunk. ``units`` and ``classes`` are those of its words.

    Units are numbered within the chunk for it, so that keys are short while they are sorted.
    """
    width = 2 * size + 1
    turn = (units > 0) & ((units + sweep) % 2 == 0)
    own, nth = np.unique(units[turn].astype(np.int64), return_inverse=True)
    kind = np.uint32 if len(own) * width < 1 << 32 else np.int64
    first = np.zeros(len(units), kind)
    first[turn] = nth * width
    class_of = np.zeros(len(own), np.int64)
    class_of[nth] = classes[turn]
    # The class before each token, and that of the last one; a text's first word follows an end.
    c = np.zeros(len(tokens) + 1, _slot_kind(size))
    c[1:] = classes.astype(c.dtype)[tokens]
    at = np.flatnonzero(turn[tokens])
    start = first[tokens[at]]
    # A word that follows its own unit.
    itself = np.flatnonzero((np.diff(at) == 1) & (start[1:] == start[:-1])) + 1
    followed = at[: np.searchsorted(at, len(tokens) - 1)]
    behind = start[: len(followed)] + c[followed + 2] + kind(size)
    keys, n = np.unique(np.concatenate([start + c[at], start[itself] + kind(2 * size), behind]), return_counts=True)
    place, slot = np.divmod(keys.astype(np.int64), width)
    return (own[place] * size + class_of[place]) * width + slot, n


def moves(coded: DataFrame, assigned: Classes, table: np.ndarray, sweep: int) -> DataFrame:
    """``unit`` and ``class`` of units that move: those whose turn it is in this ``sweep`` are offered to all
    classes, by counts of their neighbours' classes.

    Half of the units stand still, which keeps two from swapping for ever. Tasks add up
    counts before they pass them on, so a unit costs at most 2 * classes counts a task, however
    frequent it is; units that follow each other share a row.
    """
    size, look_up = len(table), assigned.look_up()
    width = 2 * size + 1
    together = min(max(assigned.units // BLOCKS, 1), TOGETHER)

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return _runs(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, units = (_numbers(batch, c, i) for c in ("tokens", "units"))
                held.append(_neighbours(tokens, units, look_up(batch, i), size, sweep))
                if sum(len(k) for k, _ in held) > 2 * GATHERED:
                    held = [merged(held)]
                    if len(held[0][0]) > GATHERED:
                        yield from _packed(*held[0], size, together)
                        held = []
        if held:
            yield from _packed(*(merged(held) if len(held) > 1 else held[0]), size, together)

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = _steps(table), _steps(table.T)

        def of_units(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            """The moves of units all counts of which are here."""
            each, slot = np.divmod(keys, width)
            new = np.diff(each, prepend=-1) != 0
            row = np.cumsum(new) - 1
            unit, own = np.divmod(each[new], size)
            to, draw = own.copy(), unit // 2 + sweep
            first = np.searchsorted(row, np.arange(len(own) + 1))
            start = 0
            while start < len(own):
                end = int(np.searchsorted(first, first[start] + BLOCK, "right")) - 1
                end = min(max(end, start + 1), start + BLOCK // 16)
                a, b = first[start], first[min(end, len(own))]
                to[start:end] = best_classes(
                    table, own[start:end], row[a:b] - start, slot[a:b], n[a:b], draw[start:end], small
                )
                start = end
            moved = np.flatnonzero(to != own)
            return pa.RecordBatch.from_pydict(
                {"unit": pa.array(unit[moved]), "class": pa.array(to[moved].astype(np.int32))}
            )

        held: list[tuple[np.ndarray, np.ndarray]] = []  # counts of the last block, which may go on
        last = -1
        for batch in batches:
            for rows in of_bounded_size(batch, "slots", GATHERED):
                block = rows["block"].to_numpy()
                if block[-1] != last:
                    at = int(np.searchsorted(block, block[-1]))
                    if held or at:
                        yield of_units(*merged([*held, _unpacked(rows.slice(0, at), size, together)]))
                    held, last, rows = [], block[-1], rows.slice(at)
                held.append(_unpacked(rows, size, together))
                if sum(len(k) for k, _ in held) > 2 * GATHERED:
                    held = [merged(held)]
        if held:
            yield of_units(*merged(held))

    gathered = assigned.onto(coded.select(*_TRAINING)).mapInArrow(
        gather,
        "block bigint, units binary, classes binary, sizes binary, slots binary, counts binary, large binary",
    )
    # In order of numbers, rows of a block meet without lists of them being built.
    return gathered.repartition("block").sortWithinPartitions("block").mapInArrow(offer, "unit bigint, class int")


def exchange(coded: DataFrame, assigned: Classes, classes: int = CLASSES) -> tuple[Classes, np.ndarray]:
    """The best assignment and its table of class pairs, after sweeps until the likelihood
    stops rising (``TOLERANCE``)."""
    table = class_table(coded, assigned, classes)
    best, best_table = assigned, table
    first = reached = likelihood(table)
    for sweep in count():
        assigned = assigned.moved(moves(coded, assigned, table, sweep))
        table = class_table(coded, assigned, classes)
        if likelihood(table) > likelihood(best_table):
            best, best_table = assigned, table
        if sweep % 2:
            now = likelihood(best_table)
            if now - reached <= TOLERANCE * (now - first):
                return best, best_table
            reached = now
    raise AssertionError("sweeps end by the return above")


@dataclass
class Model:
    """What scoring needs beside the counts of words and the classes of units; bounded in size."""

    tokens: int
    types: int
    discount: float
    transition: np.ndarray  # log10, from class to class
    class_tokens: np.ndarray  # log10
    unseen: np.ndarray  # log10 of what a class passes on, before it is divided

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1) / (self.tokens + self.types + 1))

    def emission(self, n: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of the probability of words, given their classes; the end is the only word of its class."""
        known = np.log10(np.maximum(n - self.discount, 1e-300))
        out = np.where(n > 0, known, self.unseen[classes]) - self.class_tokens[classes]
        return np.where(classes == 0, 0.0, out)


def train(counts: DataFrame, words: DataFrame, classes: Classes, table: np.ndarray) -> Model:
    tokens, types, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count(F.lit(1)),
        F.count_if(F.col("n") == 1),
        F.count_if(F.col("n") == 2),
    ).first()
    discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    size = len(table)
    v_of = np.zeros(size)
    of_unit = words.groupBy("unit").agg(F.count(F.lit(1)).alias("v"))
    if isinstance(classes, HeldClasses):
        # Words of their own are counted here; only the shared units are asked for.
        v_of += np.bincount(classes.classes[FIRST_OWN:], minlength=size)
        for unit, v in of_unit.where(F.col("unit") < FIRST_OWN).collect():
            v_of[classes.classes[unit]] += v
    else:
        by_class = of_unit.join(classes.classes, "unit").groupBy("class").agg(F.sum("v"))
        for c, v in by_class.collect():
            v_of[c] += v
    smoothed = table + TRANSITION_SMOOTHING
    return Model(
        tokens,
        types,
        discount,
        np.log10(smoothed / smoothed.sum(axis=1, keepdims=True)),
        np.log10(np.maximum(table.sum(axis=0), 1.0)),
        np.log10(np.where(v_of > 0, discount * v_of, 1.0)),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the documents not held out and score all, one row per row of ``docs``.

    A null or empty text is one end. Without training documents every word is
    unseen and the base score is 0. Repeated rows count and score one by one. A text of any
    length is scored whole; it is a chunk of its own if it is longer than one, so a task needs about 20 bytes
    a token of it.
    """
    chunks = stored(chunked(docs), "chunks")
    counts = stored(word_counts(chunks), "word-counts")
    words, n_units = numbered(counts)
    coded = stored(coded_chunks(chunks, words), "coded-chunks")
    assigned, table = exchange(coded, first_classes(words, n_units, CLASSES))
    model, look_up = train(counts, words, assigned, table), assigned.look_up()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = np.concatenate([_numbers(batch, side, i) for side in ("tokens", "others")])
                n, c = _numbers(batch, "n", i), look_up(batch, i)
                lengths = _values(batch, "lengths", i).astype(np.int64)
                starts = np.cumsum(lengths) - lengths
                classes = c[tokens]
                ahead = np.concatenate([[0], classes[:-1]])  # a text starts behind an end
                total = model.emission(n, c)[tokens] + model.transition[ahead, classes]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_ids"][i].values,
                        "held_out": batch["held"][i].values,
                        "n_tokens": pa.array(lengths),
                        "n_known": pa.array(np.add.reduceat((n > 0).astype(np.int64)[tokens], starts)),
                        "base_score": pa.array(np.add.reduceat(model.base(n)[tokens], starts)),
                        "score": pa.array(np.add.reduceat(total, starts)),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = assigned.onto(coded).mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op1_class_lm(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf}/documents.parquet"))
