"""Nearest neighbours by inner product, with an adaptive scan over dimensions.

Vectors are scaled, given one more component that makes them all of unit length, and
rotated at random, so that any few dimensions say something about the whole distance.
They are stored in blocks of some lists each, column block by column block. A query reads the
lists nearest to it; after each column block a hypothesis test drops the candidates
whose partial distance is already too large for the best found so far.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, stored

NEAREST = 20
QUERY_EVERY = 20
# The index is fitted on at most so many vectors, and so many bytes of them.
SAMPLE_ROWS = 32_768
SAMPLE_BYTES = 32 << 20
# Queries of the sample that say how many lists hold the neighbours that are asked for.
SAMPLE_QUERIES = 512
# Rows that are held against all lists, or the sample, at a time.
AT_ONCE = 2_048
SAMPLE_RECALL = 0.97
MOST_LISTS = 1_024
# Lists that are read first, whole, to know how near a candidate has to be.
FIRST_LISTS = 8
# Vectors of a block and queries that meet it, on average.
BLOCK_ROWS = 2_048
QUERY_ROWS = 1_024
COLUMNS = 16
# Strictness of the test: a candidate is dropped wrongly with less than one in a thousand.
STRICT = 2.1
_SLACK = 1e-5


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and some not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``gid``, ``embedding`` and ``ids``: the ``keep`` smallest ids of each vector.

    Of equal vectors no others can be among the nearest. Each task passes on ``keep`` ids of a
    vector at most, so one that a third of all rows hold stays small.
    """
    order = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)
    held = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return stored(held.select(F.monotonically_increasing_id().alias("gid"), "*"), "vectors")


@dataclass
class Index:
    """What every task needs to know: a few numbers for each list and dimension."""

    dims: int
    scale: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def matrix(self, vectors: Sequence[Sequence[float]] | pa.Array) -> np.ndarray:
        """Vectors as rows; shorter ones are filled up with zeros."""
        lists = vectors if isinstance(vectors, pa.Array) else pa.array(vectors, pa.list_(pa.float64()))
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if (lengths == self.dims).all():
            return flat.reshape(len(lists), self.dims)
        out = np.zeros((len(lists), self.dims))
        out[np.arange(self.dims)[None, :] < lengths[:, None]] = flat
        return out

    def units(self, matrix: np.ndarray) -> np.ndarray:
        """Candidates: scaled into the unit ball and lifted onto its sphere."""
        small = matrix / self.scale
        lift = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", small, small)))
        return np.hstack([small, lift[:, None]])

    def directions(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries at unit length, and the length they had."""
        most = np.abs(matrix).max(axis=1, initial=0.0)
        small = matrix / most[:, None]
        length = np.sqrt(np.einsum("ij,ij->i", small, small))
        flat = np.hstack([small / length[:, None], np.zeros((len(matrix), 1))])
        return flat, length * most

    def near_lists(self, directions: np.ndarray) -> np.ndarray:
        """All lists, nearest first, for every row."""
        c = self.centroids
        return np.argsort(np.einsum("ij,ij->i", c, c)[None] - 2 * (directions @ c.T), axis=1, kind="stable")

    def assigned(self, units: np.ndarray) -> np.ndarray:
        c = self.centroids
        squares = np.einsum("ij,ij->i", c, c)[None]
        parts = (units[at : at + AT_ONCE] for at in range(0, len(units), AT_ONCE))
        return np.concatenate([np.zeros(0, np.int64), *((squares - 2 * (p @ c.T)).argmin(axis=1) for p in parts)])


def fit(sample: np.ndarray, scale: float, rows: int, nearest: int = NEAREST, seed: int = 0) -> Index:
    """Lists by k-means, about as many as the root of ``rows``, and how many of them a
    query reads so that it finds ``SAMPLE_RECALL`` of its neighbours in the sample."""
    rng = np.random.default_rng(seed)
    n, dims = sample.shape
    rotation = np.linalg.qr(rng.standard_normal((dims + 1, dims + 1)))[0]
    index = Index(dims, scale, rotation, np.zeros((0, dims + 1)), 0)
    units = index.units(sample)
    k = max(1, min(MOST_LISTS, n, round(rows**0.5)))
    index.centroids = units[rng.choice(n, k, replace=False)]
    for _ in range(8):
        own = index.assigned(units)
        sums = np.zeros_like(index.centroids)
        np.add.at(sums, own, units)
        held = np.bincount(own, minlength=k)[:, None]
        index.centroids = np.where(held > 0, sums / np.maximum(held, 1), index.centroids)
    # Lists near each other are neighbours in number, and so meet in the same blocks.
    chain, left = [0], set(range(1, k))
    while left:
        others = np.fromiter(left, np.int64)
        gap = index.centroids[others] - index.centroids[chain[-1]]
        chain.append(int(others[np.einsum("ij,ij->i", gap, gap).argmin()]))
        left.discard(chain[-1])
    index.centroids = index.centroids[chain]
    own = index.assigned(units)
    asked = rng.choice(n, min(n, SAMPLE_QUERIES), replace=False)
    wanted = min(nearest, n - 1)
    if wanted:
        found = np.zeros(k, np.int64)
        for at in range(0, len(asked), 32):
            some = asked[at : at + 32]
            flat, _ = index.directions(sample[some])
            scores = flat @ units.T
            scores[np.arange(len(some)), some] = -np.inf
            best = np.argpartition(-scores, wanted - 1, axis=1)[:, :wanted]
            place = np.argsort(index.near_lists(flat), axis=1)
            found += np.bincount(np.take_along_axis(place, own[best], axis=1).ravel(), minlength=k)
        found = found.cumsum()
        index.probes = int(np.searchsorted(found, SAMPLE_RECALL * found[-1])) + 1
    index.probes = max(index.probes, min(k, FIRST_LISTS))
    return index


def _fitted(vectors: DataFrame, nearest: int) -> tuple[Index, int] | None:
    biggest = F.aggregate("embedding", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x).cast("double")))
    rows, dims, most = vectors.agg(
        F.count(F.lit(1)), F.max(F.size("embedding")), F.max(biggest)
    ).first()
    if not rows:
        return None
    part = F.lit(float(most))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + (x / part) * (x / part))
    longest = vectors.agg(F.sqrt(F.max(square))).first()[0]
    room = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims)))
    some = vectors.orderBy(F.xxhash64("gid"), "gid").limit(room).select("embedding").toArrow()
    shape = Index(dims, 1.0, np.zeros(0), np.zeros(0), 0)
    sample = shape.matrix(some["embedding"].combine_chunks())
    # A little more than the longest, so that no rounding lifts a vector off the sphere.
    return fit(sample, float(most) * longest * (1 + 1e-12), rows, nearest), rows


# ---------------------------------------------------------------------------
# Blocks
# ---------------------------------------------------------------------------


def _assign(vectors: DataFrame, index: Index) -> DataFrame:
    """Each vector with the list it is in."""
    kind = vectors.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = index.assigned(index.units(index.matrix(batch["embedding"])))
            yield pa.RecordBatch.from_arrays(
                [batch["gid"], batch["first"], batch["embedding"], pa.array(own.astype(np.int32))],
                ["gid", "first", "embedding", "list"],
            )

    narrow = vectors.select("gid", F.col("ids")[0].cast("bigint").alias("first"), "embedding")
    return narrow.mapInArrow(run, f"gid bigint, first bigint, embedding {kind}, list int")


@dataclass
class Layout:
    """First block of each list, and how many blocks it is dealt to. Small lists
    next to each other share a block."""

    first: np.ndarray
    spread: np.ndarray

    def deal(self, rows: DataFrame, list_: str, key: str, block: str) -> DataFrame:
        """``rows`` with the ``block`` of their ``list_``, spread by ``key`` where it has several."""
        table = [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(self.first, self.spread))]
        where = rows.sparkSession.createDataFrame(table, f"{list_} int, __start bigint, __spread bigint")
        number = F.col("__start") + F.pmod(F.xxhash64(key), F.col("__spread"))
        return rows.join(where, list_).withColumn(block, number).drop("__start", "__spread")


def _layout(rows: DataFrame, list_: str, lists: int, block_rows: int) -> Layout:
    """For rows that are each in a list; the driver gets one number per list."""
    counted = rows.groupBy(list_).agg(F.count(F.lit(1)).alias("n")).collect()
    return layout({r[list_]: r["n"] for r in counted}, lists, block_rows)


def layout(sizes: dict[int, int], lists: int, block_rows: int) -> Layout:
    first, spread = np.zeros(lists, np.int64), np.ones(lists, np.int64)
    block, held = 0, 0
    for own in range(lists):
        n = sizes.get(own, 0)
        if held and held + n > block_rows:
            block, held = block + 1, 0
        first[own] = block
        if n > block_rows:
            spread[own] = -(-n // block_rows)
            block, held = block + int(spread[own]), 0
        else:
            held += n
    return Layout(first, spread)


_BLOCK = "block bigint, gids array<bigint>, firsts array<bigint>, lists array<int>, rotated binary, originals binary"


def _kind(vectors: DataFrame) -> str:
    """In what numpy type the original components are kept, without loss."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    return "f4" if element == "float" else "f8"


def _blocks(assigned: DataFrame, index: Index, places: Layout) -> DataFrame:
    """One row per block: rotated vectors, column block by column block, and the
    original ones."""
    kind = _kind(assigned)
    dealt = places.deal(assigned, "list", "gid", "block")

    def build(group: pa.Table) -> pa.Table:
        vectors = index.matrix(group["embedding"].combine_chunks())
        rotated = (index.units(vectors) @ index.rotation).astype(np.float32)
        cut = [np.ascontiguousarray(rotated[:, c : c + COLUMNS].T) for c in range(0, rotated.shape[1], COLUMNS)]
        return pa.table(
            {
                "block": group["block"][:1],
                "gids": pa.array([group["gid"].to_pylist()], pa.list_(pa.int64())),
                "firsts": pa.array([group["first"].to_pylist()], pa.list_(pa.int64())),
                "lists": pa.array([group["list"].to_pylist()], pa.list_(pa.int32())),
                "rotated": pa.array([b"".join(c.tobytes() for c in cut)], pa.binary()),
                "originals": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
            }
        )

    narrow = dealt.select("block", "gid", "first", "embedding", "list")
    return narrow.groupBy("block").applyInArrow(build, _BLOCK)


# ---------------------------------------------------------------------------
# Scan
# ---------------------------------------------------------------------------


def scan_block(
    columns: Sequence[np.ndarray], query: np.ndarray, start: np.ndarray, partial: np.ndarray, limit: float, strict: float
) -> np.ndarray:
    """Candidates of ``start`` whose distance to one query can be within ``limit``.

    ``columns`` are blocks of (dimensions, candidates) and ``partial`` the squared distances
    over the first of them. After d of D dimensions a candidate goes if its partial distance,
    carried on to D, exceeds the limit by more than chance explains.
    """
    dims = len(query)
    alive, seen = start, len(columns[0])
    for block in columns[1:]:
        bound = limit * (1 + strict / seen**0.5) ** 2 * seen / dims + _SLACK
        near = partial <= bound
        alive, partial = alive[near], partial[near]
        if not len(alive):
            return alive
        gap = block[:, alive] - query[seen : seen + len(block), None]
        partial = partial + np.einsum("ij,ij->j", gap, gap)
        seen += len(block)
    return alive[partial <= limit + _SLACK]


def _scan(
    queries: pa.Table, blocks: pa.Table, index: Index, kind: str, keep: int, strict: float
) -> dict[str, np.ndarray]:
    gids = blocks["gids"][0].values.to_numpy()
    firsts = blocks["firsts"][0].values.to_numpy()
    lists = blocks["lists"][0].values.to_numpy()
    n = len(gids)
    flat = np.frombuffer(blocks["rotated"][0].as_buffer(), np.float32)
    columns = []
    for c in range(0, index.dims + 1, COLUMNS):
        width = min(COLUMNS, index.dims + 1 - c)
        columns.append(flat[c * n : (c + width) * n].reshape(width, n))
    originals = np.frombuffer(blocks["originals"][0].as_buffer(), kind).reshape(n, index.dims)

    qids = queries["qid"].to_numpy()
    asked = index.matrix(queries["embedding"].combine_chunks())
    flat_queries, lengths = index.directions(asked)
    turned = (flat_queries @ index.rotation).astype(np.float32)
    limits = queries["worst"].to_numpy()
    limits = np.where(np.isnan(limits), 4.0, 2 - 2 * limits / (lengths * index.scale))
    squares = np.einsum("ij,ij->j", columns[0], columns[0])
    # The lists each query reads, and where they are among those of the block.
    names, place = np.unique(lists, return_inverse=True)
    reads = queries["lists"].combine_chunks()
    reader = np.repeat(np.arange(len(asked)), reads.value_lengths().to_numpy())
    member = np.zeros((len(asked), len(names)), bool)
    own = np.searchsorted(names, reads.flatten().to_numpy())
    own[own == len(names)] = 0
    real = names[own] == reads.flatten().to_numpy()
    member[reader[real], own[real]] = True
    out: dict[str, list] = {"qid": [], "gid": [], "first": [], "score": []}
    for at in range(0, len(asked), 128):
        some = turned[at : at + 128, : len(columns[0])]
        partial = np.einsum("ij,ij->i", some, some)[:, None] + squares - 2 * (some @ columns[0])
        for row in range(len(some)):
            q = at + row
            wanted = np.flatnonzero(member[q][place])
            left = scan_block(columns, turned[q], wanted, partial[row, wanted], float(limits[q]), strict)
            if not len(left):
                continue
            score = originals[left].astype(np.float64) @ asked[q]
            order = np.lexsort((firsts[left], -score))[:keep]
            out["qid"].append(np.full(len(order), qids[q]))
            out["gid"].append(gids[left[order]])
            out["first"].append(firsts[left[order]])
            out["score"].append(score[order])
    kinds = {"score": np.float64}
    return {
        name: np.concatenate([np.zeros(0, kinds.get(name, np.int64)), *parts]).astype(kinds.get(name, np.int64))
        for name, parts in out.items()
    }


def _homes(queries: DataFrame, index: Index) -> DataFrame:
    """Queries (``qid``, ``embedding``) with the list nearest to each."""
    kind = queries.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = index.assigned(index.directions(index.matrix(batch["embedding"]))[0])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32))], [*batch.schema.names, "home"]
            )

    return queries.mapInArrow(run, f"qid bigint, embedding {kind}, home int")


def _probed(
    queries: DataFrame, blocks: DataFrame, index: Index, places: Layout, lists: slice, keep: int, strict: float
) -> DataFrame:
    """Best candidates of each query (``qid``, ``embedding``, ``part``, ``worst``) in some of
    its lists, at most ``keep`` per block. A block goes once to each part of the
    queries that reads it."""
    kind, stored_as = queries.schema["embedding"].dataType.simpleString(), _kind(queries)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                flat, _ = index.directions(index.matrix(batch["embedding"]))
                take, block, own = [], [], []
                for row, chosen in enumerate(index.near_lists(flat)[:, lists].tolist()):
                    reads: dict[int, list[int]] = {}
                    for one in chosen:
                        first = int(places.first[one])
                        for b in range(first, first + int(places.spread[one])):
                            reads.setdefault(b, []).append(one)
                    take += [row] * len(reads)
                    block += reads.keys()
                    own += reads.values()
                rows = pa.array(take, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].take(rows) for c in ("qid", "embedding", "worst", "part")),
                     pa.array(block, pa.int64()), pa.array(own, pa.list_(pa.int32()))],
                    ["qid", "embedding", "worst", "part", "number", "lists"],
                )

    narrow = queries.select("qid", "embedding", "worst", "part")
    reading = narrow.mapInArrow(
        deal, f"qid bigint, embedding {kind}, worst double, part bigint, number bigint, lists array<int>"
    )
    reading = stored(reading, "readings")
    wanted = reading.select(F.col("number").alias("block"), F.col("part").alias("to")).distinct()
    sent = blocks.join(wanted, "block")

    def scan(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.table(_scan(left, right, index, stored_as, keep, strict))

    pairs = reading.groupBy("number", "part").cogroup(sent.groupBy("block", "to"))
    return pairs.applyInArrow(scan, "qid bigint, gid bigint, first bigint, score double")


_RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def nearest_vectors(
    embeddings: DataFrame,
    nearest: int = NEAREST,
    every: int = QUERY_EVERY,
    strict: float = STRICT,
    probes: int | None = None,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``nearest`` rows found for each
    row whose ``vec_id`` is divisible by ``every``.

    Every usable row is indexed and can be found; only the lists are fitted on a sample
    (``SAMPLE_ROWS``). Equal vectors are looked for and found once. The score is the inner product of the
    original vectors in double precision, ties go to the smaller ``vec_id``.

    Null, empty and zero vectors, those with a component that is null or not finite, and
    rows without ``vec_id`` take no part; vectors of less components than the longest count as filled up with
    zeros. A row that is repeated counts once; different vectors under one ``vec_id`` are
    all searched, and found, as that id, and none for itself. Fewer rows than ``nearest`` give
    all there are, no rows give none. Other columns are not read.
    """
    spark = embeddings.sparkSession
    find_library(spark)
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    keep = nearest + 1  # one of them can be the query itself
    vectors = distinct_vectors(rows, keep)
    fitted = _fitted(vectors, nearest)
    if fitted is None:
        return spark.createDataFrame([], _RESULT)
    index, _ = fitted
    if probes is not None:
        index.probes = min(probes, len(index.centroids))

    assigned = stored(_assign(vectors, index), "listed-vectors")
    lists = len(index.centroids)
    places = _layout(assigned, "list", lists, block_rows)
    blocks = stored(_blocks(assigned, index, places), "vector-blocks")

    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    asked = asked.join(vectors.select("gid", "embedding"), "embedding").select("vec_id", "gid", "embedding")
    asked = stored(asked, "queries")
    # All queries of a vector have the same candidates. Those whose nearest lists lie
    # together are in one part, as they read much the same blocks.
    each = asked.select(F.col("gid").alias("qid"), "embedding").distinct()
    homes = stored(_homes(each, index), "query-homes")
    queries = _layout(homes, "home", lists, query_rows).deal(homes, "home", "qid", "part")

    start = min(FIRST_LISTS, index.probes)
    fresh = queries.withColumn("worst", F.lit(None).cast("double"))
    seen = stored(_probed(fresh, blocks, index, places, slice(0, start), keep, strict), "first-found")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "first")
    found = seen
    if index.probes > start:
        last = seen.withColumn("nth", F.row_number().over(best)).where(F.col("nth") == keep)
        bounded = queries.join(last.select("qid", F.col("score").alias("worst")), "qid", "left")
        rest = slice(start, index.probes)
        more = _probed(bounded, blocks, index, places, rest, keep, strict)
        found = seen.unionByName(stored(more, "more-found"))

    few = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep)
    named = few.join(vectors.select("gid", F.explode("ids").alias("vec_id")), "gid")
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("nth", F.row_number().over(order))
    # The query's own id can come up once for each different vector it has.
    listed = named.groupBy("qid").agg(
        F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("found")
    )
    mine = asked.select(F.col("gid").alias("qid"), F.col("vec_id").alias("query_id")).distinct()
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = mine.join(listed, "qid").select(
        "query_id", F.posexplode(F.slice(others, 1, nearest)).alias("pos", "it")
    )
    return ranked.select(
        "query_id", (F.col("pos") + 1).alias("rank"), "it.vec_id", "it.score"
    )


def op11_adaptive_scan(spark: SparkSession, sf: str) -> DataFrame:
    return nearest_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
