from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from shaftline.llm import scan

SCHEMA = "vec_id bigint, embedding array<float>, label int, gid int, ids string, score string"


@pytest.fixture
def table(spark):
    """Vectors with columns more whose names the operator uses itself."""

    def build(rows, schema=SCHEMA):
        return spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], schema).repartition(3)

    return build


def usable(vector) -> bool:
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def brute(rows, nearest=20, every=20):
    """The nearest rows of each query by plain sorting; shorter vectors filled up."""
    good = {(i, tuple(np.float32(v).tolist())) for i, v in rows if i is not None and usable(v)}
    dims = max((len(v) for _, v in good), default=0)
    wide = [(i, np.array(v + (0.0,) * (dims - len(v)))) for i, v in sorted(good)]
    out = []
    for i, q in wide:
        if i % every == 0:
            scored = sorted((-float(q @ v), j) for j, v in wide if j != i)
            out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:nearest])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("block_rows, query_rows", [(2_048, 1_024), (7, 2)])
def test_whole_scan_equals_sorting(table, block_rows, query_rows):
    rng = random.Random(1)
    # Small whole numbers: many ties, all scores exact.
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(5)]) for i in range(130)]
    rows += [(200 + i, rows[20][1]) for i in range(40)]  # copies of a query, more than are asked for
    rows += [(300, [9.0] * 5), (301, [0.5, 0.25])]
    rows += [(320, None), (340, []), (360, [0.0] * 5), (380, [1.0, None, 1.0, 1.0, 1.0])]
    rows += [(400, [1.0, float("nan"), 0.0, 0.0, 0.0]), (420, [float("inf")] + [1.0] * 4)]
    rows += [(None, [1.0] * 5), rows[0], rows[40]]
    got = scan.nearest_vectors(table(rows), strict=1e6, probes=10**6, block_rows=block_rows, query_rows=query_rows)
    assert found(got) == brute(rows)


def test_few_rows_and_none(table):
    rows = [(0, [1.0, 2.0]), (20, [3.0, -1.0]), (7, [1.0, 1.0])]
    got = scan.nearest_vectors(table(rows))
    assert found(got) == brute(rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(scan.nearest_vectors(table(rows[:1]))) == []
    empty = scan.nearest_vectors(table([]))
    assert found(empty) == [] and empty.columns == got.columns
    assert found(scan.nearest_vectors(table([(1, None), (2, [0.0])]))) == []


def test_one_id_with_different_vectors(table):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [-1.0, 3.0])]
    got = found(scan.nearest_vectors(table(rows), strict=1e6, probes=9))
    assert [(q, i, s) for q, _, i, s in got] == [
        (q, i, s) for q, _, i, s in sorted(brute(rows), key=lambda r: (r[0], r[1], r[2], r[3]))
    ]


def test_recall_on_vectors_of_any_length(table):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((2_000, 24)) * rng.lognormal(0, 0.5, (2_000, 1))
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(vectors)]
    got, want = found(scan.nearest_vectors(table(rows))), brute(rows)
    assert len(got) == len(want) == 100 * 20
    pairs = {(q, i) for q, _, i, _ in want}
    assert len(pairs & {(q, i) for q, _, i, _ in got}) >= 0.9 * len(pairs)
    exact = {(q, i): s for q, _, i, s in got}
    assert all(abs(s - np.float32(vectors[q]).astype(float) @ np.float32(vectors[i]).astype(float)) < 1e-9 for (q, i), s in exact.items())


def test_the_test_drops_far_candidates_early():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    points = rng.standard_normal((4_000, 64)) @ turn
    query = points[0] + 0.1
    columns = [np.ascontiguousarray(points[:, c : c + 16].T) for c in range(0, 64, 16)]
    gaps = ((points - query) ** 2).sum(axis=1)
    limit = float(np.sort(gaps)[20])
    partial = ((points[:, :16] - query[:16]) ** 2).sum(axis=1)
    left = scan.scan_block(columns, query, np.arange(4_000), partial, limit, scan.STRICT)
    assert set(np.argsort(gaps)[:20]) <= set(left.tolist())
    assert len(left) <= 25
    shares = []
    for seen in (16, 32, 48):
        partial = ((points[:, :seen] - query[:seen]) ** 2).sum(axis=1)
        shares.append((partial <= limit * (1 + scan.STRICT / seen**0.5) ** 2 * seen / 64).mean())
    assert shares == sorted(shares, reverse=True) and shares[-1] < 0.6


def test_lists_share_blocks_and_large_ones_spread():
    places = scan.layout({0: 3, 1: 3, 2: 25, 3: 1}, 5, 10)
    assert places.first.tolist() == [0, 0, 1, 4, 4]
    assert places.spread.tolist() == [1, 1, 3, 1, 1]


def test_short_vectors_are_filled_up():
    index = scan.Index(3, 1.0, np.eye(4), np.zeros((1, 4)), 1)
    got = index.matrix(pa.array([[1.0], [1.0, 2.0, 3.0]], pa.list_(pa.float32())))
    assert got.tolist() == [[1.0, 0.0, 0.0], [1.0, 2.0, 3.0]]
