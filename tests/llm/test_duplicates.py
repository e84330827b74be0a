from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shaftline.llm import block_naming, minmax


def normal(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def some_texts(seed: int = 0) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    base = ["".join(rng.choices("ab \n", k=n)) for n in (0, 1, 5, 31, 32, 33, 64, 65, 300, 1_000)]
    texts = [(i, rng.choice(base)) for i in range(60)]
    texts += [(100, None), (101, ""), (102, base[-1] + "x"), (103, base[-1].replace(" ", "\t\r"))]
    return texts


@pytest.mark.parametrize("size", [1, 32, 4096])
def test_exact_duplicates(documents, by_id, size):
    texts = some_texts() if size > 1 else some_texts()[:12]
    groups = defaultdict(list)
    for i, text in texts:
        groups[normal(text)].append(i)
    want = {
        i: (min(own), len(own), i == min(own), hashlib.sha256(text.encode()).hexdigest())
        for text, own in groups.items()
        for i in own
    }
    got = by_id(block_naming.exact_duplicates(documents(texts), size))
    assert {i: tuple(r.values())[1:] for i, r in got.items()} == want


def test_keys_that_clash_are_drawn_anew(documents):
    def weak(block, seed):
        own = block_naming.block_key(block, seed)
        return F.when(F.lit(seed < 2), F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(2).cast("bigint").alias("b"))).otherwise(own)

    rows = block_naming.identities(documents([(1, "a"), (2, "b"), (3, "a")]), 4, weak).collect()
    names = {r.doc_id: (r.n_blocks, r.name) for r in rows}
    assert names[1] == names[3] != names[2]


def test_repeated_rows_and_null_ids(documents):
    texts = [(None, "x"), (None, "x"), (4, "x"), (4, "x"), (None, "y"), (4, "z")]
    rows = block_naming.exact_duplicates(documents(texts)).collect()
    assert [(r.keep_id, r.group_size) for r in rows if r.kept and r.keep_id is not None] in (
        [(4, 4), (4, 1)],
        [(4, 1), (4, 4)],
    )
    assert sum(r.kept for r in rows) == 3
    left = block_naming.drop_exact_duplicates(documents(texts))
    assert sorted(r.text for r in left.collect()) == ["x", "y", "z"]
    assert left.columns == documents([]).columns
    assert block_naming.exact_duplicates(documents([])).count() == 0


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def near(texts: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, bool]]:
    sets = {i: shingles(t) for i, t in texts}
    first = {i: i for i in sets}

    def find(i: int) -> int:
        while first[i] != i:
            i = first[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if either and 100 * both >= 75 * either and sets[a]:
                x, y = sorted((find(a), find(b)))
                first[y] = x
    return {i: (len(s), find(i), i == find(i)) for i, s in sets.items()}


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join("new%d" % rng.randrange(10**6) if rng.random() < share else w for w in text.split())


def test_near_duplicates(documents, by_id):
    rng = random.Random(2)
    bases = [" ".join("w%d" % rng.randrange(500) for _ in range(n)) for n in (3, 6, 60, 200, 400)]
    texts = [(10 * k, b) for k, b in enumerate(bases)]
    for k in range(120):
        texts.append((1_000 + k, edited(rng, rng.choice(bases), rng.choice([0, 0.01, 0.03, 0.05, 0.08]))))
    chain = bases[-1]
    for k in range(15):  # each a link from the one before, not from the first
        chain = edited(rng, chain, 0.02)
        texts.append((2_000 - k, chain))
    texts += [(5_000, None), (5_001, " \n"), (5_002, "A B"), (5_003, "a b"), (5_004, "b a")]
    got = by_id(minmax.near_duplicates(documents(texts)).drop("text_key"))
    assert {i: tuple(r.values())[1:] for i, r in got.items()} == near(texts)


def test_links_within_a_family_of_one_template(documents, by_id):
    # Members of the family are alike by 0.6, pairs of them by 0.758: the first member
    # of a bucket and those drawn from its component tie nothing.
    rng = random.Random(11)

    def some(n: int) -> str:
        return " ".join("w%d" % rng.randrange(10**9) for _ in range(n))

    template, texts = some(124), []
    for k in range(500):
        pair = some(18)
        texts += [(2 * k + i, f"{template} {pair} {some(22)}") for i in range(2)]
    got = by_id(minmax.near_duplicates(documents(texts)))
    assert [i for i, r in got.items() if r["component_id"] != i - i % 2] == []


def test_near_duplicate_rows_without_ids(documents):
    text = " ".join("w%d" % k for k in range(50))
    texts = [(None, text), (None, text), (7, text + " end"), (7, text + " end"), (None, None), (None, None)]
    found = minmax.near_duplicates(documents(texts)).collect()
    assert sum(r.kept for r in found) == 3
    left = minmax.drop_near_duplicates(documents(texts)).collect()
    assert sorted(r.text or "" for r in left) == ["", text + " end"]
    assert minmax.near_duplicates(documents([])).count() == 0


def test_minmax_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 3_000, dtype=np.uint64)
    b = np.concatenate([a[:2_400], rng.integers(0, 1 << 63, 600, dtype=np.uint64)])
    same = minmax.minmax(a, 1024) == minmax.minmax(b, 1024)
    assert abs(same.mean() - 2_400 / 3_600) < 0.05


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    first = {i: i for e in edges for i in e}
    for _ in first:
        for a, b in edges:
            first[a] = first[b] = min(first[a], first[b])
    got = {r.node: r.component for r in minmax.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: c for i, c in first.items() if i != c}
