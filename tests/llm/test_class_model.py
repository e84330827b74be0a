"""The class model against plain Python: probabilities, both ways to hold classes, long texts."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shaftline.llm import brown


def some_texts(seed: int, n: int = 120) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    verbs, nouns = [f"run{i}s" for i in range(20)], [f"thing{i}" for i in range(25)]
    texts = [
        (k, " ".join(f"{rng.choice(['The', 'a'])} {rng.choice(nouns)} {rng.choice(verbs)}" for _ in range(rng.randrange(12))))
        for k in range(n)
    ]
    return texts + [(500, None), (501, ""), (502, "é 　 once"), (503, "a a a a a a a")]


def held(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), b""]


def fitted(documents, texts):
    """Classes by word, the class table and the model, as ``score_documents`` fits them."""
    chunks = brown.stored(brown.chunked(documents(texts)), "chunks")
    counts = brown.stored(brown.word_counts(chunks), "word-counts")
    words, n_units = brown.numbered(counts)
    coded = brown.stored(brown.coded_chunks(chunks, words), "coded")
    assigned, table = brown.exchange(coded, brown.first_classes(words, n_units, brown.CLASSES))
    if isinstance(assigned, brown.HeldClasses):
        of = dict(enumerate(assigned.classes.tolist()))
    else:
        of = dict(assigned.classes.collect())
    units = {bytes(r.word): r.unit for r in words.collect()}
    return of, units, table, brown.train(counts, words, assigned, table)


@pytest.mark.parametrize("held_units, chunk", [(1 << 22, 1 << 20), (0, 1 << 20), (1 << 22, 50)])
def test_scores_equal_a_plain_model(documents, monkeypatch, held_units, chunk):
    """With classes in the tasks and in a table, in one chunk a task and in many."""
    monkeypatch.setattr(brown, "HELD", held_units)
    monkeypatch.setattr(brown, "CHUNK", chunk)
    texts = some_texts(1)
    of, units, table, model = fitted(documents, texts)

    training = [tokens_of(t) for i, t in texts if not held(i)]
    counts = Counter(w for own in training for w in own)
    assert sorted(u for u in units.values() if u >= brown.FIRST_OWN) == list(range(brown.FIRST_OWN, len(of)))
    assert {w for w, u in units.items() if u >= brown.FIRST_OWN} == {w for w, n in counts.items() if n >= 3 and w}

    def class_of(word: bytes) -> int:
        return of[units.get(word, 1 + brown.ending(word))] if word else 0

    pairs = np.zeros_like(table)
    for own in training:
        for a, b in zip([b"", *own], own):
            pairs[class_of(a), class_of(b)] += 1
    assert (pairs == table).all()

    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    in_class, types = Counter(), Counter()
    for w, n in counts.items():
        in_class[class_of(w)] += n
        types[class_of(w)] += 1

    def emission(word: bytes) -> float:
        c, n = class_of(word), counts[word]
        if c == 0:
            return 1.0
        if not in_class[c]:
            return 1.0
        return (n - discount if n else discount * types[c]) / in_class[c]

    def transition(a: int, b: int) -> float:
        return (pairs[a, b] + 0.1) / (pairs[a].sum() + 0.1 * len(pairs))

    rows = brown.score_documents(documents(texts)).collect()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows}
    for i, text in texts:
        own = tokens_of(text)
        want = sum(
            math.log10(transition(class_of(a), class_of(b)) * emission(b)) for a, b in zip([b"", *own], own)
        )
        assert by_id[i].score == pytest.approx(want, rel=1e-9)
        assert by_id[i].perplexity == pytest.approx(10 ** (-want / len(own)))

    # What may follow any class: each known word, and an unseen one for each class.
    for a in range(len(pairs)):
        total = sum(transition(a, class_of(w)) * emission(w) for w in counts)
        for c in range(1, len(pairs)):
            total += transition(a, c) * (discount * types[c] / in_class[c] if in_class[c] else 1.0)
        assert total == pytest.approx(1.0)


def test_both_ways_to_hold_classes_agree(documents, monkeypatch):
    texts = some_texts(2)
    one = {r.doc_id: r.score for r in brown.score_documents(documents(texts)).collect()}
    monkeypatch.setattr(brown, "HELD", 0)
    two = {r.doc_id: r.score for r in brown.score_documents(documents(texts)).collect()}
    assert two == pytest.approx(one)


def test_words_that_do_the_same_share_a_class(documents):
    of, units, _, _ = fitted(documents, some_texts(3, 400))
    nouns = {of[units[f"thing{i}".encode()]] for i in range(25)}
    verbs = {of[units[f"run{i}s".encode()]] for i in range(20)}
    assert not nouns & verbs


def test_best_classes_of_many_units_are_those_of_each():
    rng = np.random.default_rng(4)
    size = 6
    pairs = rng.integers(0, 3, (40, 40)) * rng.integers(0, 2, (40, 40))
    of = np.array([0, *rng.integers(1, size, 39)])
    table = np.zeros((size, size))
    np.add.at(table, (of[:, None], of[None, :]), pairs)
    dense = np.zeros((39, 2 * size + 1))
    for unit in range(1, 40):
        np.add.at(dense[unit - 1], of, pairs[:, unit])
        np.add.at(dense[unit - 1], of + size, pairs[unit])
        dense[unit - 1, -1] = pairs[unit, unit]
    row, slot = np.nonzero(dense)
    got = brown.best_classes(table, of[1:], row, slot, dense[row, slot])
    for unit in range(1, 40):
        tried = {}
        for c in range(1, size):
            moved = of.copy()
            moved[unit] = c
            new = np.zeros((size, size))
            np.add.at(new, (moved[:, None], moved[None, :]), pairs)
            # The pairs aren't closed here, so a unit may stand behind more than before others.
            tried[c] = brown.likelihood(new)
        assert tried[got[unit - 1]] == pytest.approx(max(tried.values()))


def test_a_text_of_megabytes(documents):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(5_000)}" for _ in range(400_000))
    rows = brown.score_documents(documents([(1, long), (2, "x" * 2_000_000), (3, "w1 w2")])).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {1: 400_001, 2: 2, 3: 3}
    assert all(math.isfinite(r.score) for r in rows)


def test_words_are_those_of_plain_python():
    rng = random.Random(3)
    signs = [*" \t\n\r\x0b\x0c\x1c\x85\xa0\u3000AZaÄé", "ab", "İ"]
    texts = [None, "", " ", *("".join(rng.choices(signs, k=rng.randrange(20))) for _ in range(500))]
    for array, own in ((pa.array(texts), texts), (pa.array(texts).slice(9, 60), texts[9:69])):
        words, n = brown._words(array)
        want = [tokens_of(t)[:-1] for t in own]
        assert words.to_pylist() == [w for ws in want for w in ws] and n.tolist() == [len(ws) for ws in want]


@pytest.mark.parametrize("sweep", [0, 1])
def test_neighbours_are_counted_by_unit(sweep):
    rng = np.random.default_rng(sweep)
    units, size = np.array([0, 5, 9, 5, 3, 8, 12]), 4
    of = rng.integers(1, size, 13)
    of[0] = 0
    tokens = rng.integers(0, 7, 300).astype(np.int32)
    want, width = Counter(), 2 * size + 1
    for a, b in zip([0, *tokens], tokens):
        u, v = units[a], units[b]
        for unit, slot, counts in ((v, of[u], True), (u, size + of[v], True), (v, 2 * size, u == v)):
            if counts and unit and (unit + sweep) % 2 == 0:
                want[(unit * size + of[unit]) * width + slot] += 1
    keys, n = brown._neighbours(tokens, units, of[units], size, sweep)
    assert dict(zip(keys.tolist(), n.tolist())) == want and (np.diff(keys) > 0).all()
    none = brown._neighbours(tokens[:0], units, of[units], size, sweep)
    assert not len(none[0]) and not len(none[1])


def test_offers_take_few_logarithms(monkeypatch):
    """Entries of a few neighbours, which most are, look up what a class gains; large ones count alike."""
    rng = np.random.default_rng(4)
    size, rows = 65, 60
    table = rng.integers(400, 900, (size, size)).astype(float)
    keys = np.unique(rng.integers(0, rows * 2 * size, 3_000))
    row, slot = keys // (2 * size), keys % (2 * size)
    n, own = rng.integers(1, 30, len(keys)), rng.integers(1, size, rows)
    small = brown._steps(table), brown._steps(table.T)
    taken, plain = [], brown._xlogx
    monkeypatch.setattr(brown, "_xlogx", lambda x: taken.append(np.size(x)) or plain(x))
    ones = np.ones(len(keys), np.int64)
    brown.best_classes(table, own, row, slot, ones, 0, small)
    assert sum(taken) < len(keys) * size / 2
    got = brown.best_classes(table, own, row, slot, n, 0, small)
    monkeypatch.setattr(brown, "SMALL", 1)
    assert (got == brown.best_classes(table, own, row, slot, n)).all()
