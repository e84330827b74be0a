from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shaftline.llm import packing, tokens
from shaftline.llm.common import tokenizer_path
from shaftline.sources.scratch import scratch_path

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = [" ", "\n", "a", "B", "é", "0", "'s", "|", "★", "\t", "\x1c", "\xa0", "the", "梦", "\r", "Σ"]


def plain(path: str, text: str | None) -> list[int]:
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path, spaced", [(BYTE, True), (WORD, False)])
def test_cut_texts_encode_like_whole_ones(path, spaced):
    rng = random.Random(3)
    texts = ["".join(rng.choices([*ODD, "<|endoftext|>"], k=rng.randrange(14))) for _ in range(800)]
    library = Tokenizer.from_file(path)
    for special in (True, False):
        library.encode_special_tokens = not special
        for text, coded in zip(texts, tokens.Encoder(path, spaced, special=special)(texts)):
            whole = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(coded, "<u4").tolist() == whole


def test_words_before_signs_are_encoded_once():
    """A word with a comma or a full stop behind it costs no encoding of its own."""
    own, seen, ids = tokens.Encoder(BYTE, True), [], tokens.Encoder._ids
    own._ids = lambda text: seen.append(text) or ids(own, text)
    texts = ["a wordy wordy, wordy. élan, élan. end.", "x élan wordy, y wordy., y wordy.z q\u0378, it's, 7. ,", "nova, nova"]
    for text in texts:
        assert np.frombuffer(own([text])[0], "<u4").tolist() == plain(BYTE, text)
    encoded = "".join(seen)
    assert encoded.count("wordy") == 3 and "wordy," not in encoded.replace("wordy.,", "") and encoded.count("end") == 1


def test_encoder_forgets_when_full():
    own = tokens.Encoder(BYTE, True, remembered=3)
    for text in ("a b c d e", "a f", "g h i j"):
        assert np.frombuffer(own([text])[0], "<u4").tolist() == plain(BYTE, text)


def test_encoder_holds_no_more_bytes_than_it_may():
    own = tokens.Encoder(BYTE, True, held=200_000)
    rng = random.Random(0)
    most = 0
    for _ in range(60):
        text = "".join(rng.choices("abcdefgh", k=20_000))  # one segment without spaces
        assert np.frombuffer(own([text, "a b"])[0], "<u4").tolist() == plain(BYTE, text)
        most = max(most, sum(len(k) + len(v) for held in (own.known, own.before) for k, v in held.items()))
    assert most < 2 * (200_000 + 80_000) and own.before


def test_special_tokens_in_texts_are_those_of_the_library(spark, documents, by_id):
    texts = [(1, "a <|endoftext|> b\nc"), (2, "<|startoftext|>x  y"), (3, "<|endoftext|>"), (4, "<|endoftext |>")]
    got = by_id(tokens.encode_documents(documents(texts)))
    assert {i: r["ids"] for i, r in got.items()} == {i: [*plain(BYTE, t), 2] for i, t in texts}
    assert 50256 in got[1]["ids"]
    packed = packing.pack_documents(documents(texts)).collect()
    crc = {i: zlib.crc32(np.array([*plain(WORD, t), 1], "<u4").tobytes()) for i, t in texts}
    assert {r.doc_id: r.ids_crc32 for r in packed} == crc


def test_token_files(spark, documents):
    texts = [(5, "one two"), (2, None), (9, ""), (None, "x"), (7, "long word " * 3_000), (5, "one two")]
    path = scratch_path(spark, "test-tokens")
    tokens.write_token_files(documents(texts), path, stripe_bytes=1 << 16)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.token_digest(spark, path).collect())
    want, at = [], 0
    for i, text in sorted(texts, key=lambda r: (r[0] is not None, r[0])):
        ids = [*plain(BYTE, text), 2]
        want.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    some = tokens.read_token_files(spark, path, [9, 2])
    assert {r.doc_id for r in some.collect()} == {2, 9}
    assert "doc_id" in some._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_no_documents(spark, documents):
    path = scratch_path(spark, "test-tokens")
    tokens.write_token_files(documents([]), path)
    assert tokens.token_digest(spark, path).count() == 0
    assert packing.pack_documents(documents([])).count() == 0


def bins_one_by_one(lengths: list[int], capacity: int) -> list[int]:
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - length)
    return rooms


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(400))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    used, placed = defaultdict(int), defaultdict(int)
    for p in packing.plan(histogram, capacity):
        ranks = [q.rank for q in packing.plan(histogram, capacity) if q.length == p.length]
        end = min((r for r in ranks if r > p.rank), default=histogram[p.length])
        for k in range(end - p.rank):
            assert used[p.first + k // p.per_bin] == p.offset + k % p.per_bin * p.length
            used[p.first + k // p.per_bin] += p.length
            placed[p.length] += 1
    assert placed == histogram
    assert sorted(capacity - n for n in used.values()) == bins_one_by_one(lengths, capacity)


def test_packed_documents(documents):
    rng = random.Random(1)
    texts = [(i, "word " * rng.choice([0, 1, 5, 700, 9_000])) for i in range(40)]
    texts += [(50, None), (3, "again"), (3, "again"), (None, "no id")]
    rows = packing.pack_documents(documents(texts)).collect()
    lengths = []
    for _, text in texts:
        ids = len(plain(WORD, text)) + 1
        lengths += [4096] * (ids // 4096) + [ids % 4096] * (ids % 4096 > 0)
    assert sorted(r.length for r in rows) == sorted(lengths)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) == len(bins_one_by_one(lengths, 4096))
