from __future__ import annotations

import base64
import gzip
import math
import random
import time
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest

from shaftline.llm import brown, pieces, repetition, secrets, url_rules
from shaftline.llm.common import tokenizer_path

SECRET = 'password = "hunter2hunter2"'


def repeats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Counts and longest repeat, by comparing all windows and pairs of positions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    longest = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), longest


def test_repetition(documents, by_id):
    rng = random.Random(4)
    texts = [
        (k, "".join(w + rng.choice("  \n\t") for w in rng.choices(["a", "é", "c#", "|", "dd"][: 2 + k % 4], k=rng.randrange(70))))
        for k in range(120)
    ]
    texts += [(500, None), (501, ""), (502, "\x1c \xa0"), (503, "ha " * 400), (504, " ".join(map(str, range(300))))]
    got = by_id(repetition.repetition(documents(texts)))
    for i, text in texts:
        n, chars, symbols, lines, covered, longest = repeats(text)
        r = got[i]
        found = [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")]
        assert found == [n, chars, symbols, lines, covered, longest]
        assert r["base_failed"] == (n < 10 or 100 * covered > 20 * n)
        assert not (r["base_failed"] and r["kept"])
    assert got[504]["kept"] and not got[503]["kept"]


def test_one_long_repeat_is_enough(documents, by_id):
    rng = random.Random(0)
    passage = " ".join("p%d" % rng.randrange(10**9) for _ in range(150))
    rest = [" ".join("r%d" % rng.randrange(10**9) for _ in range(2_000)) for _ in range(2)]
    got = by_id(repetition.repetition(documents([(1, f"{passage} {rest[0]} {passage} {rest[1]}"), (2, rest[0])])))
    assert not got[1]["base_failed"] and not got[1]["kept"] and got[1]["longest_repeat"] == 150
    assert got[2]["kept"]


def test_dropping_repetitive_rows_keeps_columns(documents):
    docs = documents([(1, "ha " * 40), (2, " ".join(map(str, range(40)))), (2, " ".join(map(str, range(40)))), (None, None)])
    left = repetition.drop_repetitive(docs)
    assert left.schema == docs.schema
    assert [r.doc_id for r in left.collect()] == [2, 2]
    assert repetition.drop_repetitive(documents([])).count() == 0


def encodings() -> list[str]:
    raw = SECRET.encode()
    escaped = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    return [
        urllib.parse.quote(SECRET),
        urllib.parse.quote(urllib.parse.quote(SECRET)),
        escaped,
        "".join(f"&#{ord(c)};" for c in SECRET),
        base64.b64encode(raw).decode(),
        base64.urlsafe_b64encode(raw).decode().rstrip("="),
        base64.b64encode(gzip.compress(raw * 3)).decode(),
        base64.b64encode(base64.b64encode(zlib.compress(raw))).decode(),
        urllib.parse.quote(base64.b64encode(escaped.encode()).decode()),
    ]


@pytest.mark.parametrize("coded", encodings())
def test_secrets_in_layers(coded):
    text = f"lead-in é {coded} tail"
    found = secrets.find_secrets(text)
    assert {s.kind for s in found} == {"assign"}
    for s in found:
        assert text.index(coded) <= s.start < s.end <= text.index(coded) + len(coded)
        assert s.depth > 0
    assert "hunter2" not in str(secrets.masked(text, found))
    assert coded not in secrets.masked(text, found)


def compressed() -> dict[str, bytes]:
    raw = SECRET.encode()
    noise = "".join(random.Random(1).choices("abcdefgh ", k=3_000)).encode()
    return {
        "twice": gzip.compress(gzip.compress(raw)),
        "zlib of gzip": zlib.compress(gzip.compress(raw)),
        "many times": __import__("functools").reduce(lambda x, _: gzip.compress(x), range(30), raw),
        "second member": gzip.compress(b"first") + gzip.compress(raw),
        "across members": gzip.compress(raw[:9]) + gzip.compress(raw[9:]),
        "behind the members": gzip.compress(b"first") + b"\n" + raw,
        "cut off": gzip.compress(raw + b"\n" + noise)[:-500],
        "cut off inside": gzip.compress(zlib.compress(raw + b"\n" + noise)[:-500]),
        "damaged": zlib.compress(raw + noise)[:-4] + b"zzzz",
        "long": gzip.compress(gzip.compress(b"." * 9_000_000 + raw + b"." * 9_000_000)),
        "across windows": gzip.compress(b"." * (secrets.WINDOW - 9) + raw + b"." * 9),
        "run across windows": gzip.compress(b"." * (secrets.WINDOW - 300_000) + base64.b64encode(zlib.compress("".join(random.Random(2).choices("ABCDEFGHIJ", k=600_000)).encode() + b"\n" + raw)) + b"." * 9),
    }


@pytest.mark.parametrize("kind", compressed())
def test_secrets_in_compressed_layers(kind):
    coded = base64.b64encode(compressed()[kind]).decode()
    text = f"lead-in {coded} tail"
    found = secrets.find_secrets(text)
    assert [(s.start, s.end, s.kind) for s in found] == [(8, 8 + len(coded), "assign")]


@pytest.mark.parametrize("raw", [
    b"\xef\xbb\xbf" + SECRET.encode(), f"a\xa0b\u200b {SECRET}".encode(), f"é {SECRET}".encode("latin-1"),
    b"\0\x0c" + SECRET.encode(), SECRET.encode() + bytes(range(128, 256)) * 9,
    SECRET.encode("utf-16"), SECRET.encode("utf-16-le"), SECRET.encode("utf-16-be"), b"\xfe\xff" + f"梦é {SECRET}".encode("utf-16-be"),
    b"x" + f"梦é {SECRET}".encode("utf-16-le"), ("梦" * 300 + SECRET + "梦" * 300).encode("utf-16"),
])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_secrets_among_other_characters(raw, pack):
    coded = base64.b64encode(pack(raw)).decode()
    found = secrets.find_secrets(f"lead-in {coded} tail")
    assert [(s.start, s.end, s.kind) for s in found] == [(8, 8 + len(coded), "assign")]


def wrapped(raw: bytes, width: int, end: str) -> str:
    coded = base64.b64encode(raw).decode()
    return end.join(coded[i : i + width] for i in range(0, len(coded), width))


@pytest.mark.parametrize("width", [50, 64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    ", "\n> ", "\\n"])
@pytest.mark.parametrize("around", [("lead-in ", " tail"), ("-----BEGIN X-----\n", "\n-----END X-----\n"), ("key-", ""), ("'", "'"), ("-----BEGIN X-----\\n", "\\n-----END X-----\\n")])
def test_secrets_in_wrapped_base64(width, end, around):
    noise = "".join(random.Random(1).choices("abcdefgh ", k=700)).encode()
    for before in range(30, 70, 3):
        coded = wrapped(b"x" * before + b" " + SECRET.encode() + b" y" * 40, width, end)
        text = around[0] + coded + around[1]
        start = text.index(coded)
        assert (start, start + len(coded), "assign") in [(s.start, s.end, s.kind) for s in secrets.find_secrets(text)]
    for pack in (gzip.compress, zlib.compress):
        coded = wrapped(pack(noise + SECRET.encode() + noise), width, end)
        text = around[0] + coded + around[1]
        masked = secrets.masked(text, secrets.find_secrets(text))
        assert not any(line and line in masked for line in coded.split(end) if len(line) > 9)


@pytest.mark.parametrize("prefix", ["https://host/hook/", "key-", "id_", "a/b-c_d/", "/", "x_" * 9, "//ab/", "k" * 40 + "/"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, lambda x: zlib.compress(x, 1), lambda x: zlib.compress(x, 9)])
@pytest.mark.parametrize("suffix", ["", "/x", "-abcd"])
def test_secrets_in_base64_behind_a_prefix(prefix, pack, suffix):
    coded = base64.urlsafe_b64encode(pack(SECRET.encode())).decode().rstrip("=")
    text = f"see {prefix}{coded}{suffix} end"
    found = secrets.find_secrets(text)
    assert {s.kind for s in found} == {"assign"}
    assert all(4 <= s.start <= 4 + len(prefix) and s.end >= 4 + len(prefix + coded) for s in found)
    assert coded not in secrets.masked(text, found)


def test_prose_and_lists_are_no_blocks():
    text = "internationalization\nof\nwords-and-more-words\nDepartment\n" + "\n".join("%040x" % k for k in range(5)) + "\nKind regards"
    assert {s.kind for s in secrets.find_secrets(text)} == {"hex"}
    assert all(s.depth == 0 for s in secrets.find_secrets(text))


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 6, 7, 30, 400])
@pytest.mark.parametrize(
    "sign, again, code",
    [("%", "25", "3D"), ("&", "#38;", "#61;"), ("\\", "u005c", "x3d"), ("%", "26#x25;", "3d")],
)
def test_secrets_behind_chained_escapes(depth, sign, again, code):
    """Chains of any length map to where they stand, alone and among shorter ones."""
    own = "password" + sign + again * depth + code + "abcdef12"
    text = f"%41 {own}, {own} &#97;"
    spans = [(s.start, s.end) for s in secrets.find_secrets(text) if s.kind == "assign"]
    assert spans == [(4, 4 + len(own)), (6 + len(own), 6 + 2 * len(own))]


def test_texts_of_a_megabyte_of_escapes_take_seconds():
    chains = ("%" + "25" * 500_000, "&" + "#38;" * 250_000, "\\" + "u005c" * 200_000, "%" + "26#37;" * 150_000)
    started = time.monotonic()
    for chain in (*chains, "%25252525252525252541 " * 45_000):
        found = secrets.find_secrets(f"password=hunter22 {chain}61 {chain}3Dabcdef12")
        assert (0, 17, "assign") in [(s.start, s.end, s.kind) for s in found]
    assert time.monotonic() - started < 60


def test_secrets_of_the_text_itself(documents, by_id):
    rng = random.Random(6)
    parts = ["password", "Api_Key", "=", ": ", '"', "'", " ", "abcdef", "0123456789abcdef" * 2, "AKIA", "X" * 16, "é", "%41", "\\x", "ſecret="]
    texts = [(k, "".join(rng.choices(parts, k=rng.randrange(12)))) for k in range(300)]
    texts += [(400, None), (401, ""), (402, "%%%\\u12 ====" + "A" * 50_000)]
    got = by_id(secrets.secret_digest(documents(texts)))
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, text in texts:
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text or "") if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert [got[i][f"n_{k}"] for k in secrets.KINDS] == counts
        assert got[i]["base_sha256"] == __import__("hashlib").sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got[i]["spans"].split(",")) or not joined


def test_masking_documents(documents):
    texts = [(1, f"x {SECRET} y"), (2, "clean"), (3, None), (None, "AKIA" + "A" * 16)]
    docs = documents(texts)
    left = secrets.mask_secrets(docs)
    assert left.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in left.collect()}
    assert got == {1: ('x <assign>" y', 13), 2: ("clean", 5), 3: (None, 0), None: ("<access>", 8)}


def test_url_rules(spark):
    urls = [
        "http://www.example.com/en/x?q#f", "https://a.WWW.Example.com/en/", "http://example.com/en/1", "http://notexample.com/en/1",
        "http://x.net/es/", "http://net/fr/a", "http://x.net/de/", "http://com", "http://com/", "HTTP://a.com?x/", "http://example.com/EN/",
        "a.com/en/", "", None, "x://y://example.com/en/", "http://ads.shop.org/a", "http://shop.org/casino/1", "http://shop.org/a\n/casino/1",
    ]
    pages = spark.createDataFrame([(k, u, "h", 1) for k, u in enumerate(urls)] + [(3, urls[3], "h", 1)], "page_id bigint, url string, html string, token int")

    def expected(url: str | None) -> tuple[str, str, str | None]:
        if "://" not in (url or ""):
            return "", "", None
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = []
        for rule in url_rules.RULES:
            h, _, p = rule.pattern.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append(rule.pattern)
        return host, path, max(fits, key=len, default=None)

    got = url_rules.judge_urls(pages).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule) == expected(urls[r.page_id])
        if r.rule:
            assert r.verdict == ("allow" if r.rule in ("com/", "www.example.com/en/") else "block")
    assert {urls[r.page_id] for r in got if r.pattern} == {u for u in urls[-3:]}
    assert url_rules.judge_urls(pages.limit(0)).count() == 0


def test_rules_are_filed_under_rare_tokens():
    rules = [url_rules.Rule("block", "common.rare/x/", domain=True), url_rules.Rule("block", "*abc*")]
    index = url_rules.RuleIndex(rules, {"common": 9, "rare": 1, "x": 5})
    assert index.candidates("common.org/x/") == [rules[1]]
    assert index.candidates("a.common.rare/x/y") == rules
    assert index.best("zabcz") == rules[1]


@pytest.fixture(scope="module")
def model() -> pieces.Pieces:
    return pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))


def viterbi(model: pieces.Pieces, word: str) -> list[int]:
    look = {t: i for i, t in enumerate(model.text) if i > 2 and i not in model.of_byte}
    best, back = [0.0], [(0, -1)]
    for end in range(1, len(word) + 1):
        options = []
        for length in range(min(16, end), 0, -1):
            i = look.get(word[end - length : end])
            if i is not None or length == 1:
                score = model.unknown if i is None else model.scores[i]
                options.append((best[end - length] + score, length, -1 if i is None else i))
        score, length, i = max(options, key=lambda o: o[0])
        best.append(score)
        back.append((length, i))
    out, end = [], len(word)
    while end:
        length, i = back[end]
        out.append(i)
        end -= length
    return out[::-1]


def test_words_advance_together(model):
    rng = random.Random(1)
    words = list({"".join(rng.choices("▁thendaéou.,梦\U0001f600", k=rng.randrange(1, 25))) for _ in range(1_500)})
    got = dict(model._ids(words))
    assert all(got[w] == viterbi(model, w) for w in words)


@pytest.mark.parametrize("text", ["", " ", "  a  b\n\nc ", "héllo 梦 \U0001f600\x00 x", "a" * 3_000, "line\nline"])
def test_piece_round_trip(model, text):
    assert model.decode(np.frombuffer(model.encode([text])[0], "<u4").tolist()) == text


def test_pieces_of_documents(documents, by_id):
    texts = [(1, "the cat\nsat"), (2, None), (3, ""), (None, "x")]
    encoded = pieces.encode_pieces(documents(texts))
    assert by_id(pieces.decode_pieces(encoded)) == {i: {"doc_id": i, "text": t or ""} for i, t in texts}
    assert pieces.piece_digest(documents([])).count() == 0


def test_class_scores(documents):
    rng = random.Random(3)
    texts = []
    for k in range(150):
        size = rng.randrange(30)
        texts.append((k, " ".join(rng.choice(["The", "a"]) + f" n{rng.randrange(40)} V{rng.randrange(30)}" for _ in range(size))))
    texts += [(900, None), (901, ""), (901, ""), (None, "the n1")]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    counts: Counter = Counter()
    for i, t in texts:
        if not held[i]:
            counts.update([*(t or "").lower().split(), ""])
    total, types = sum(counts.values()), len(counts)
    rows = brown.score_documents(documents(texts)).collect()
    assert len(rows) == len(texts)
    of = {i: t for i, t in texts}
    for r in rows:
        tokens = [*(of[r.doc_id] or "").lower().split(), ""]
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    unseen = [r for r in rows if r.held_out]
    # Words of three classes take turns, which the classes know and the base doesn't.
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_class_scores_without_training(documents):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = brown.score_documents(documents([(i, "some words") for i in held])).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in rows} == {(0, 0, 0.0)}
    assert brown.score_documents(documents([])).count() == 0


def test_best_class_raises_likelihood_most():
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 30, (12, 12)).astype(float)
    pairs = np.minimum(pairs, pairs.T)  # as many before as behind a unit
    classes = np.array([0, *(1 + np.arange(11) % 4)])

    def table(of: np.ndarray) -> np.ndarray:
        out = np.zeros((5, 5))
        np.add.at(out, (of[:, None], of[None, :]), pairs)
        return out

    for unit in range(1, 12):
        before, after = np.zeros(5), np.zeros(5)
        np.add.at(before, classes, pairs[:, unit])
        np.add.at(after, classes, pairs[unit])
        to = brown.best_class(table(classes), classes[unit], before, after, pairs[unit, unit])
        tried = {}
        for c in range(1, 5):
            moved = classes.copy()
            moved[unit] = c
            tried[c] = brown.likelihood(table(moved))
        assert tried[to] == pytest.approx(max(tried.values()))
