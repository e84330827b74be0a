"""Secrets in texts, also where they are encoded.

Three kinds are looked for (``KINDS``). A worklist holds the layers of a text: it
starts with the text itself, and each layer that is scanned adds what its URL
escapes, character escapes, base64 runs and compressed base64 runs decode to;
compressed bytes are inflated until no compressed header is left. A
layer seen before is not scanned again, so the list runs dry. Escaped signs of escapes in
a row (``%252525...``) are unwound in one step, so that a text of many of them has few
layers and takes time linear in its length. Spans found in a
layer are mapped back to the characters of the text it came from: escapes map
one to one, a base64 run maps as a whole, also one that is broken into lines.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shaftline.llm.common import map_arrow, of_bounded_size

# The kinds in the order they are listed in, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")

# A run of 24 that no other character of the run precedes: what a long run of
# letters costs is then linear in its length.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
URL_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_CHARACTER = r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#x([0-9A-Fa-f]{1,6});"
CHARACTER_ESCAPES = re.compile(_CHARACTER)
ANY_ESCAPE = re.compile(r"%([0-9A-Fa-f]{2})|" + _CHARACTER)
# From so many escapes of the sign of the next one on, a chain of them is one step. The
# layers between would differ in the digits behind the sign only.
CHAIN = 4
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
# The same over several lines, and what parts its lines: also line ends that are
# written out, and what quotes or indents a line.
LINE_END = r"[ \t]*(?:\r\n?|\n|(?:\\r)?\\n)[ \t>]*"
BLOCK = re.compile(
    rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}(?:{LINE_END}[A-Za-z0-9+/_-]+)+={{0,2}}"
)
LAST_LINE = re.compile(r"={0,2}(?![^\s\\\"'`,;)<\]}])")
SEPARATOR = re.compile(r"[/_-]")
BLOCK_LINE = re.compile(rf"({LINE_END})?([A-Za-z0-9+/_-]+=*)")
# What a base64 run starts with if it is compressed, in a run behind a prefix.
COMPRESSED_RUN = re.compile(r"(?<=[/_-])(?:H4sI|eA[E-H]|eF[4-7]|eJ[w-z]|eN[o-r])")
WIDE = re.compile(rb"(?:[\x01-\x7f]\0){6,}")
COMPRESSED = {b"\x1f\x8b": 31, b"\x78\x01": 15, b"\x78\x5e": 15, b"\x78\x9c": 15, b"\x78\xda": 15}
# What is inflated is read to its end, a window of so many bytes at a time; the next
# window starts so much before the end of the last one, or where a run of base64
# that reaches its end starts.
WINDOW, OVERLAP = 1 << 22, 1 << 16
# Streams within streams that are opened: one that holds itself would never end.
LEVELS = 200
IN_RUNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=\r\n"


@dataclass(frozen=True)
class Span:
    """Half-open range of code points in the whole text, and the layer it was
    found in: 0 is the text itself."""

    start: int
    end: int
    kind: str
    depth: int


@dataclass
class Layer:
    """A text and where its characters come from: character i from ``starts[i]``
    to ``ends[i]`` of the whole text, or from the same place if there is no map."""

    text: str
    depth: int = 0
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None or self.ends is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def maps(self) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None or self.ends is None:
            at = np.arange(len(self.text))
            return at, at + 1
        return self.starts, self.ends


def matches(text: str) -> Iterator[tuple[int, int, str]]:
    """Matches of the three kinds in one layer, leftmost and not overlapping per
    kind. Each pattern runs only where what it can't do without occurs."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield m.start(), m.end(), "assign"
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield m.start(), m.end(), "access"
    # Runs are maximal either way.
    for m in LONG_HEX.finditer(text):
        yield m.start(), m.end(), "hex"


def _as_texts(raw: bytes) -> Iterator[str]:
    """Decoded bytes as UTF-8, whatever does not fit replaced, and as UTF-16 from
    an even or odd place on if ASCII characters stand there with zeros between.

    The three kinds are ASCII, as are all encodings, so what stands around them
    need not be text, and either byte order comes out of little-endian pairs.
    """
    yield raw.decode("utf-8", "replace")
    if b"\0" in raw:
        raw += b"\0"
        for odd in sorted({m.start() % 2 for m in WIDE.finditer(raw)}):
            yield raw[odd:].decode("utf-16-le", "replace")


def _members(stream: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed members, one behind the other, decode to. A member that is
    cut off or damaged gives what can be read of it; what follows the last member
    comes as it is."""
    data = b""
    for piece in stream:
        data += piece
        while len(data) >= 2 and data[:2] in COMPRESSED:
            opened = zlib.decompressobj(COMPRESSED[data[:2]])
            while not opened.eof:
                if not data:
                    data = next(stream, b"")
                    if not data:
                        return
                before = opened.copy()
                try:
                    out = opened.decompress(data, 1 << 16)
                except zlib.error:
                    yield from _readable(before, data)
                    return
                data = opened.unused_data if opened.eof else opened.unconsumed_tail
                if out:
                    yield out
            if len(data) < 2:
                data += next(stream, b"")
        if len(data) >= 2:
            yield data
            yield from stream
            return
    if data:
        yield data


def _readable(opened: zlib._Decompress, data: bytes) -> Iterator[bytes]:
    """What comes out ahead of the byte that can't be read."""
    try:
        for i in range(len(data)):
            out = opened.decompress(data[i : i + 1])
            if out:
                yield out
    except zlib.error:
        return


def _inflated(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Windows of what a compressed run decodes to, and of what that decodes to in
    turn, until nothing compressed is left. Nothing is held but a window a level."""
    head = next(stream, b"")
    if head[:2] not in COMPRESSED:
        return
    stream, heads = chain([head], stream), set()
    for _ in range(LEVELS):
        stream = _members(stream)
        head = b""
        while len(head) < 4_096 and (piece := next(stream, b"")):
            head += piece
        stream = chain([head], stream) if head else iter(())
        mark = hashlib.sha256(head).digest()
        if head[:2] not in COMPRESSED or mark in heads:
            break
        heads.add(mark)
    held = bytearray()
    for piece in stream:
        held += piece
        while len(held) >= WINDOW:
            window = bytes(held[:WINDOW])
            yield window
            ahead = len(window.rstrip(IN_RUNS))
            del held[: min(ahead, WINDOW - OVERLAP) if ahead >= WINDOW // 2 else WINDOW - OVERLAP]
    if held:
        yield bytes(held)


def _replaced(layer: Layer, parts: list[tuple[int, int, str]]) -> Layer:
    """``layer`` with some ranges decoded, each decoded character mapped to the
    whole range it stems from."""
    starts, ends = layer.maps()
    text, firsts, lasts, at = [], [], [], 0
    for a, b, new in parts:
        text += [layer.text[at:a], new]
        firsts += [starts[at:a], np.full(len(new), starts[a])]
        lasts += [ends[at:a], np.full(len(new), ends[b - 1])]
        at = b
    text.append(layer.text[at:])
    return Layer(
        "".join(text),
        layer.depth + 1,
        np.concatenate([*firsts, starts[at:]]),
        np.concatenate([*lasts, ends[at:]]),
    )


def _unwound(text: str, end: int, sign: str) -> tuple[int, str]:
    """Where the escape that has given ``sign`` and ends at ``end`` ends, and what it gives,
    if the sign begins an escape with what follows, which gives the sign of a next one, and
    so on. Shorter chains than ``CHAIN`` are left to the layers to come."""
    at, last, steps = end, sign, 0
    while last in "%\\&" and (m := ANY_ESCAPE.match(last + text[at : at + 10])):
        code = int(m[1], 16) if m[1] else _code(m.groups()[1:])
        if code is None or (m[1] and code >= 0x80):
            break
        at, last, steps = at + m.end() - 1, chr(code), steps + 1
    return (at, last) if steps >= CHAIN else (end, sign)


def _code(found: tuple[str | None, ...]) -> int | None:
    """The character that the groups of a match of ``CHARACTER_ESCAPES`` stand for."""
    four, two, decimal, hexadecimal = found
    code = int(decimal) if decimal else int(four or two or hexadecimal or "", 16)
    return code if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _url_layer(layer: Layer) -> Layer | None:
    if "%" not in layer.text:
        return None
    parts, at = [], 0
    while m := URL_ESCAPES.search(layer.text, at):
        raw = bytes.fromhex(m[0].replace("%", ""))
        new = raw.decode("utf-8", "replace")
        at, last = _unwound(layer.text, m.end(), new[-1])
        if len(new) == len(raw):  # ASCII: each character has its own escape
            parts += [(m.start() + 3 * i, m.start() + 3 * i + 3, c) for i, c in enumerate(new[:-1])]
            parts.append((m.end() - 3, at, last))
        else:
            parts.append((m.start(), at, new[:-1] + last))
    return _replaced(layer, parts) if parts else None


def _escape_layer(layer: Layer) -> Layer | None:
    if "\\" not in layer.text and "&#" not in layer.text:
        return None
    parts, at = [], 0
    while m := CHARACTER_ESCAPES.search(layer.text, at):
        at, code = m.end(), _code(m.groups())
        if code is not None:
            at, new = _unwound(layer.text, at, chr(code))
            parts.append((m.start(), at, new))
    return _replaced(layer, parts) if parts else None


def _base64_bytes(body: str) -> bytes:
    """What a run decodes to; a last character that stands for no byte is left out."""
    body = body.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _run_starts(run: str, escaped: bool) -> list[int]:
    """Where in a run base64 may start: at its start, behind the letter of an
    escape that it may begin with, or behind '/', '-' or '_'.

    A run decodes from one start as from any other one a multiple of four
    before it, but for what it decodes to ahead, so the first of each remainder
    will do.
    """
    starts = {0: 0}
    if escaped and run[0] in "nrt":
        starts[1] = 1
    for m in SEPARATOR.finditer(run):
        if len(starts) == 4 or len(run) - m.end() < 16:
            break
        starts.setdefault(m.end() % 4, m.end())
    return sorted(starts.values())


def _blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and joined lines of base64 over several lines: as wide as each
    other, but for a shorter last one and a prefix of the first."""
    for m in BLOCK.finditer(text):
        lines = [(x.start(2), x.end(2)) for x in BLOCK_LINE.finditer(text, m.start(), m.end())]
        i = 0
        while i + 1 < len(lines):
            start, end = lines[i]
            width = end - start
            after = lines[i + 1][1] - lines[i + 1][0]
            ahead = text[max(end - after - 2, 0) : end - after]
            if 16 <= after < width and (ahead[-1:] in "/-_" or ahead in ("\\n", "\\r", "\\t")):
                yield from _block_from(text, lines, i, end - after)
            to = yield from _block_from(text, lines, i, start)
            i = max(to, i + 1)


def _block_from(text: str, lines: list[tuple[int, int]], i: int, start: int) -> Iterator:
    """The block whose first line is that part of line ``i`` from ``start`` on, if
    there is one; returns the number of the line behind its full lines."""
    width = lines[i][1] - start
    to = i + 1
    if width < 16:
        return to
    while to < len(lines) and lines[to][1] - lines[to][0] == width:
        to += 1
    own = [(start, lines[i][1]), *lines[i + 1 : to]]
    # A shorter line ends the block, if it is all of its line and no PEM footer.
    if to < len(lines) and lines[to][1] - lines[to][0] < width:
        a, b = lines[to]
        if not text.startswith("--", a) and LAST_LINE.match(text, b):
            own.append((a, b))
    if len(own) > 1:
        yield own[0][0], own[-1][1], "".join(text[a:b] for a, b in own)
    return to


def _base64_parts(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Start and end of what may be base64 in a text, and what it decodes to, with
    compressed bytes also inflated."""
    for m in BASE64.finditer(text):
        run = m[0]
        starts = _run_starts(run, text[m.start() - 1 : m.start()] == "\\")
        for at in starts:
            raw = _base64_bytes(run[at:])
            for part in chain([raw], _inflated(iter([raw]))):
                yield m.start() + at, m.end(), part
        for inner in COMPRESSED_RUN.finditer(run):
            at = inner.start()
            if at not in starts:
                # Decoded as far as it can be inflated, as there may be many.
                raws = (_base64_bytes(run[k : k + 4_096]) for k in range(at, len(run), 4_096))
                for part in _inflated(raws):
                    yield m.start() + at, m.end(), part
    for start, end, body in _blocks(text):
        raw = _base64_bytes(body)
        for part in chain([raw], _inflated(iter([raw]))):
            yield start, end, part


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    for start, end, raw in _base64_parts(layer.text):
        for text in _as_texts(raw):
            yield _whole(text, layer.depth + 1, layer.origin(start, end))


def _whole(text: str, depth: int, where: tuple[int, int]) -> Layer:
    """A layer whose characters all come from one range."""
    return Layer(text, depth, *(np.broadcast_to(np.int64(x), len(text)) for x in where))


def _decoded(layer: Layer) -> Iterator[Layer]:
    for decode in (_url_layer, _escape_layer):
        found = decode(layer)
        if found:
            yield found
    yield from _base64_layers(layer)


def find_secrets(text: str | None) -> list[Span]:
    """All spans of one text, by start, then kind in the order of ``KINDS``.

    A secret found in several layers counts once, in the one nearest the text.
    """
    if not text:
        return []
    found: dict[tuple[int, int, str], int] = {}
    seen: dict[tuple[bytes, tuple[int, int]], int] = {}
    # Depth first: of each layer on the way, only one window is held at a time.
    work = [iter([Layer(text)])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        where = layer.origin(0, len(layer.text))
        mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), where)
        if seen.get(mark, layer.depth + 1) <= layer.depth:
            continue
        seen[mark] = layer.depth
        for start, end, kind in matches(layer.text):
            key = (*layer.origin(start, end), kind)
            found[key] = min(layer.depth, found.get(key, layer.depth))
        work.append(_decoded(layer))
    spans = [Span(a, b, kind, depth) for (a, b, kind), depth in found.items()]
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def masked(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with each span, or run of overlapping spans, replaced by the kind
    of the first of them in angle brackets."""
    if not text or not spans:
        return text
    out, at, last = [], 0, -1
    for span in spans:
        if span.start >= last:
            out += [text[at : span.start], f"<{span.kind}>"]
        last = max(last, span.end)
        at = last
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``secrets``, an array of (start, end, kind, depth), of every row.

    Texts are scanned whole and one by one, where they are. A null or empty
    text has no secrets; other columns are not read.
    """

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch):
            spans = [[vars(s) for s in find_secrets(t)] for t in part["text"].to_pylist()]
            yield {"doc_id": part["doc_id"], "secrets": pa.array(spans, _SPANS)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, secrets array<struct<start: int, end: int, kind: string, depth: int>>"
    return map_arrow(docs.select("doc_id", "text"), per_batch, schema)


_SPANS = pa.list_(
    pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("depth", pa.int32())]
    )
)


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, secrets in ``text`` masked and ``n_chars``,
    if there is one, counted anew for the texts that changed."""

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for part in of_bounded_size(batch):
            columns = dict(zip(part.schema.names, part.columns))
            old = part["text"].to_pylist()
            new = [masked(t, find_secrets(t)) for t in old]
            columns["text"] = pa.array(new, part.schema.field("text").type)
            if "n_chars" in columns:
                chars = [
                    n if a == b else len(b)
                    for n, a, b in zip(part["n_chars"].to_pylist(), old, new)
                ]
                columns["n_chars"] = pa.array(chars, part.schema.field("n_chars").type)
            yield columns

    return map_arrow(docs, per_batch, docs.schema)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def secret_digest(docs: DataFrame) -> DataFrame:
    """Per row: spans in the text itself counted by kind and digested, and all spans."""

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        rows = zip(batch["doc_id"], batch["secrets"].to_pylist())
        spans = [[Span(**s) for s in own or []] for _, own in rows]
        base = [[s for s in own if s.depth == 0] for own in spans]
        counts = {
            f"n_{kind}": pa.array([sum(s.kind == kind for s in own) for own in base], pa.int64())
            for kind in KINDS
        }
        digests = [hashlib.sha256(_joined(own).encode()).hexdigest() for own in base]
        yield {
            "doc_id": batch["doc_id"],
            **counts,
            "base_sha256": digests,
            "spans": [_joined(own) for own in spans],
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        scan_secrets(docs),
        per_batch,
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, spans string",
    )


def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_digest(spark.read.parquet(f"{sf}/documents.parquet"))
