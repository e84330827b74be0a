"""Conversations as token ids with a loss mask.

Each turn is assembled from segments that are encoded apart: a reserved id for
the role, the ids of the text, a reserved id for the end. Reserved ids lie behind
the vocabulary, so no text can produce one; in the readable form, strings that
mark turns are escaped where they occur in a text, and parsing undoes that. A
conversation is its turns in order, so turns stay rows of their own and a
conversation with any number of them is never held by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, map_arrow, of_bounded_size, stored, tokenizer_path
from shaftline.llm.tokens import encoder

# The template. Ids from 50257 on are free in the vocabulary.
ROLES = {"system": 50257, "user": 50258, "assistant": 50259, "tool": 50260}
OTHER, ROLE_END, END = 50261, 50262, 50263
LEARNED = ("assistant",)
NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
CLOSE = "</turn>"

_MARK = r"(?:### (?:System|User|Assistant|Tool|Other):|</turn>)"
_ESCAPE = re.compile(r"\\*" + _MARK)
_UNESCAPE = re.compile(r"\\(\\*" + _MARK + ")")


def escape(text: str) -> str:
    """One backslash more before every string that marks turns."""
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


def formatted(role: str, text: str) -> str:
    """A turn in readable form. Every mark that no backslash precedes is one."""
    if role in NAMES:
        head = f"### {NAMES[role]}: "
    else:
        head = f"### Other: {escape(role)}\n"
    return f"{head}{escape(text)}\n{CLOSE}\n"


def format_turns(
    conversations: DataFrame, vocabulary: str | None = None, learned: Sequence[str] = LEARNED
) -> DataFrame:
    """``conv_id``, ``turn``, ``ids``, ``loss_mask`` and ``formatted`` of every row.

    The mask covers text and end of the ``learned`` roles' turns. A null role or
    text is empty; a role without an id of its own is written out behind the
    id for others. Repeated rows are turns like any other.
    """
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        encode = encoder(path, True)
        for part in of_bounded_size(batch):
            roles = [r or "" for r in part["role"].to_pylist()]
            texts = [t or "" for t in part["text"].to_pylist()]
            coded = encode([escape(t) for t in texts])
            others = encode([escape(r) for r in roles])
            segments: list[np.ndarray] = []
            sizes, starts = [], []  # of turns; of what the mask switches
            at = 0
            for role, body, other in zip(roles, coded, others):
                head = [ROLES[role]] if role in ROLES else [OTHER]
                own = [np.array(head, "<i4")]
                if role not in ROLES:
                    own += [np.frombuffer(other, "<i4"), np.array([ROLE_END], "<i4")]
                before = sum(map(len, own))
                own += [np.frombuffer(body, "<i4"), np.array([END], "<i4")]
                size = sum(map(len, own))
                if role in learned:
                    starts.append((at + before, at + size))
                segments += own
                sizes.append(size)
                at += size
            switch = np.zeros(at + 1, np.int8)
            for start, end in starts:
                switch[start] += 1
                switch[end] -= 1
            mask = np.cumsum(switch[:-1], dtype=np.int8)
            offsets = np.cumsum([0, *sizes], dtype=np.int32)
            ids = np.concatenate(segments) if segments else np.zeros(0, "<i4")
            yield {
                "conv_id": part["conv_id"],
                "turn": part["turn"],
                "ids": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                "loss_mask": pa.ListArray.from_arrays(offsets, pa.array(mask, pa.int8())),
                "formatted": pa.array(map(formatted, roles, texts), pa.string()),
            }

    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    return map_arrow(
        conversations.select("conv_id", "turn", "role", "text"),
        per_batch,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, ids array<int>, "
        "loss_mask array<tinyint>, formatted string",
    )


def store_conversations(conversations: DataFrame) -> DataFrame:
    """Formatted turns in a table laid out by conversation and turn.

    The turn is part of the range key, so a huge conversation is spread over
    several files. Turns with equal numbers go by their readable form.
    """
    order = ["conv_id", "turn", "formatted"]
    turns = format_turns(conversations)
    return stored(turns.repartitionByRange(*order).sortWithinPartitions(*order), "chat")


@cache
def _id_bytes(path: str) -> list[bytes]:
    """Bytes of each id. The vocabulary writes a byte as a printable character:
    itself where it is one, else the next free character from 256 on."""
    from tokenizers import Tokenizer

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
    vocab = Tokenizer.from_file(path).get_vocab()
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if all(c in of for c in token):
            table[i] = bytes(of[c] for c in token)
    return table


def parse_turn(ids: Sequence[int], mask: Sequence[int], path: str) -> tuple[str, str, str]:
    """Role, text and learned text of a turn, from its ids and mask."""
    table = _id_bytes(path)
    names = {i: role for role, i in ROLES.items()}
    body = 1
    if ids[0] == OTHER:
        body = list(ids).index(ROLE_END) + 1
        role = unescape(b"".join(table[i] for i in ids[1 : body - 1]).decode())
    else:
        role = names[ids[0]]
    content = ids[body:-1]
    text = unescape(b"".join(table[i] for i in content).decode())
    kept = b"".join(table[i] for i, m in zip(content, mask[body:-1]) if m)
    return role, text, unescape(kept.decode())


def conversation_digest(turns: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per conversation, from stored turns.

    A digest over a whole conversation has to see its turns one after another:
    they stream through one task in order, which holds a turn and two hash
    states, not the conversation.
    """
    find_library(turns.sparkSession)
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")
    kind = turns.schema["conv_id"].dataType
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(done: list[tuple[object, ...]]) -> pa.RecordBatch:
        columns = zip(*done)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
        )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n, loss_chars, chars = None, 0, 0, 0
        whole = learned = None
        done: list[tuple[object, ...]] = []
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("conv_id", "ids", "loss_mask", "formatted")))
            for conv, ids, mask, shown in rows:
                if whole is None or conv != current:
                    if whole is not None:
                        done.append(
                            (current, n, whole.hexdigest(), loss_chars, learned.hexdigest(), chars)
                        )
                    current, n, loss_chars, chars = conv, 0, 0, 0
                    whole, learned = hashlib.sha256(), hashlib.sha256()
                role, text, kept = parse_turn(ids, mask, path)
                n += 1
                whole.update(f"{role}\n{text}\n".encode())
                learned.update(kept.encode())
                loss_chars += len(kept)
                chars += len(shown)
            if done:
                yield batch_of(done)
                done = []
        if whole is not None:
            yield batch_of([(current, n, whole.hexdigest(), loss_chars, learned.hexdigest(), chars)])

    order = ["conv_id", "turn", "formatted"]
    return (
        turns.repartition("conv_id")
        .sortWithinPartitions(*order)
        .mapInArrow(
            digest,
            f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, "
            "loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        )
    )


def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    kinds = given.select("conv_id", "turn", "role", "text").schema
    odd = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(kinds["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    rows = given.select("conv_id", "turn", "role", "text").unionByName(planted)
    return conversation_digest(store_conversations(rows))
