from __future__ import annotations

import hashlib
import random

import corpus_pipeline
from shaftline.llm import chat
from shaftline.llm.common import tokenizer_path

ODD = ["</turn>", "\\", "\\\\", "### User:", "### Assistant: ", "### Other:", "\n", "é", "a ", "<|endoftext|>", "###", " User:"]


def test_escaping_is_reversible():
    rng = random.Random(0)
    for _ in range(2_000):
        text = "".join(rng.choices(ODD, k=rng.randrange(8)))
        assert chat.unescape(chat.escape(text)) == text
        shown = chat.formatted("user", text)
        # Only the turn's own marks have no backslash before them.
        marks = [m.start() for m in chat._ESCAPE.finditer(shown) if not m[0].startswith("\\")]
        assert marks == [0, len(shown) - len("</turn>\n")]


def test_conversations(spark, by_id):
    rng = random.Random(1)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "critic </turn>", None])
            text = rng.choice([None, "", "x" * 5_000, "".join(rng.choices(ODD, k=6))])
            rows.append((conv, turn, role, text, 1))
    rows += [(77, 0, "user", "hot", 1)] * 400 + [(78, None, "user", "b", 1), (78, None, "assistant", "a", 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, ids int")
    got = by_id(chat.conversation_digest(chat.store_conversations(df.repartition(4))))
    for conv in {r[0] for r in rows}:
        own = [(r[1], chat.formatted(r[2] or "", r[3] or ""), r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
        learned = "".join(text for _, _, role, text in own if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        assert tuple(got[conv].values())[1:] == (
            len(own),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
            sum(len(shown) for _, shown, _, _ in own),
        )
    assert chat.conversation_digest(chat.store_conversations(df.limit(0))).count() == 0


def test_mask_covers_text_and_end_of_learned_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id int, turn int, role string, text string")
    turns = {r.turn: r for r in chat.format_turns(df).collect()}
    assert turns[0].loss_mask == [0] * len(turns[0].ids)
    assert turns[1].loss_mask == [0] + [1] * (len(turns[1].ids) - 1)
    path = tokenizer_path("byte_bpe_50k.json")
    assert chat.parse_turn(turns[1].ids, turns[1].loss_mask, path) == ("assistant", "yo", "yo")


def test_pipeline(documents):
    rng = random.Random(9)
    plain = [" ".join("w%d" % rng.randrange(10**6) for _ in range(60)) for _ in range(6)]
    texts = [(k, t) for k, t in enumerate(plain)]
    texts += [(100, plain[0].replace(" ", "  ")), (101, plain[1] + " end"), (102, "too short"), (103, "ha " * 50), (104, None)]
    texts += [(105, plain[5] + " password=abcdef123 " + "z" * 3), (3, plain[3])]
    docs, columns = documents(texts), documents([]).columns
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(docs.sparkSession, docs, ""), name)
        assert docs.columns == columns
        left[name] = sorted(r.doc_id for r in docs.collect())
    assert left["quality_rules"] == [0, 1, 2, 3, 3, 4, 5, 100, 101, 105]
    assert left["exact_dedup"] == [0, 1, 2, 3, 4, 5, 101, 105]
    assert left["near_dedup"] == left["secret_scan"] == [0, 1, 2, 3, 4, 5]
    packed = corpus_pipeline.STAGES[-1][1](docs.sparkSession, docs, "")
    assert sorted(r.doc_id for r in packed.collect()) == [0, 1, 2, 3, 4, 5]
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules"
