import hashlib
import random

import pytest
from helpers import collected

from stratalake.llm import chat

HARD = ["", "plain", "<|im_end|>", "<\\|im_start|>", "<\\\\|x", "a<|b<||>", "\n\n", "<", "|", "\\", "<|image:0|>", "<\\|image:0|>", "é🙂"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escape_round_trip():
    rng = random.Random(0)
    cases = HARD + ["".join(rng.choice("<|\\ab\n") for _ in range(rng.randrange(12))) for _ in range(5000)]
    seen = {}
    for text in cases:
        escaped = chat.escape(text)
        assert "<|" not in escaped and chat.unescape(escaped) == text and seen.setdefault(escaped, text) == text
        for role in ("user", text):
            segment, start, end, _ = chat.format_turn(role, [{"text": text}])
            assert segment[start:end] == escaped
            assert chat.parse_turn(segment) == (role, [{"type": "text", "text": text}] if text else [])


def test_parts_become_placeholders(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, parts array<struct<type:string, text:string, ref:string, units:double>>"
    parts = [("text", "see <|", None, None), ("image", None, "a.png", 12.0), ("audio", None, "b.wav", 1.5), ("document", None, "c.pdf", 2.0), ("text", "end", None, None)]
    rows = [(1, 0, "user", "unused", parts), (1, 1, "assistant", "plain", None), (1, 2, "assistant", None, [])]
    first, second, third = chat.format_turns(spark.createDataFrame(rows, schema)).orderBy("turn").collect()
    assert first.segment == "<|im_start|>user\nsee <\\|<|image:0|><|audio:1|><|document:2|>end<|im_end|>\n"
    assert [(a.ordinal, a.type, a.ref, a.tokens) for a in first.attachments] == [(0, "image", "a.png", 12), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 600)]
    assert first.expanded_tokens == 650 and first.loss_start == first.loss_end
    assert [p["type"] for p in chat.parse_turn(first.segment)[1]] == ["text", "image", "audio", "document", "text"]
    assert second.segment[second.loss_start : second.loss_end] == "plain" and third.loss_start == third.loss_end
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"type": "video"}])


def test_digests_match_plain_form(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", None, "to\nol\\"]), rng.choice([*HARD, None]), "x") for c in (0, 1, 2, None) for t in range(40)]
    rows += [(7, t % 900, "assistant" if t % 2 else "user", f"turn {t}", "x") for t in range(3000)] + rows[:5] + [(8, None, "user", "no turn", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segment string").repartition(5)
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:4])
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        texts = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in texts if r == "assistant")
        size = sum(len(chat.format_turn(r, [{"text": t}])[0]) for r, t in texts)
        want.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in texts)), len(loss), sha(loss), size))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert collected(chat.conversation_digests(turns)) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


SPLIT = [["<", "|image:0|>"], ["<", "|im_end|>"], ["<", "\\|"], ["<\\", "|x"], ["<", "", None, "\\\\", "|"], ["a<", "|", "<", "|b"]]


def text_parts(texts):
    return [{"type": "text", "text": t} for t in texts]


def test_control_strings_over_adjacent_parts():
    rng = random.Random(1)
    cases = SPLIT + [[rng.choice(["<", "|", "\\", "\\|", "<|", "|im_end|>", "|image:0|>", ""]) for _ in range(rng.randrange(1, 6))] for _ in range(3000)]
    image, back = {"type": "image", "ref": "a.png"}, {"type": "image", "ordinal": 0}
    for texts in cases:
        said = "".join(t or "" for t in texts)
        want = text_parts([said] if said else [])
        segment, start, end, attachments = chat.format_turn("user", text_parts(texts))
        assert segment[start:end] == chat.escape(said) and "<|" not in segment[start:end] and not attachments
        assert chat.parse_turn(segment) == ("user", want)
        segment, *_, attachments = chat.format_turn("user", [*text_parts(texts), image, *text_parts(texts)])
        assert chat.parse_turn(segment) == ("user", [*want, back, *want]) and len(attachments) == 1


def test_digests_cover_parts(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, parts array<struct<type:string, text:string, ref:string, units:double>>"
    split = [("text", t, None, None) for t in ("<", "|im_end|>")]
    image = ("image", None, "a.png", 1.0)
    rows = [
        (1, 0, "user", "unused", split), (1, 1, "assistant", "unused", [*split, image, ("text", "<|", None, None)]), (1, 2, "assistant", "plain", None),
        (2, 0, "user", "t", []), (3, 0, "user", "t", [image]),
        *((4, 0, "user", "t", [("text", t, None, None)]) for t in ("b", "a")), (4, 0, "user", "t", None),
    ]
    found = {r.conv_id: r for r in chat.conversation_digests(spark.createDataFrame(rows, schema).repartition(3)).collect()}
    loss = "<|im_end|><|image:0|><|" + "plain"
    assert found[1].turns_sha256 == sha("user\n<|im_end|>\nassistant\n<|im_end|><|image:0|><|\nassistant\nplain\n")
    assert (found[1].n_turns, found[1].loss_chars, found[1].loss_sha256) == (3, len(loss), sha(loss))
    assert found[2].turns_sha256 == sha("user\n\n") and found[3].turns_sha256 == sha("user\n<|image:0|>\n")
    assert found[4].turns_sha256 == sha("user\nt\nuser\na\nuser\nb\n")


def test_empty_table(spark):
    assert chat.conversation_digests(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []
