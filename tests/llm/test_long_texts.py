"""One very long text for each operator that has no such test of its own, against a plain form."""

import hashlib

import pytest
from helpers import documents
from tokenizers import Tokenizer

from stratalake.llm import bpe, chat, linededup, queries, simhash

MEGABYTE = {
    "letter": "a" * 1_000_000,
    "blanks": " " * 1_000_000,
    "lines": "\n" * 1_000_000,
    "words": "some words, " * 85_000,
    "digits": "7" * 300_000,
}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("kind", MEGABYTE)
def test_near_dedup(spark, kind):
    text = MEGABYTE[kind]
    rows = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, [text, "quite another thing to say", text])).collect()}
    assert rows[0].component_id == rows[2].component_id == 0 and rows[1].component_id == 1


@pytest.mark.parametrize("kind", MEGABYTE)
def test_line_dedup(spark, kind):
    text = MEGABYTE[kind]
    rows = {r.doc_id: r for r in linededup.dropped_digests(documents(spark, [text, text, "x", text, text, text])).collect()}
    repeated = len(text.split("\n")) if kind in ("letter", "words", "digits") else 0
    for doc_id in (0, 1, 3, 4):
        assert rows[doc_id].n_lines == len(text.split("\n")) and rows[doc_id].n_dropped == repeated
        assert rows[doc_id].kept_sha256 == sha("" if repeated else text)
    assert rows[5].n_dropped == 0 and rows[5].kept_sha256 == sha(text)


@pytest.mark.parametrize("kind", MEGABYTE)
def test_chat(spark, kind):
    text = MEGABYTE[kind]
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    row = chat.conversation_digests(turns).first()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), sha(text))
    assert row.turns_sha256 == sha(f"user\n{text}\nassistant\n{text}\n")


@pytest.mark.parametrize("kind", MEGABYTE)
def test_encoding(spark, kind):
    text = MEGABYTE[kind]
    own = Tokenizer.from_file(queries.WORD_BPE)
    own.no_truncation()
    own.no_padding()
    want = own.encode(text, add_special_tokens=False).ids
    row = bpe.encode_digests(documents(spark, [text]), queries.WORD_BPE).first()
    assert row.n_tokens == len(want) and row.ids_sha256 == sha(" ".join(map(str, want)))
