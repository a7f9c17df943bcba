import hashlib
import json
import random

from helpers import clashing, documents, prose
from tokenizers import Tokenizer

from stratalake.llm import bpe
from stratalake.llm.queries import WORD_BPE


def library(texts):
    own = Tokenizer.from_file(WORD_BPE)
    own.no_truncation()
    own.no_padding()
    encoded = own.encode_batch(texts, add_special_tokens=False)
    return [(" ".join(map(str, e.ids)), own.decode(e.ids, skip_special_tokens=False), len(e.ids)) for e in encoded]


def vocabulary():
    with open(WORD_BPE, encoding="utf-8") as file:
        return bpe.Vocabulary(json.load(file))


def cases():
    rng = random.Random(2)
    signs = "aAàÉß'sntT1²½  　\t\x0b\x1c\x85​ΣςσİIı中한🙂👍🏽é!?-<|>_.՘ᲉꟋ"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    return texts + ["", "  ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "<|ENDOFTEXT|>", "ab" * 4000, "a" * 5001, prose(rng, 20_000), "We'll DON'T they've"]


def test_ids_and_text_match_the_library():
    texts = cases()
    encoder = bpe.Encoder(vocabulary())
    assert bpe.encode_texts(texts, encoder) == library(texts)
    assert bpe.encode_texts(texts[::-1], encoder) == library(texts[::-1])  # words already known


def test_numbering_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "HELD_WORDS", 5)
    encoder, texts = bpe.Encoder(vocabulary()), ["one two three four five six", "seven one", "two eight"]
    assert [bpe.encode_texts([t], encoder)[0] for t in texts] == library(texts)
    assert len(encoder.number) < 6


def test_rows(spark):
    texts = [None, *cases()[:200], "same", "same"]
    ids = [None, *range(len(texts) - 2), 0]
    docs = clashing(documents(spark, texts, ids))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(i, n, sha(a), sha(b)) for i, (a, b, n) in zip(ids, library([t or "" for t in texts]))]
    assert sorted(map(str, map(tuple, bpe.encode_digests(docs, WORD_BPE).collect()))) == sorted(map(str, want))
    rows = bpe.encode_documents(docs, WORD_BPE).collect()
    want = [(i, [int(x) for x in a.split()], b) for i, (a, b, _) in zip(ids, library([t or "" for t in texts]))]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_empty_table(spark):
    assert bpe.encode_digests(documents(spark, []), WORD_BPE).collect() == []
