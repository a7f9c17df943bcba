"""Token counts against the libraries on whole texts."""

import random

import public_tokenizers
import pytest
import sentencepiece
from helpers import clashing, collected, documents
from tokenizers import Tokenizer

from stratalake.llm import tokencount

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]
BITS = ["a", "B", "é", "é", "́", " ", "  ", " ", "　", " ", "\x1c", "\x85", "\n", "\t", "'s", "'", " '", "'LL", "' s", "don't",
        "<|endoftext|>", "<|", "|>", "<|STARTOFTEXT|>", ".", ",", "?!", "...", "1", "22", "½", "Σ", "σς", "日本", "\U0001f642", "‍", "İ", "ſ", "K", "ǅ"]


def whole_counts(name, texts):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        return [len(ids) for ids in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]
    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    mixed = ["".join(rng.choice(BITS) for _ in range(rng.randrange(50))) for _ in range(3000)]
    return [*mixed, "", " ", "\n" * 5000, "plain words, and more. " * 3000, "x" * 3000, "7" * 5000]


@pytest.mark.parametrize("name", FILES)
def test_counts_are_the_librarys(spark, texts, name):
    docs = documents(spark, texts)
    found = collected(tokencount.count_tokens(docs, public_tokenizers.path(name)), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len(t.encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, whole_counts(name, texts)))]
    assert sorted(found) == want


def test_parts_are_split_and_remembered():
    path = public_tokenizers.path(FILES[0])
    counter = tokencount.PartCounts(open(path, "rb").read(), ".json", held_bytes=2000)
    assert counter.parts_of("Two words, twice words.") == ["Two", "words", ",", "twice", "words", "."]
    assert counter.count(["some words"] * 3) == whole_counts(FILES[0], ["some words"]) * 3 and set(counter.known) == {"some", "words"}
    counter.count([f"w{i}" for i in range(50)])
    assert counter.known == {} and counter.count(["some words"]) == whole_counts(FILES[0], ["some words"])


def test_calls_are_balanced_by_bytes():
    counter = tokencount.PartCounts(open(public_tokenizers.path(FILES[0]), "rb").read(), ".json")
    calls, real = [], counter.counts_of
    counter.counts_of = lambda parts: calls.append(sum(map(len, parts))) or real(parts)
    counter.count([" ".join(f"{'long' * 40}{i}{j}" for i in range(200)) for j in range(100)])
    assert len(calls) > 2 and max(calls) < tokencount.CALL_BYTES + 1000


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "\n" * 1_000_000, "9" * 300_000, "word, " * 200_000], ids=["letter", "blanks", "lines", "digits", "words"])
def test_a_megabyte(spark, text):
    found = tokencount.count_tokens(documents(spark, [text, "x"]), public_tokenizers.path(FILES[0])).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {0: whole_counts(FILES[0], [text])[0], 1: 1}


def test_rows(spark):
    docs = documents(spark, [None, "", "one", "one", "two words"], ids=[None, 4, 7, 7, None])
    path = public_tokenizers.path(FILES[0])
    found = collected(tokencount.count_tokens(docs, path, limit=1), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert found == sorted([(None, 0, 0, False), (4, 0, 0, False), (7, 3, 1, False), (7, 3, 1, False), (None, 9, 2, True)], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert collected(tokencount.count_tokens(clashing(docs), path, limit=1)) == collected(tokencount.count_tokens(docs, path, limit=1))
    assert tokencount.count_tokens(documents(spark, []), path).count() == 0


def test_a_changed_file_counts_anew(spark, tmp_path):
    spec = open(public_tokenizers.path(FILES[0]), encoding="utf-8").read()
    path = tmp_path / "own.json"
    docs = documents(spark, ["the weather changes"])
    path.write_text(spec, encoding="utf-8")
    before = tokencount.count_tokens(docs, str(path)).first().n_tokens
    import json

    changed = json.loads(spec)
    changed["model"]["merges"] = changed["model"]["merges"][:10]
    path.write_text(json.dumps(changed), encoding="utf-8")
    assert tokencount.count_tokens(docs, str(path)).first().n_tokens > before
