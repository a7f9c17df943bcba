"""Spelling variants against all pairs of a plain edit distance."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import clashing, collected, documents

from stratalake.llm import variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(docs):
    words = plain_words(docs)
    form, near = {}, defaultdict(list)
    for a in words:
        near[a] = [b for b in words if one_edit(a, b)]
        best = min(near[a], key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= 10 * words[a] else None
    out = []
    for a in words:
        root = a
        while form[root] is not None:
            root = form[root]
        out.append((a, form[a], root, words[a], len(near[a]), words[form[a]] if form[a] else None))
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


def mutated(rng, word):
    at = rng.randrange(len(word))
    letter = rng.choice("abcdeéÿ×")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    bases = ["".join(rng.choice("abcdeéÿN") for _ in range(rng.randrange(6, 12))) for _ in range(25)]
    words = []
    for base in bases:
        one = mutated(rng, base)
        words += [base] * 290 + [one] * rng.choice([2, 24, 25]) + [mutated(rng, one)] * 2
    rng.shuffle(words)
    out = [rng.choice([" ", "1", ", ", "\n"]).join(words[i : i + 40]) for i in range(0, len(words), 40)]
    return [*out, None, "", "short ab", "x" * 70 + " " + "x" * 70 + " " + "x" * 69 + " " + "x" * 69, ("y" * 64 + " " + "y" * 65 + " ") * 3]


def test_all_pairs(spark, texts):
    docs = documents(spark, texts)
    found = collected(variants.group_variants(docs), *COLUMNS)
    assert found == plain(list(enumerate(texts)))
    assert sum(r[1] is not None for r in found) > 20 and any(r[1] != r[2] for r in found if r[1])
    assert collected(variants.group_variants(clashing(docs)), *COLUMNS) == found


def test_repeated_and_null_ids(spark, texts):
    ids = [None if i % 3 == 0 else i % 5 for i in range(len(texts))]
    assert collected(variants.group_variants(documents(spark, texts, ids)), *COLUMNS) == plain(list(zip(ids, texts)))


def test_empty_table(spark):
    assert variants.group_variants(documents(spark, [])).count() == 0
    assert variants.group_variants(documents(spark, [None, "", "a b c"])).count() == 0


def test_very_long_runs(spark):
    rng = random.Random(1)
    run = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    other = run[:10_000] + run[10_001:]
    texts = [run, run, other, other, "z" * 100_000, "z" * 100_000]
    found = {r.word: r for r in variants.group_variants(documents(spark, texts, ids=[1] * 6)).collect()}
    assert {len(w) for w in found} == {20_000, 19_999, 100_000} and [found[w].n_near for w in (run, other, "z" * 100_000)] == [1, 1, 0]


@pytest.mark.parametrize("symbols", [3, 5])
def test_neighbourhoods_are_full(symbols):
    """Every reduced word at one edit is met, from one end or the other."""
    words = ["abcdefg", "aabbccd", "gggggggg"]

    def near_keys(values, count):
        own, near, counts = variants.neighbours(values, count)
        return int(own[0]), {int(k) for k in near[0][counts[0]]}

    for word in words:
        values = variants.reduced(np.array([[ord(c) for c in word]]), symbols)
        row = values[0].tolist()
        own, raised = near_keys(values, symbols)
        edits = {tuple(row[:i] + row[i + 1 :]) for i in range(len(row))}
        edits |= {tuple(row[:i] + [s] + row[i + 1 :]) for i in range(len(row)) for s in range(1, symbols + 1)}
        edits |= {tuple(row[:i] + [s] + row[i:]) for i in range(len(row) + 1) for s in range(1, symbols + 1)}
        edits.discard(tuple(row))
        for edit in edits:
            key, back = near_keys(np.array([edit], np.uint64), symbols)
            assert (key in raised) + (own in back) == 1


def test_symbols_grow_with_the_vocabulary():
    counts = [variants.symbols_for(n) for n in (0, 10, 10**5, 10**7, 10**9)]
    assert counts == sorted(counts) and counts[0] == 3 and counts[-1] ** 7 * 32 >= 10**9
