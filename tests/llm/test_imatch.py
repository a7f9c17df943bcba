import hashlib
import random

import pytest
from helpers import clashing, collected, documents, prose
from pyspark.sql import functions as F

from stratalake.llm import imatch


def fixture():
    rng = random.Random(11)
    texts = [prose(rng, rng.choice([0, 1, 30, 200, 800]), 900) for _ in range(150)]
    return texts + [texts[2], texts[3], "", "only these odd terms", "only these odd terms", "é" * 9]


def test_lexicon_counts_all_documents(spark):
    texts = fixture()
    counts = {}
    for t in texts:
        for term in imatch.terms_of(t):
            counts[term] = counts.get(term, 0) + 1
    want = sorted(t for t, n in counts.items() if max(2, 0.02 * len(texts)) <= n <= 0.2 * len(texts))
    assert imatch.lexicon(documents(spark, texts), 0.02, 0.2) == want


def test_rows_match_plain_form(spark):
    texts = fixture()
    ids = [3 * i for i in range(len(texts))]
    docs = clashing(documents(spark, texts, ids))
    prints = imatch.Fingerprinter(imatch.lexicon(docs))
    for partitions in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = {r.doc_id: r for r in imatch.fingerprint_documents(docs).collect()}
        assert len(rows) == len(texts)
        for i, (doc, text) in enumerate(zip(ids, texts)):
            following = texts[(i + 1) % len(texts)]
            changed = imatch.edited(text, following)
            own, other = prints.fingerprint(text), prints.fingerprint(changed)
            want = (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other,
                    imatch.likeness(own, other), imatch.likeness(own, prints.fingerprint(following)))
            assert tuple(rows[doc]) == want


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_hot_ids_and_equal_rows(spark, partitions):
    """Half of the ids are null, one id has a third of the rest, and one row comes forty times: over several tasks, as the plain form."""
    rng = random.Random(4)
    texts = [prose(rng, rng.choice([1, 5, 60]), 500) for _ in range(160)] + [None, ""]
    ids = [None if i % 2 else 7 if i % 3 == 0 else i for i in range(len(texts))]
    docs = documents(spark, texts + ["the same row"] * 40 + [texts[1]] * 5, ids + [7] * 40 + [None] * 5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = sorted(((r.doc_id is not None, r.doc_id or 0, r.h, r.text) for r in rows.collect()))
    want = []
    for (named, doc_id, _, text), (*_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        changed = imatch.edited(text, following)
        want.append((doc_id if named else None, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    found = imatch.fingerprint_documents(docs)
    assert collected(found, "doc_id", "n_chars", "edited_sha256") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    if partitions != "1":
        borders = imatch.ranges(rows.select("doc_id", F.col("h").alias("text_hash")), 20)
        assert sum(not named for named, *_ in borders) > 2 and sum(doc_id == 7 for _, doc_id, _ in borders) > 1


def test_too_large_a_lexicon_fails(spark):
    with pytest.raises(ValueError, match="over 3 terms"):
        imatch.lexicon(documents(spark, ["a b c d e f"] * 4), 0.1, 1.0, most=3)


@pytest.mark.parametrize("text", ["x" * 1_000_000, "ab " * 400_000, "\n" * 1_000_000])
def test_a_megabyte(spark, text):
    rows = {r.doc_id: r for r in imatch.fingerprint_documents(documents(spark, [text, "a b", text])).collect()}
    assert rows[0].n_chars == len(text) and rows[0].fingerprint == rows[2].fingerprint


def test_likeness():
    rng = random.Random(1)
    words = [f"t{i}" for i in range(3000)]
    prints = imatch.Fingerprinter(sorted(words))
    near, far = [], []
    for _ in range(60):
        size = rng.choice([40, 200, 900])
        a, b = rng.sample(words, size), rng.sample(words, size)
        one = prints.fingerprint(" ".join(a))
        assert one == prints.fingerprint(" ".join(reversed(a * 2))) and imatch.likeness(one, one) == 1
        near.append(imatch.likeness(one, prints.fingerprint(" ".join(a[: size // 2] + b[size // 2 :]))))
        far.append(imatch.likeness(one, prints.fingerprint(" ".join(b))))
        assert 0 <= near[-1] < 1 and 0 <= far[-1] < 1
    assert sum(near) / 60 > sum(far) / 60 + 0.1


def test_hard_rows(spark):
    single = documents(spark, ["alone here"], [5])
    row = imatch.fingerprint_documents(single).first()
    assert row.near_edited <= 1 and row.near_next == 1 and row.n_chars == 10
    rows = documents(spark, [None, "x", "x", None, "y"], [None, 1, 1, None, None])
    got = imatch.fingerprint_documents(rows)
    assert got.count() == 5 and got.where(F.col("doc_id").isNull()).count() == 3
    assert imatch.fingerprint_documents(documents(spark, [])).collect() == []
