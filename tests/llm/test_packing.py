import json
import random
import time
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from helpers import clashing, collected, documents, prose
from tokenizers import Tokenizer

from stratalake.llm import packing
from stratalake.llm.queries import BYTE_BPE

HARD = [None, "", "a", "<|endoftext|>", "x<|endoftext|> y", "   \n\n\t ", "don't we'll I'M", "é🙂中文 ٣ ​\x85", "\r\n  spaces   here  ", "a" * 3000]


def reference_ids(texts):
    own = Tokenizer.from_file(BYTE_BPE)
    own.no_truncation()
    own.no_padding()
    return [e.ids + [2] for e in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_match_the_library():
    rng = random.Random(1)
    texts = HARD[1:] + ["".join(rng.choice("aB c'st\n\t1²é🙂中<|>.,   　\x1c") for _ in range(rng.randrange(60))) for _ in range(3000)]
    encoder = packing.BytePairEncoder(Path(BYTE_BPE).read_text(encoding="utf-8"))
    assert [encoder.ids(t) + [2] for t in texts] == reference_ids(texts)


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "x" + " " * 1_000_000 + "y", "a" * 1_000_000, "7" * 1_000_000, "-=" * 500_000, "\u00a0" * 400_000], ids=["blanks", "lines", "between", "letter", "digit", "marks", "wide"])
def test_a_megabyte(spark, text):
    want = reference_ids([text])[0]
    rows = packing.pack_documents(documents(spark, [text, "x"]), BYTE_BPE).where("doc_id = 0").orderBy("piece").collect()
    assert sum(r.length for r in rows) == len(want)
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(want[r.start : r.start + r.length], "<u4").tobytes()) for r in rows]


def test_a_changed_file_encodes_anew(spark, tmp_path):
    spec = json.loads(Path(BYTE_BPE).read_text(encoding="utf-8"))
    path, docs = tmp_path / "own.json", documents(spark, ["the weather changes " * 50])
    path.write_text(json.dumps(spec), encoding="utf-8")
    before = packing.pieces(docs, str(path)).collect()
    names = {i: t for t, i in spec["model"]["vocab"].items()}
    spec["model"]["vocab"][names[262]], spec["model"]["vocab"][names[1000]] = 1000, 262
    path.write_text(json.dumps(spec), encoding="utf-8")
    assert packing.pieces(docs, str(path)).collect() != before


def test_pieces_and_places(spark):
    rng = random.Random(3)
    texts = HARD + [prose(rng, rng.choice([3, 40, 300, 2500])) for _ in range(150)] + [prose(rng, 20_000)] + HARD[-1:]
    ids = [*range(len(texts) - 1), None]
    packed = packing.pack_documents(clashing(documents(spark, texts, ids)), BYTE_BPE)
    rows = packed.collect()
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = []
    for doc, own in zip(ids, reference_ids(texts)):
        first = len(own) if len(own) <= 1024 else len(own) % 1024 or 1024
        cuts = [0, *range(first, len(own) + 1, 1024)]
        want += [(doc, k, a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert collected(packed.select("doc_id", "piece", "start", "length", "ids_crc32")) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= packing.bin_bounds(np.array([r.length for r in rows]), 1024)[0] + 1


def best_by_force(lengths, capacity):
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        place(i + 1, rooms + [capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_bound_never_exceeds_the_best():
    rng = random.Random(7)
    met = 0
    for _ in range(150):
        capacity = rng.choice([10, 24, 100])
        lengths = np.array(sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 8))), reverse=True))
        best, bound = best_by_force(lengths.tolist(), capacity), packing.bin_bounds(lengths, capacity)[0]
        bins, room = packing.best_fit_decreasing(lengths, capacity)
        assert bound <= best <= len(room) and (np.bincount(bins, lengths) <= capacity).all()
        met += bound == best
    assert met > 130


def test_bounds_by_distinct_lengths():
    """The same bounds as trying every e."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        capacity = int(rng.integers(4, 90))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 60)))
        best = max(int(np.where(lengths > capacity - e, capacity, np.where(lengths >= e, lengths, 0)).sum()) for e in range(capacity // 2 + 1))
        assert packing.bin_bounds(lengths, capacity)[1] >= best / capacity
        k_best = max(int(np.where((k + 1) * lengths % capacity == 0, lengths * k, (k + 1) * lengths // capacity * capacity).sum()) / (capacity * k) for k in range(1, 21))
        assert packing.bin_bounds(lengths, capacity)[1] == max(best / capacity, k_best)
    started = time.perf_counter()
    packing.bin_bounds(rng.integers(1, 300_002, 20_000), 300_001)
    assert time.perf_counter() - started < 2


@pytest.mark.parametrize("capacity,low,group", [(8191, 100, 400), (1024, 1, 10), (1024, 1, 50), (64, 1, 7)])
def test_rounds_end(spark, capacity, low, group):
    """Few pieces a group, every one of which might be released."""
    rng = random.Random(capacity + group)
    high = 590 if capacity == 8191 else capacity
    lengths = [rng.randrange(low, high + 1) for _ in range(1200)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id bigint, length bigint")
    rows = packing.pack(items, capacity=capacity, group_pieces=group).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths)) and max(used.values()) <= capacity
    bins, room = packing.best_fit_decreasing(np.array(lengths[:group]), capacity)
    assert np.isin(bins, np.flatnonzero(packing.released_bins(bins, room, 5.0))).sum() <= group // 2


def test_groups_exchange_documents(spark):
    rng = random.Random(9)
    lengths = [rng.randrange(1, 60) for _ in range(4000)]
    items = spark.createDataFrame([(i, n, "mine") for i, n in enumerate(lengths)], "id bigint, length bigint, offset string")
    packed = packing.pack(items, capacity=64, group_pieces=300)
    rows = packed.collect()
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths))
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    alone = len(packing.best_fit_decreasing(np.array(lengths), 64)[1])
    assert max(used.values()) <= 64 and len(used) <= alone * 1.02 + 2
    assert {r.sequence_id >> 56 for r in rows} != {0}  # some were packed again


def test_wrong_lengths_fail(spark):
    with pytest.raises(Exception, match="outside 1 to capacity"):
        packing.pack(spark.createDataFrame([(65,)], "length bigint"), capacity=64)


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), BYTE_BPE).collect() == []
