import random
import re

import numpy as np
import xxhash
from helpers import clashing, collected, documents, prose

from stratalake.llm import simhash
from stratalake.llm.components import components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits=3):
    """Smallest id reachable for each (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= max_bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(prints))]


def fixture():
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "One two", "İ ẞ two words", "nbsp joined word here"]
    for _ in range(40):
        base = prose(rng, rng.choice([5, 60, 400])).split()
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            base[rng.randrange(len(base))] = "changed"
            texts.append(" ".join(base))
    return texts + texts[20:30] + [prose(rng, 30_000)]


def test_fingerprint_matches_plain_form():
    for text in fixture():
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_components_match_all_pairs(spark, monkeypatch):
    texts = fixture()
    docs = documents(spark, texts)
    want_prints = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    want = sorted((i, f"{p:016x}", c) for (i, p), c in zip(want_prints, plain_components(want_prints)))
    for shard_points, guests in ((8192, 16), (6, 16), (6, 1)):  # one shard, several, several with parted guests
        monkeypatch.setattr(simhash, "GUESTS_PER_POINT", guests)
        found = simhash.with_hex(simhash.near_duplicates(clashing(docs), shard_points=shard_points))
        assert sorted(map(tuple, found.select("doc_id", "fingerprint", "component_id").collect())) == want


def test_shards_lose_no_link():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    near = points[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    dense = points[0] ^ rng.integers(0, 2**8, 600).astype(np.uint64)
    points = np.unique(np.concatenate((points, near, dense)))
    nodes = simhash.grow(points[::7], 40)
    homes, pairs = np.zeros(len(points), int), set()
    for _, index, own in simhash.route(nodes, points, 3):
        homes[index] += own
    assert (homes == 1).all()
    shards: dict = {}
    for leaf, index, own in simhash.route(nodes, points, 3):
        shards.setdefault(leaf, []).append((index, own))
    assert len(shards) > 20
    parent = np.arange(len(points))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for members in shards.values():
        index = np.concatenate([i for i, _ in members])
        own = np.concatenate([np.full(len(i), o) for i, o in members])
        order = np.argsort(points[index])
        index, own = index[order], own[order]
        for i, root in enumerate(simhash.shard_links(points[index], own, 3).roots()):
            a, b = find(index[i]), find(index[root])
            parent[max(a, b)] = min(a, b)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 3):
            pairs.add((find(i), find(j)))
    assert all(a == b for a, b in pairs)


def test_keep_one_of_each_group(spark):
    rng = random.Random(2)
    first, second = prose(rng, 50), prose(rng, 50)
    texts = [second, first, first, second, None, "", prose(rng, 50)]
    docs = documents(spark, texts, [9, 4, 4, 3, 8, 7, None])
    docs = docs.unionByName(docs.where("doc_id = 4").limit(1))
    kept = simhash.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert collected(kept, "doc_id", "text") == collected(documents(spark, [second, first, "", texts[6]], [3, 4, 7, None]), "doc_id", "text")
    assert {r.fp for r in kept.select("fp").collect()} == {"mine"}


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert {got[i] for i in range(31)} == {0} and {got[i] for i in range(100, 150)} == {100}
