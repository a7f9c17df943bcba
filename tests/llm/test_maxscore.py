import math
import random

import numpy as np
import pyarrow as pa
import pytest

from stratalake.llm import maxscore

SCHEMA = "vec_id bigint, embedding array<float>, score int, row string, vector string"


def plain(rows, every=20, top=20):
    fit = [(i, v, [math.floor(64 * x) for x in e]) for i, (v, e, *_) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, query, a in fit:
        if query is None or query % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), v is None, v or 0) for j, v, b in fit if j != i)[:top]
        out += [(query, k, None if none else v, -s) for k, (s, none, v) in enumerate(scored, 1)]
    return sorted(out, key=str)


def vectors(count=700, width=12, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(width)]) for i in range(count)]
    common = [round(rng.gauss(0, 1)) / 4 for _ in range(width)]
    rows += [(1000 + i, common) for i in range(300)]  # ties
    rows += [(3000, None), (3020, [1.0, None]), (3040, [float("nan")] * width), (3060, [float("inf")]), (3080, []), (3100, [2.0, -1.0])]
    rows += [(3120, [0.5] * width)] * 2 + [(None, [3.0] * width)]
    return [(v, e, 1, "mine", "mine") for v, e in rows]


@pytest.mark.parametrize("blocks", [dict(), dict(query_block=7, shard=100), dict(query_block=3, shard=15, bounds=4)])
def test_matches_plain_form(spark, blocks, monkeypatch):
    monkeypatch.setattr(maxscore, "BOUNDS_BLOCK", blocks.pop("bounds", maxscore.BOUNDS_BLOCK))
    rows = vectors()
    found = maxscore.top_inner_products(spark.createDataFrame(rows, SCHEMA).repartition(4), **blocks)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


def clustered(count=3000, groups=12, width=16, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 3) for _ in range(width)] for _ in range(groups)]
    return [(i, [c + rng.gauss(0, 0.05) for c in centres[i % groups]], 1, "", "") for i in range(count)]


def test_slices_are_pruned():
    """Beyond the first slice the tail terms are probed for few candidates, and a known threshold spares postings at once."""
    rng = np.random.default_rng(2)
    there = np.floor(rng.normal(0, 1, (4000, 40)) * (64 / (1 + np.arange(40)) ** 1.5))
    query = there[5]
    postings = [np.ascontiguousarray(there[at : at + 500].T) for at in range(0, 4000, 500)]
    ids = rows = np.arange(4000)
    given = (query, 5, postings, there.min(axis=0), there.max(axis=0), ids, rows, 20)
    scores, places, touched = maxscore.search(*given)
    every = there @ query
    want = [i for i in np.lexsort((ids, -every)) if i != 5][:20]
    assert places.tolist() == want and scores.tolist() == every[want].tolist()
    assert touched < 0.6 * there.size
    again, same, fewer = maxscore.search(*given, least=scores[-1])
    assert same.tolist() == want and again.tolist() == scores.tolist() and fewer < touched


def test_no_vector_exceeds_its_shards_bound():
    rng = np.random.default_rng(5)
    asked = np.floor(rng.normal(0, 64, (30, 9)))
    for width in (5, 9, 12):
        there = [np.floor(rng.normal(rng.normal(0, 90), rng.choice([0.0, 5, 90]), (rng.integers(1, 40), width))) for _ in range(20)]
        tables = [maxscore.bounds_of(pa.table({"shard": pa.array([k] * len(v)), "vector": pa.array(v.astype(int).tolist(), pa.list_(pa.int64()))})) for k, v in enumerate(there)]
        found = maxscore.highest_scores(asked, pa.concat_tables(tables))
        wide = np.zeros((30, max(9, width)))
        wide[:, :9] = asked
        for k, v in enumerate(there):
            assert (wide[:, :width] @ v.T <= found[:, k][:, None]).all()


def test_queries_are_sent_to_promising_shards_only(spark):
    rows = clustered()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    candidates = maxscore.sharded(maxscore.quantized(frame), 125)
    asked = candidates.where("vec_id % 20 = 0").select("row", "vec_id", "vector")
    shards = candidates.select("shard").distinct().count()
    assert shards >= 24 and candidates.groupBy("shard").count().agg({"count": "max"}).first()[0] <= 200
    bounds = candidates.groupBy("shard").applyInArrow(maxscore.bounds_of, maxscore.BOUNDS)
    first = maxscore.met_shards(asked, bounds, shards, 40, True)
    assert first.count() == 150 == first.select("row").distinct().count()
    sent = []
    real = maxscore.scored

    def counted(pairs, *more):
        sent.append(pairs.count())
        return real(pairs, *more)

    maxscore.scored = counted
    try:
        found = maxscore.top_inner_products(frame, query_block=40, shard=125)
        assert sorted(map(tuple, found.collect()), key=str) == plain(rows)
    finally:
        maxscore.scored = real
    assert sent[0] == 150 and sum(sent) < 0.3 * 150 * shards


def test_large_values_fail(spark):
    rows = [(0, [1e18, 1.0], 1, "", ""), (1, [1e18, 2.0], 1, "", "")]
    with pytest.raises(Exception, match="exact arithmetic"):
        maxscore.top_inner_products(spark.createDataFrame(rows, SCHEMA)).collect()


def test_empty_and_few(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert maxscore.top_inner_products(empty).collect() == []
    assert maxscore.top_inner_products(spark.createDataFrame([(20, [1.0], 1, "", "")], SCHEMA)).collect() == []
    two = spark.createDataFrame([(20, [1.0], 1, "", ""), (3, [0.5], 1, "", "")], SCHEMA)
    assert list(map(tuple, maxscore.top_inner_products(two).collect())) == [(20, 1, 3, 2048)]
