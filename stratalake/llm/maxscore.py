"""Exact top-k inner products by MaxScore over shards of postings.

Each dimension of a vector is a term and its whole-number value the weight. Vectors are sharded by their nearest
pivot, and every shard has bounds on what its vectors can score: the ranges of its terms, and its centre and
radius. A query meets its most promising shard first, which gives it a k-th best score; it is sent on to those
shards only whose bound reaches that score. In a shard, terms are taken by falling bound range, and as
soon as the bounds of the rest sum to no more than the k-th best score so far, the rest is non-essential. The
postings of the essential terms are summed for all candidates of a slice; the others are probed for those
candidates only that can still reach the k-th best score. The best of all shards are merged by a window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.common import columns_of, materialize

TOP = 20
SCALE = 64
QUERY_BLOCK, SHARD = 16384, 8192
#: Vectors at most, by the hash of their row, whose nearest one decides a vector's shard.
PIVOTS = 2048
#: Shards whose bounds one task holds.
BOUNDS_BLOCK = 4096
#: Candidates whose postings are traversed together, and terms probed together.
SLICE, PROBE = 1024, 8


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, vector) with components floor(scale * x); rows that are null or hold null or
    non-finite components are left out. ``row`` numbers the rows of the written table."""
    component = F.col("embedding")
    fit = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(component, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = vectors.where(component.isNotNull() & fit).select(F.monotonically_increasing_id().alias("row"), "vec_id", whole.alias("vector"))
    return materialize(rows, "vectors")


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as float rows, short ones filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy().astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best: score falling, then id, then row."""
    if len(scores) > 4 * top:
        cut = np.partition(scores, len(scores) - top)[len(scores) - top]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((rows[some], ids[some], -scores[some]))[:top]]


def search(query: np.ndarray, own_row: int, postings: list[np.ndarray], lows, highs, ids, rows, top: int, least: float = -np.inf):
    """(scores, places, postings touched): the ``top`` best candidates of one shard that score ``least`` or more.
    ``postings``: slices (terms, candidates)."""
    bounds = np.maximum(query * lows, query * highs)
    ranges = bounds - np.minimum(query * lows, query * highs)
    order = np.argsort(-ranges, kind="stable")
    after = np.append(np.cumsum(bounds[order][::-1])[::-1], 0.0)  # bounds of the terms from each place on
    scores, places = np.empty(0), np.empty(0, np.int64)
    at = touched = 0
    for part in postings:
        enough = np.flatnonzero(after <= least)
        essential = int(enough[0]) if len(enough) else len(order)
        terms = order[:essential]
        partial = query[terms] @ part[terms]
        touched += part[terms].size
        alive = np.flatnonzero(partial + after[essential] >= least)
        partial = partial[alive]
        for start in range(essential, len(order), PROBE):
            if not len(alive):
                break
            terms = order[start : start + PROBE]
            touched += len(terms) * len(alive)
            partial += query[terms] @ part[np.ix_(terms, alive)]
            keep = partial + after[min(start + PROBE, len(order))] >= least
            alive, partial = alive[keep], partial[keep]
        found = alive + at
        other = rows[found] != own_row
        scores, places = np.concatenate((scores, partial[other])), np.concatenate((places, found[other]))
        kept = best_of(scores, ids[places], rows[places], top)
        scores, places = scores[kept], places[kept]
        if len(scores) == top:
            least = max(least, scores[-1])
        at += part.shape[1]
    return scores, places, touched


def shard_best(queries: pa.Table, candidates: pa.Table, top: int) -> pa.Table:
    """The ``top`` best candidates of one shard for each query of one block, of those that score its ``least`` or more."""
    empty = pa.table({"query_row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    if not queries.num_rows or not candidates.num_rows:
        return empty
    width = max(int(np.diff(t.column("vector").combine_chunks().offsets.to_numpy()).max()) for t in (queries, candidates))
    asked, there = matrix(queries.column("vector"), max(1, width)), matrix(candidates.column("vector"), max(1, width))
    if max(1, width) * max(1.0, np.abs(asked).max()) * max(1.0, np.abs(there).max()) >= 2**53:
        raise ArithmeticError("scores of these vectors exceed exact arithmetic")
    raw_ids = candidates.column("vec_id")
    ids = raw_ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    rows = candidates.column("row").to_numpy()
    postings = [np.ascontiguousarray(there[at : at + SLICE].T) for at in range(0, len(there), SLICE)]
    lows, highs = there.min(axis=0), there.max(axis=0)
    taken, best, values = [], [], []
    query_rows, least = queries.column("row").to_numpy(), queries.column("least").to_numpy()
    for i in range(len(asked)):
        scores, places, _ = search(asked[i], query_rows[i], postings, lows, highs, ids, rows, top, least[i])
        taken.append(np.full(len(places), i))
        best.append(places)
        values.append(scores)
    taken, best = np.concatenate(taken), np.concatenate(best)
    return pa.table(
        {
            "query_row": query_rows[taken],
            "query_id": queries.column("vec_id").take(pa.array(taken)),
            "vec_id": raw_ids.take(pa.array(best)),
            "row": rows[best],
            "score": np.concatenate(values).astype(np.int64),
        }
    )


def sharded(rows: DataFrame, shard: int) -> DataFrame:
    """``rows`` with ``shard``: the nearest pivot, and a piece of it by row hash if it has more than ``shard`` vectors."""
    spark = rows.sparkSession
    wanted = min(PIVOTS, -(-rows.count() // shard))
    picked = [r.vector for r in rows.orderBy(F.xxhash64("row"), "row").limit(wanted).collect()] if wanted > 1 else []

    def nearest(batches):
        width = max(map(len, picked), default=0)
        pivots = np.zeros((max(1, len(picked)), max(1, width)))
        for i, vector in enumerate(picked):
            pivots[i, : len(vector)] = vector
        for batch in columns_of(batches):
            some = matrix(batch.column("vector"), max(width, longest(batch.column("vector")), 1))
            # the part of a vector beyond the pivots' width is equally far from all
            near = some[:, : pivots.shape[1]] @ pivots[:, : some.shape[1]].T - (pivots**2).sum(axis=1) / 2
            yield batch.append_column("pivot", pa.array(near.argmax(axis=1).astype(np.int32)))

    dealt = materialize(rows.mapInArrow(nearest, "row bigint, vec_id bigint, vector array<bigint>, pivot int"), "pivots")
    pieces = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / shard).alias("pieces"))  # a row for each pivot
    piece = F.pmod(F.xxhash64("row"), F.col("pieces"))
    return materialize(dealt.join(F.broadcast(pieces), "pivot").select("row", "vec_id", "vector", (F.col("pivot") * F.lit(1 << 32) + piece).alias("shard")), "shards")


def longest(lists) -> int:
    """Length of the longest list of a column."""
    column = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


BOUNDS = "shard bigint, low array<double>, high array<double>, centre array<double>, radius double"


def bounds_of(vectors: pa.Table) -> pa.Table:
    """Ranges of the terms, centre and radius of one shard."""
    there = matrix(vectors.column("vector"), max(1, longest(vectors.column("vector"))))
    centre = there.mean(axis=0)
    radius = float(np.sqrt(((there - centre) ** 2).sum(axis=1).max()))
    values = {"low": there.min(axis=0), "high": there.max(axis=0), "centre": centre}
    columns = {name: pa.array([v.tolist()], pa.list_(pa.float64())) for name, v in values.items()}
    return pa.table({"shard": vectors.column("shard").slice(0, 1), **columns, "radius": pa.array([radius])})


def highest_scores(asked: np.ndarray, bounds: pa.Table) -> np.ndarray:
    """(queries, shards): no vector of the shard scores more. The smaller of two bounds: what the terms' ranges allow, and
    the score of the centre with the radius times the query's length (with room for rounding)."""
    width = max(asked.shape[1], longest(bounds.column("low")))
    wide = np.zeros((len(asked), width))
    wide[:, : asked.shape[1]] = asked
    low, high, centre = (matrix(bounds.column(name), width) for name in ("low", "high", "centre"))
    by_terms = np.maximum(wide, 0) @ high.T + np.minimum(wide, 0) @ low.T
    length, radius = np.sqrt((wide**2).sum(axis=1)), bounds.column("radius").to_numpy()
    reach = length[:, None] * radius[None, :]
    size = length[:, None] * (np.sqrt((centre**2).sum(axis=1)) + radius)[None, :]
    return np.minimum(by_terms, wide @ centre.T + reach + 1e-9 * size + 1e-6)


def met_shards(queries: DataFrame, bounds: DataFrame, shards: int, block: int, first: bool) -> DataFrame:
    """(row, shard, bound): for each query the shard with the highest bound (``first``), or all others whose bound reaches the query's
    ``least``. Only bounds are copied to the blocks of queries, a row for each shard."""
    parts = max(1, -(-shards // BOUNDS_BLOCK))
    blocks = max(1, -(-queries.count() // block))
    every_part, every_block = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (parts, blocks))
    asked = dealt(queries, "block", "row", blocks).withColumn("part", every_part)
    offered = dealt(bounds, "part", "shard", parts).withColumn("block", every_block)

    def meet(some: pa.Table, there: pa.Table) -> pa.Table:
        rows, numbers = some.column("row").to_numpy(), there.column("shard").to_numpy()
        if not len(rows) or not len(numbers):
            return pa.table({"row": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "bound": pa.array([], pa.float64())})
        found = highest_scores(matrix(some.column("vector"), max(1, longest(some.column("vector")))), there)
        if first:
            query, place = np.arange(len(rows)), found.argmax(axis=1)
        else:
            seen = numbers[None, :] == some.column("first").to_numpy()[:, None]
            query, place = np.nonzero((found >= some.column("least").to_numpy()[:, None]) & ~seen)
        return pa.table({"row": rows[query], "shard": numbers[place], "bound": found[query, place]})

    pairs = asked.groupBy("block", "part").cogroup(offered.groupBy("block", "part")).applyInArrow(meet, "row bigint, shard bigint, bound double")
    if not first:
        return pairs
    best = F.max_by("shard", F.struct("bound", "shard"))
    return pairs.groupBy("row").agg(best.alias("shard"))


def dealt(df: DataFrame, column: str, key: str, count: int) -> DataFrame:
    return df.withColumn(column, F.pmod(F.xxhash64(key), F.lit(count)).cast("int"))


def scored(pairs: DataFrame, queries: DataFrame, candidates: DataFrame, top: int, block: int) -> DataFrame:
    """The best of each shard for the queries that are sent to it. A shard with more than ``block`` queries is copied for
    each block of them; a shard without queries is not sent."""
    asked = pairs.select("row", "shard").join(queries.select("row", "vec_id", "vector", "least"), "row")
    sizes = pairs.groupBy("shard").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sent = asked.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    copied = candidates.join(sizes, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def best(some: pa.Table, there: pa.Table) -> pa.Table:
        return shard_best(some, there, top)

    def grouped(df: DataFrame, *columns: str):
        # both sides come from one table: columns of their own
        return df.select(*[F.col(c).alias(c) for c in (*columns, "shard", "block")]).groupBy("shard", "block")

    schema = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"
    asking, offered = grouped(sent, "row", "vec_id", "vector", "least"), grouped(copied, "row", "vec_id", "vector")
    return asking.cogroup(offered).applyInArrow(best, schema)


def top_inner_products(vectors: DataFrame, every: int = 20, top: int = TOP, scale: int = SCALE, query_block: int = QUERY_BLOCK, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, the ``top`` other
    rows with the highest inner product, ties to the smaller vec_id (null ids last) and then to the earlier row.

    Vectors that are null or hold null or non-finite components take no part. Shorter vectors count as
    filled with zeros. Rows with one vec_id are rows of their own: each is a query and a candidate. Values
    too large for exact sums fail. Empty input: empty result. Other columns are not read.
    """
    candidates = sharded(quantized(vectors, scale), shard)
    asked = candidates.where(F.col("vec_id") % every == 0).select("row", "vec_id", "vector")
    first, rest = rounds(asked, candidates, top, query_block)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def rounds(asked: DataFrame, candidates: DataFrame, top: int, query_block: int) -> tuple[DataFrame, DataFrame]:
    """What each query finds in its most promising shard, and in the others that can reach its k-th score there."""
    bounds = materialize(candidates.groupBy("shard").applyInArrow(bounds_of, BOUNDS), "bounds")  # a row for each shard
    shards = bounds.count()
    start = materialize(met_shards(asked, bounds, shards, query_block, first=True), "first-shards")
    first = materialize(scored(start, asked.withColumn("least", F.lit(float("-inf"))), candidates, top, query_block), "first-round")
    # the k-th of at least k found; fewer give no threshold
    kth = first.groupBy("query_row").agg(F.when(F.count("*") >= top, F.min("score").cast("double")).alias("least"))
    known = asked.join(kth, F.col("row") == F.col("query_row"), "left").drop("query_row").join(start.withColumnRenamed("shard", "first"), "row")
    known = known.withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    more = materialize(met_shards(known, bounds, shards, query_block, first=False), "more-shards")
    return first, scored(more, known, candidates, top, query_block)
