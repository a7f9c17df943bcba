"""SimHash near-duplicates by vantage-point trees over the Hamming distance.

Whole texts become 64-bit fingerprints. The distinct fingerprints are dealt to shards by a
vantage-point tree: an inner node holds a pivot and a radius, and points go left if their
distance to the pivot is at most that radius. By the triangle inequality two points within
``max_bits`` can only be parted by a node if both lie that close to its boundary, so only those
points are sent over it as guests, and a shard compares its own points with each other and with
its guests. Inside a shard the same tree is grown further, down to small blocks that are compared
exactly. Copies share a fingerprint and count as one point; a shard reports a spanning forest of
its links, never all pairs.

The tree's pivots come from a sample of the fingerprints (one in ``SAMPLE_RATE``, at most
``SAMPLE_ROWS``); it only places points, so links stay exact whatever the sample holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.common import bound_batches, columns_of, id_and_text, materialize, quoted, texts_of, unused
from stratalake.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Distinct fingerprints that a shard should own.
SHARD_POINTS = 8192
SAMPLE_RATE, SAMPLE_ROWS = 64, 65536
#: Guests of a shard for each point it should own, beyond which they are dealt over several tasks.
GUESTS_PER_POINT = 16
#: Shingles whose bits are counted at once; bounds memory for very long texts.
CHUNK = 1 << 16
#: Pairs compared at once inside a shard.
TILE = 1 << 18


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a whole text; a text without words has fingerprint 0."""
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the blanks \x20 \x09-\x0d
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        hashes = np.array([digest(joined[i:j], SEED) for i, j in pairs], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = counts * 2 > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) of each row; fp is the fingerprint as a signed long."""
    bound_batches(docs.sparkSession)
    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))

    def run(batches):
        for batch in columns_of(batches):
            prints = np.array([fingerprint(t, shingle_words) for t in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(prints.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def hamming(points: np.ndarray, pivot) -> np.ndarray:
    return np.bitwise_count(points ^ pivot)


def split(points: np.ndarray, tries: int = 8) -> tuple[np.uint64, int] | None:
    """Pivot with the widest spread of distances among a few, and the radius that halves the points
    (None if no pivot parts them)."""
    best = None
    for pivot in points[np.linspace(0, len(points) - 1, min(tries, len(points))).astype(int)]:
        spread = hamming(points, pivot)
        if best is None or spread.std() > best[0]:
            best = (spread.std(), pivot, spread)
    if best is None or not best[0]:
        return None
    _, pivot, spread = best
    radius = int(np.median(spread))
    if (spread <= radius).all():
        radius -= 1
    return pivot, radius


def grow(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """Nodes (pivot, radius, left, right) of a tree with about ``leaves`` leaves; a child below 0 is leaf -child - 1."""
    nodes, made = [], [0]

    def build(points, wanted):
        parts = split(points) if wanted > 1 and len(points) > 1 else None
        if parts is None:
            made[0] += 1
            return -made[0]
        pivot, radius = parts
        at, near = len(nodes), hamming(points, pivot) <= radius
        nodes.append(None)
        share = max(1, min(wanted - 1, round(wanted * near.mean())))
        nodes[at] = (int(pivot), radius, build(points[near], share), build(points[~near], wanted - share))
        return at

    build(sample, leaves)
    return nodes


def route(nodes, points: np.ndarray, max_bits: int):
    """(leaf, indices of points, whether they own a place there) for each leaf reached."""

    def walk(at, index, own):
        if not len(index):
            return
        if at < 0:
            yield -at - 1, index, own
            return
        pivot, radius, left, right = nodes[at]
        away = hamming(points[index], np.uint64(pivot)).astype(np.int64)
        near = away <= radius
        if own:
            yield from walk(left, index[near], True)
            yield from walk(right, index[~near], True)
            yield from walk(right, index[near & (away > radius - max_bits)], False)
        else:
            yield from walk(left, index[away <= radius + max_bits], False)
            yield from walk(right, index[away > radius - max_bits], False)

    yield from walk(0 if nodes else -1, np.arange(len(points)), True)


class Forest:
    """Union-find over the points of one shard; the smallest point of a tree is its root."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self) -> np.ndarray:
        while not (self.parent[self.parent] == self.parent).all():
            self.parent = self.parent[self.parent]
        return self.parent

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        size = 64
        while len(left):
            roots = self.roots()
            left, right = roots[left], roots[right]
            apart = left != right
            left, right = left[apart], right[apart]
            for i, j in zip(left[:size].tolist(), right[:size].tolist()):
                self.union(i, j)
            left, right, size = left[size:], right[size:], size * 4

    def union(self, i: int, j: int) -> None:
        parent = self.parent
        while parent[i] != i:
            i = parent[i]
        while parent[j] != j:
            j = parent[j]
        parent[max(i, j)] = min(i, j)


def shard_links(points: np.ndarray, own: np.ndarray, max_bits: int, inner: bool = True) -> Forest:
    """Spanning forest of all links between own points (if ``inner``) and between guests and own points
    (points ascending)."""
    forest = Forest(len(points))

    def tile(a, b):
        step = max(1, TILE // max(1, len(b)))
        for at in range(0, len(a), step):
            part = a[at : at + step]
            i, j = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[b][None, :]) <= max_bits)
            forest.link(part[i], b[j])

    def within(index):
        parts = split(points[index]) if len(index) > 256 else None
        if parts is None:
            for at in range(0, len(index), 512):
                tile(index[at : at + 512], index[at:])
            return
        pivot, radius = parts
        away = hamming(points[index], pivot).astype(np.int64)
        near = away <= radius
        within(index[near])
        within(index[~near])
        between(index[near & (away > radius - max_bits)], index[~near & (away <= radius + max_bits)])

    def between(a, b):
        parts = split(points[b]) if len(b) > 64 and len(a) * len(b) > TILE else None
        if parts is None:
            for at in range(0, len(b), 4096):
                tile(a, b[at : at + 4096])
            return
        pivot, radius = parts
        away_a, away_b = (hamming(points[x], pivot).astype(np.int64) for x in (a, b))
        near_a, near_b = away_a <= radius, away_b <= radius
        out_a, in_a = away_a > radius - max_bits, away_a <= radius + max_bits
        out_b, in_b = away_b > radius - max_bits, away_b <= radius + max_bits
        between(a[near_a], b[near_b])
        between(a[~near_a], b[~near_b])
        between(a[near_a & out_a], b[~near_b & in_b])
        between(a[~near_a & in_a], b[near_b & out_b])

    owned = np.flatnonzero(own)
    if inner:
        within(owned)
    between(np.flatnonzero(~own), owned)
    return forest


def links(prints: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Edges (a, b) between different fingerprints of ``prints(fp)`` whose components are those of all pairs within ``max_bits`` bits."""
    spark, total = prints.sparkSession, prints.count()
    leaves = -(-total // shard_points)
    nodes: list = []
    if leaves > 1:
        rows = min(SAMPLE_ROWS, -(-total // SAMPLE_RATE))
        picked = prints.orderBy(F.xxhash64("fp"), "fp").limit(rows).collect()
        nodes = grow(np.array([r.fp for r in picked], np.int64).view(np.uint64), leaves)
    tree = spark.sparkContext.broadcast(nodes)

    def deal(batches):
        for batch in columns_of(batches):
            points = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for leaf, index, own in route(tree.value, points, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), leaf)), pa.array(points[index].view(np.int64)), pa.array(np.full(len(index), own))],
                    names=["leaf", "fp", "own"],
                )

    def join(rows: pa.Table) -> pa.Table:
        own = rows.column("own").to_numpy()
        points = rows.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(points, kind="stable")
        points, own = points[order], own[order]
        first = rows.column("part")[0].as_py() == 0
        roots = shard_links(points, own, max_bits, first).roots()
        linked = np.flatnonzero(roots != np.arange(len(points)))
        signed = points.view(np.int64)
        return pa.table({"a": signed[roots[linked]], "b": signed[linked]})

    dealt = materialize(prints.select("fp").mapInArrow(deal, "leaf bigint, fp bigint, own boolean"), "dealt")
    parted = part_guests(dealt, GUESTS_PER_POINT * shard_points)
    return parted.groupBy("leaf", "part").applyInArrow(join, "a bigint, b bigint")


def part_guests(dealt: DataFrame, limit: int) -> DataFrame:
    """``dealt`` with a column ``part``: the guests of a shard that has more than ``limit`` are dealt over
    several parts, and each part has a copy of the shard's own points. The first compares those with each other."""
    guests = dealt.where("not own").groupBy("leaf").agg(F.ceil(F.count("*") / limit).cast("int").alias("parts"))
    crowded = guests.where("parts > 1").withColumnRenamed("leaf", "crowded")
    parts = F.coalesce("parts", F.lit(1))
    own_parts = F.sequence(F.lit(0), parts - 1)
    guest_part = F.array(F.pmod(F.xxhash64("fp"), parts).cast("int"))
    joined = dealt.join(crowded, F.col("leaf") == F.col("crowded"), "left")
    return joined.select("leaf", "fp", "own", F.explode(F.when(F.col("own"), own_parts).otherwise(guest_part)).alias("part"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id that chains of fingerprints at ``max_bits`` or fewer
    differing bits reach; ``root`` names the component. Null and blank texts have fingerprint 0
    and link like any other. A null doc_id is kept in its row and is no component id unless the
    component has no other. Repeated rows are repeated in the result. Other columns are not read.
    """
    prints = materialize(fingerprints(docs, shingle_words), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct, max_bits, shard_points))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "named")
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(firsts, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def with_hex(found: DataFrame) -> DataFrame:
    """Fingerprints as 16 lowercase hex digits."""
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents with one row of each group left: that of the smallest doc_id (null ids last, then by
    text hash). Of equal rows one stays. Columns of ``docs`` unchanged."""
    found = near_duplicates(docs, shingle_words, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.doc_id", "first.text_hash")
    # a null id becomes a flag beside a number, so that join and window share one partitioning of the texts
    names = [unused(docs, name) for name in ("named_", "id_", "hash_", "place_")]
    keys = lambda id_, hash_: [id_.isNotNull(), F.coalesce(id_, F.lit(0).cast("bigint")), hash_]
    wanted = kept.select(*[k.alias(n) for k, n in zip(keys(F.col("doc_id"), F.col("text_hash")), names)])
    keyed = docs.withColumns(dict(zip(names, keys(F.col("doc_id").cast("bigint"), F.xxhash64("text")))))
    order = F.xxhash64(*quoted(docs))
    once = F.row_number().over(Window.partitionBy(*names[:3]).orderBy(order))
    return keyed.join(wanted, names[:3], "left_semi").withColumn(names[3], once).where(F.col(names[3]) == 1).select(*quoted(docs))
