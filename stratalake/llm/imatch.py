"""I-Match document fingerprints over randomised subsets of a lexicon.

The lexicon holds the terms within a band of inverse document frequency: those found in at least
``LOW_SHARE`` and at most ``HIGH_SHARE`` of all documents. Its size is bounded by the mean number of
distinct terms of a document divided by ``LOW_SHARE``, whatever the number of documents, so it is
broadcast. A fingerprint sorts the distinct lexicon terms of a text and hashes those that fall into
each of several random subsets of the lexicon. Dense subsets hash many terms, so they agree for equal
texts only; sparse ones hold a term or two of a text, so the share that agrees tells how much two texts
have in common.

Texts meet their successors by ranges of (id, text hash): each range is sorted and streamed, and the first row
of every range is also sent to the range before it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, texts_of

TERM = re.compile(r"\w+")
LOW_SHARE, HIGH_SHARE = 0.001, 0.2
#: Subset ``k`` keeps a term with probability 2 ** -(2 + k // REPEATS).
LEVELS, REPEATS = 11, 16
SUBSETS = LEVELS * REPEATS
#: Terms that a task counts before it hands the counts on.
HELD_TERMS = 300_000
#: Terms of a lexicon that are sent to all tasks at most.
MOST_TERMS = 2_000_000
EMPTY = "0000"


def terms_of(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


def lexicon(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE, most: int = MOST_TERMS) -> list[str]:
    """Sorted terms within the band, counted over the whole texts of all rows. The band starts at 2
    documents at least, and ends at 2 at least. More than ``most`` terms fail, as they are broadcast."""
    bound_batches(docs.sparkSession)

    def count(batches):
        counts: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "docs"])
            counts.clear()
            return batch

        for batch in columns_of(batches):
            for text in texts_of(batch):
                counts.update(terms_of(text))
            if len(counts) > HELD_TERMS:
                yield flush()
        yield flush()

    total = docs.count()
    counted = docs.select("text").mapInArrow(count, "term string, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
    band = counted.where((F.col("docs") >= max(2, low * total)) & (F.col("docs") <= max(2, high * total)))
    terms = []
    for row in band.select("term").toLocalIterator():
        terms.append(row.term)
        if len(terms) > most:
            raise ValueError(f"over {most} terms are in the band from {low} to {high}: narrow it, or raise the bound if tasks can hold them")
    return sorted(terms)


class Fingerprinter:
    """Fingerprints by one lexicon."""

    def __init__(self, terms: list[str]):
        self.place = {term: i for i, term in enumerate(terms)}
        self.hashes = self.hashed(terms)
        parts = [np.nonzero(self.member(self.hashes[at : at + 4096])) for at in range(0, len(terms) + 1, 4096)]
        self.counts = np.concatenate([np.bincount(term, minlength=min(4096, len(terms) - 4096 * i)) for i, (term, _) in enumerate(parts)])
        self.starts = np.cumsum(self.counts) - self.counts
        self.subsets = np.concatenate([subset for _, subset in parts]).astype(np.uint8)  # of the first term, the second, ...
        self.powers = np.ones(1, np.uint64)

    @staticmethod
    def hashed(terms) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(t.encode()) for t in terms], np.uint64)

    @staticmethod
    def member(hashes: np.ndarray) -> np.ndarray:
        """(terms, SUBSETS): whether the subset keeps the term, from a random draw for each pair."""
        salt = (np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
        draw = (hashes[:, None] ^ salt) * np.uint64(0xD6E8FEB86659FD93)
        draw = (draw ^ (draw >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return draw >> (np.uint64(62) - np.arange(SUBSETS, dtype=np.uint64) // np.uint64(REPEATS)) == 0

    def fingerprint(self, text: str) -> str:
        """Four hex digits for each subset, ``EMPTY`` where it holds no term of the text. A text without
        lexicon terms uses all its terms instead, so that only equal term sets agree."""
        terms = terms_of(text)
        place = self.place.get
        kept = np.sort(np.array([p for t in terms if (p := place(t)) is not None], np.int64))  # places follow the terms' order
        if len(kept):
            hashes, counts = self.hashes[kept], self.counts[kept]
            ends = np.cumsum(counts)
            subset = self.subsets[np.repeat(self.starts[kept] - ends + counts, counts) + np.arange(ends[-1])]
            term = np.repeat(np.arange(len(kept)), counts)
        else:
            hashes = self.hashed(sorted(terms))
            term, subset = np.nonzero(self.member(hashes))
        order = np.argsort(subset, kind="stable")  # by subset, and in it the terms in their order
        subset, values = subset[order].astype(np.int64), hashes[term[order]]
        out = np.zeros(SUBSETS, ">u2")
        if len(subset):
            first = np.flatnonzero(np.diff(subset, prepend=-1))
            nth = np.arange(len(subset)) - np.repeat(first, np.diff(np.append(first, len(subset))))
            out[subset[first]] = self.digests(values, nth, first)
        return out.tobytes().hex()

    def digests(self, values: np.ndarray, nth: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A number from 1 to 65535 for each run of term hashes: a polynomial in their order, mixed."""
        if len(self.powers) <= nth.max():
            self.powers = np.cumprod(np.full(2 * int(nth.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        mixed = np.add.reduceat(values * self.powers[nth], first)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed ^ (mixed >> np.uint64(32))) % np.uint64(65535) + np.uint64(1)


def likeness(left: str, right: str) -> float:
    """0 to 1: the share of subsets that agree, among those that hold a term of either text, taken over
    the levels sparse enough to tell (at most three quarters of their subsets hold terms), or else the sparsest."""
    if left == right:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(s), ">u2").reshape(LEVELS, REPEATS) for s in (left, right))
    held, agree = (a > 0) | (b > 0), (a == b) & (a > 0)
    sparse = held.mean(axis=1) <= 0.75
    if not sparse.any():
        sparse[-1] = True
    return float(agree[sparse].sum() / max(1, held[sparse].sum()))


def ranges(rows: DataFrame, count: int) -> list[tuple[bool, int, int]]:
    """First key of each of about ``count`` ranges of about equal numbers of keys, ascending: (id is there, doc_id, text_hash).

    Keys are told apart by text too, so an id that many rows share, or that is missing, is split like any other; rows
    with one key are equal rows, which need no splitting (see ``dealt_rows``)."""
    keys = rows.select(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text_hash").distinct()
    names = ["named", "doc_id", "text_hash"]
    parted = keys.repartitionByRange(count, *names) if count > 1 else keys.coalesce(1)
    found = parted.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*names)).alias("first")).collect()  # a row for each range
    return sorted((row.first.named, row.first.doc_id, row.first.text_hash) for row in found)


def dealt_rows(rows: DataFrame, borders: list[tuple[bool, int, int]]) -> DataFrame:
    """(bucket, guest, doc_id, text_hash, copies, squeezed): every row in its range, and the first row of a range as a guest of
    the range before it. A task sends the text of equal rows once, and how many more it has."""

    def deal(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        types = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["bucket", "guest", "doc_id", "text_hash", "copies", "squeezed"]
        more: Counter = Counter()

        def rows_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        def bucket_of(doc_id, text_hash):
            return bisect_right(borders, (doc_id is not None, doc_id or 0, text_hash)) - 1

        for batch in columns_of(batches):
            out = []
            for doc_id, text_hash, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), texts_of(batch)):
                more[doc_id, text_hash] += 1
                if more[doc_id, text_hash] > 1:
                    continue
                squeezed = squeeze(text.encode())
                bucket = bucket_of(doc_id, text_hash)
                out.append((bucket, False, doc_id, text_hash, 1, squeezed))
                if borders[bucket] == (doc_id is not None, doc_id or 0, text_hash):
                    out.append(((bucket or len(borders)) - 1, True, doc_id, text_hash, 0, squeezed))
            if out:
                yield rows_of(out)
        repeats = [(bucket_of(*key), False, *key, n - 1, None) for key, n in more.items() if n > 1]
        for at in range(0, len(repeats), 10_000):
            yield rows_of(repeats[at : at + 10_000])

    return rows.mapInArrow(deal, "bucket int, guest boolean, doc_id bigint, text_hash bigint, copies bigint, squeezed binary")


def with_successors(docs: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows)`` on a stream of (doc_id, text, next text) over all rows by ascending doc_id, the last
    followed by the first. Rows of one id follow each other by text hash; null ids come first."""
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    borders = ranges(rows, count)

    def keys(batches):
        """(bucket, guest, doc_id, text, copies) of each key of a range."""
        unpack = zstandard.ZstdDecompressor().decompress
        held = None
        for batch in columns_of(batches):
            for bucket, guest, doc_id, text_hash, copies, squeezed in zip(*(c.to_pylist() for c in batch.columns)):
                key = (bucket, guest, doc_id, text_hash)
                if held is not None and held[0] == key:
                    held[2] += copies
                    continue
                if held is not None:
                    yield *held[0][:3], held[1], held[2]
                held = [key, unpack(squeezed).decode(), copies]
        if held is not None:
            yield *held[0][:3], held[1], held[2]

    def pairs(batches):
        before = None
        for bucket, guest, doc_id, text, copies in keys(batches):
            if before is not None and before[0] == bucket:
                _, own_id, own, times = before
                for _ in range(times - 1):
                    yield own_id, own, own
                yield own_id, own, text
            before = None if guest else (bucket, doc_id, text, copies)

    moved = dealt_rows(rows, borders)
    order = ["bucket", "guest", F.asc_nulls_first("doc_id"), "text_hash", F.col("squeezed").isNull()]
    ranged = moved.repartitionById(count, F.col("bucket")).sortWithinPartitions(*order)
    return ranged.mapInArrow(lambda batches: work(pairs(batches)), schema)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: its fingerprint, that of its edited text, and how like they
    and the next row's fingerprint are.

    Null texts are empty; the fingerprint of a text without any term is all ``EMPTY``. A single row is its
    own successor. Rows that share an id are ordered by text hash, null ids come first; repeated rows each
    count. Empty input: empty result. Other columns are not read.
    """
    terms = docs.sparkSession.sparkContext.broadcast(lexicon(docs, low, high))

    def work(rows):
        prints = Fingerprinter(terms.value)
        known: tuple = (None, None)  # the next text is the text of the next row
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        out = []
        for doc_id, text, following in rows:
            own = known[1] if known[0] == text else prints.fingerprint(text)
            known = (following, prints.fingerprint(following))
            changed = edited(text, following)
            other = prints.fingerprint(changed)
            digest = hashlib.sha256(changed.encode()).hexdigest()
            out.append((doc_id, len(text), digest, own, other, likeness(own, other), likeness(own, known[1])))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out))], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out))], names=names)

    return with_successors(docs, work, SCHEMA)
