"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` tokens. The pieces are dealt to groups of bounded
size by salted row number, and each group packs by best-fit decreasing. Dual feasible functions give
a lower bound on the bins of each group; a group that meets its bound exactly is proven optimal and is done.
The others release the pieces of their emptiest bins, which meet in fewer groups and are packed
again, until no group has a gap or one group is left.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, materialize, schema_text, texts_of, worker_cache

# Fixed value: how the library's byte-level pre-tokenizer parts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CAPACITY = 1024
END_ID = 2
#: Pieces that one group packs.
GROUP_PIECES = 20_000
#: Bins that a group with a gap releases besides the gap itself.
RELEASED_BINS = 16

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Blanks in a row beyond which tiktoken's pattern engine gives up (it does so at some hundred thousand).
LONG_BLANKS = re.compile(r"\s{100000}")


class BytePairEncoder:
    """Ids of a byte-level BPE file of the tokenizers library, by tiktoken: the same merges and pattern, so the
    same ids, in a fifth of the time. Texts with very long runs of blanks go to the library itself."""

    def __init__(self, content: str):
        self.content, self.library = content, None
        self.fast = byte_pair_encoding(json.loads(content))

    def ids(self, text: str) -> list[int]:
        if len(text) < 100_000 or LONG_BLANKS.search(text) is None:
            return self.fast.encode(text, allowed_special="all")
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.content)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library.encode(text, add_special_tokens=False).ids


def byte_pair_encoding(spec: dict):
    """The vocabulary of the file as a tiktoken encoding."""
    import tiktoken

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of each piece; only the first of several may be shorter."""
    total = len(ids)
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first)] + [(at, at + capacity) for at in range(first, total, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each row of ``docs(doc_id, text)``: place in its document, length, CRC of its ids.

    The file is read on the driver and sent along, so executors need no copy of it."""
    bound_batches(docs.sparkSession)
    content = Path(tokenizer_path).read_text(encoding="utf-8")
    key = ("byte_bpe", hashlib.sha256(content.encode()).hexdigest())
    sent = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        encoder = worker_cache(key, lambda: BytePairEncoder(sent.value))
        for batch in columns_of(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                ids = np.array([*encoder.ids(text), end_id], "<u4")
                for number, (start, end) in enumerate(cut(ids, capacity)):
                    rows.append((doc_id, number, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return id_and_text(docs).mapInArrow(run, PIECE_SCHEMA)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece and room left in each bin. Bins are kept by room left; a bit set finds the tightest that fits."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    occupied, room, bins = 0, [], np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = occupied >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[left].pop()
            if not by_room[left]:
                occupied &= ~(1 << left)
        else:
            left, bin_ = capacity, len(room)
            room.append(capacity)
        left -= length
        room[bin_] = left
        by_room[left].append(bin_)
        occupied |= 1 << left
        bins[i] = bin_
    return bins, np.array(room, np.int64)


def bin_bounds(lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Bins that any packing needs, and the same before rounding up: the largest bounds of two families of
    dual feasible functions, by counts of the distinct lengths.

    The first counts pieces above ``capacity - e`` as full, those below ``e`` as nothing and the rest
    by length (``e`` = 0: all by length). Only the smallest ``e`` that makes another length full can be best, so
    there are no more to try than lengths. The second rounds ``(k + 1) x`` down to multiples of the capacity.
    """
    size, counts = np.unique(lengths, return_counts=True)
    many = np.concatenate(([0], np.cumsum(counts)))
    sums = np.concatenate(([0], np.cumsum(counts * size)))
    e = capacity + 1 - size
    e = np.concatenate(([0], e[e <= capacity // 2]))
    small, full = np.searchsorted(size, e), np.searchsorted(size, capacity - e, side="right")
    best = int((sums[full] - sums[small] + (many[-1] - many[full]) * capacity).max())
    whole, exact = -(-best // capacity), best / capacity
    for k in range(1, 21):
        scaled = (k + 1) * size
        values = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)  # times k, to stay whole numbers
        total = int(counts @ values)
        whole, exact = max(whole, -(-total // (capacity * k))), max(exact, total / (capacity * k))
    return whole, exact


def released_bins(bins: np.ndarray, room: np.ndarray, gap: float) -> np.ndarray:
    """Which bins a group with this gap releases: its emptiest, ``RELEASED_BINS`` more than the gap, but no more
    than hold half of its pieces together, so that each round has at most half of the pieces of the one before."""
    emptiest = np.argsort(-room, kind="stable")[: int(np.ceil(gap)) + RELEASED_BINS]
    held = np.cumsum(np.bincount(bins, minlength=len(room))[emptiest])
    released = np.zeros(len(room), bool)
    released[emptiest[held <= len(bins) // 2]] = True
    return released & (room > 0)


def pack_group(lengths: np.ndarray, capacity: int, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, released) of each piece. A group whose bins exceed its bound releases its emptiest bins,
    unless it is the last. The bound before rounding counts: groups that each meet the rounded one may
    still waste part of a bin each."""
    bins, room = best_fit_decreasing(lengths, capacity)
    gap = len(room) - bin_bounds(lengths, capacity)[1]
    released = released_bins(bins, room, gap) if gap > 1e-9 and not last else np.zeros(len(room), bool)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.flatnonzero(np.diff(bins[order], prepend=-1))
    offsets = np.empty(len(lengths), np.int64)
    begin = (ends - lengths[order])
    offsets[order] = begin - np.repeat(begin[first], np.diff(np.append(first, len(order))))
    return bins, offsets, released[bins]


def packer(capacity: int, turn: int, last: bool):
    """Packs the rows of one group; ``turn`` counts the rounds, so that sequence numbers differ between them."""

    def run(rows: pa.Table) -> pa.Table:
        lengths = rows.column("length").to_numpy().astype(np.int64)
        if lengths.min() < 1 or lengths.max() > capacity:
            raise ValueError("a length is outside 1 to capacity")
        bins, offsets, released = pack_group(lengths, capacity, last)
        number = (turn << 56) + (rows.column("group_")[0].as_py() << 24) + bins
        placed = rows.drop_columns(["group_"]).append_column("sequence_id", pa.array(number))
        return placed.append_column("offset", pa.array(offsets)).append_column("released_", pa.array(released))

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``items`` (any columns, ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Rounds end: each has at most half of the pieces of the one before, and one group is the last. Each row is placed
    once, repeated rows too; columns that have the names of the new ones are replaced. Lengths outside the range fail. Empty input: empty result.
    """
    items = items.drop("sequence_id", "offset", "released_", "group_")
    columns = items.columns
    left, settled, turn = materialize(items, "pieces"), None, 0
    while True:
        total = left.count()
        groups = max(1, -(-total // group_pieces))
        last = groups == 1
        # numbers of a written table's rows do not change when a task runs again
        salted = left.withColumn("group_", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

        schema = schema_text(left, "sequence_id bigint", "offset bigint", "released_ boolean")
        placed = materialize(salted.groupBy("group_").applyInArrow(packer(capacity, turn, last), schema), "placed")
        done = placed.where("not released_").drop("released_")
        settled = done if settled is None else settled.unionByName(done)
        left = placed.where("released_").select(*columns)
        if last or left.isEmpty():
            return settled
        left, turn = materialize(left, "pieces"), turn + 1


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all rows of ``docs(doc_id, text)`` with sequence and offset; null texts are empty and hold
    the end id alone. Runs of blanks, letters or digits of any length are encoded as the library does. A row with a null doc_id is packed like any other; repeated rows are each packed.
    Other columns are not read."""
    return pack(pieces(docs, tokenizer_path, capacity, end_id), capacity)
