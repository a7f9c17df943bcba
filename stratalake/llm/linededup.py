"""Line deduplication: range-partitioned line hashes, streamed in order, answered by keep bitmaps.

Every long line becomes a row (128-bit hash of its key, document, position). The rows are dealt by
ranges of (hash, document) and sorted by hash, document (largest first) and position, so each task
streams the occurrences of a key with the document that keeps it first. A key that crosses a range
border (a very frequent line spans many ranges) cannot be judged by one task: its tasks mark the
rows as pending and report how many documents they saw; these reports, at most two for a task, are
summed and joined back. Decisions return to the documents as one compressed bitmap per row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, like_documents, materialize, quoted, same, texts_of, unused

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

LINE_SCHEMA = "h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, pos int"
#: kind 0: dropped; 1: pending (dropped if the whole key is frequent and its keeper is another document);
#: 2: report of a key that touches the task's border, with its documents here and the largest of them.
MARK_SCHEMA = "kind int, h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, pos int, n_docs bigint"


def line_key(line: str) -> str:
    """The line without blanks at its ends, A-Z in lower case."""
    key = line.strip(BLANKS)
    return key.lower() if key.isascii() else key.translate(LOWER)


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each line whose key has at least ``min_chars`` code points."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in columns_of(batches):
            digests, owner, places = [], [], []
            for row, text in enumerate(texts_of(batch)):
                for place, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                        digests.append(xxhash.xxh3_128_digest(key.encode()))
                        owner.append(row)
                        places.append(place)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            owner = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    batch.column("doc_id").take(owner),
                    batch.column("text_hash").take(owner),
                    pa.array(places, pa.int32()),
                ],
                names=["h1", "h2", "doc_id", "text_hash", "pos"],
            )

    return id_and_text(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, LINE_SCHEMA)


class Run:
    """One key while its rows stream by, largest document first. ``first``: rows of it may lie in an earlier task."""

    def __init__(self, key, first: bool, keeper):
        self.key, self.first, self.keeper = key, first, keeper
        self.docs, self.last, self.held = 1, keeper, []


def stream_marks(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Marks for one task's sorted rows. Of one key, only rows before its ``min_docs``-th document are held."""
    run, out = None, []

    def close(run, last):
        if run.first or last:
            out.append((2, *run.key, run.keeper, None, None, run.docs))
            out.extend((1, *run.key, *row, None) for row in run.held)

    def flush():
        columns = list(zip(*out)) or [[]] * 7
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        names = ["kind", "h1", "h2", "doc_id", "text_hash", "pos", "n_docs"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        out.clear()
        return batch

    for batch in columns_of(batches):
        h1, h2, docs, hashes, places = (batch.column(c).to_pylist() for c in ("h1", "h2", "doc_id", "text_hash", "pos"))
        for *key, doc, text_hash, place in zip(h1, h2, docs, hashes, places):
            if run is None or run.key != key:
                if run is not None:
                    close(run, False)
                run = Run(key, run is None, doc)
            elif doc != run.last:
                run.docs, run.last = run.docs + 1, doc
                if run.docs == min_docs and not run.first:
                    out.extend((0, *key, *row, None) for row in run.held)
                    run.held = []
            row = (doc, text_hash, place)
            if run.first:
                out.append((1, *key, *row, None))
            elif doc != run.keeper:
                if run.docs >= min_docs:
                    out.append((0, *key, *row, None))
                else:
                    run.held.append(row)
        if len(out) > 20_000:
            yield flush()
    if run is not None:
        close(run, True)
    yield flush()


def pack_bitmap(dropped: list[int]) -> bytes:
    """Compressed bitmap, bit 1 for a line that stays; lines after its end stay."""
    keep = np.ones((max(dropped) // 8 + 1) * 8, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def kept_lines(text: str, bitmap: bytes | None) -> tuple[str, int, int]:
    """(text of the lines that stay, lines before, lines dropped)."""
    lines = text.split("\n")
    if bitmap is None:
        return text, len(lines), 0
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    kept = [line for place, line in enumerate(lines) if place >= len(keep) or keep[place]]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, bitmap) of each row of ``docs(doc_id, text)`` that loses lines.

    A key found in at least ``min_docs`` documents loses all lines but those in the largest doc_id
    that holds it. Rows with one doc_id are one document, however often and with whatever texts they
    come; rows without a doc_id are together one document, smaller than all others. Null and empty
    texts hold one empty line, which is never long enough. ``text_hash`` (xxhash64) tells apart rows
    with one doc_id. Empty input: empty result. Other columns are not read.
    """
    rows = materialize(line_rows(docs, min_chars), "lines")
    largest = F.desc_nulls_last("doc_id")
    sorted_rows = rows.repartitionByRange("h1", "h2", largest).sortWithinPartitions("h1", "h2", largest, "pos")
    marks = materialize(sorted_rows.mapInArrow(lambda batches: stream_marks(batches, min_docs), MARK_SCHEMA), "marks")
    frequent = (
        marks.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n_docs").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs).select("h1", "h2", "keeper")
    )
    place = ["doc_id", "text_hash", "pos"]
    pending = marks.where("kind = 1").drop("kind", "n_docs").join(F.broadcast(frequent), ["h1", "h2"])  # two reports a task at most
    dropped = marks.where("kind = 0").select(*place).unionByName(
        pending.where(~same(F.col("doc_id"), F.col("keeper"))).select(*place)
    )
    listed = dropped.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))

    def pack(batches):
        for batch in columns_of(batches):
            maps = pa.array([pack_bitmap(d) for d in batch.column("dropped").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), maps], names=["doc_id", "text_hash", "bitmap"])

    return listed.mapInArrow(pack, "doc_id bigint, text_hash bigint, bitmap binary")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column for the bitmap (null: all lines stay), and its name."""
    names = [unused(docs, name) for name in ("bitmap_id_", "bitmap_hash_", "keep_bitmap_")]
    right = bitmaps.select("doc_id", "text_hash", "bitmap").toDF(*names)
    match = same(F.col("doc_id").cast("bigint"), F.col(names[0])) & (F.xxhash64("text") == F.col(names[1]))
    return docs.join(right, match, "left").select(*quoted(docs), names[2]), names[2]


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the texts that stay; texts that lose nothing (null ones too) are unchanged, and
    ``n_chars`` follows the text. A text that loses all its lines becomes empty; its row stays."""
    bound_batches(docs.sparkSession)
    marked, bitmap = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))

    def run(batches):
        for batch in columns_of(batches):
            texts, maps = batch.column("text").to_pylist(), batch.column(bitmap).to_pylist()
            new = [t if m is None else kept_lines(t or "", m)[0] for t, m in zip(texts, maps)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(new, pa.string())).drop_columns([bitmap])

    return like_documents(marked.mapInArrow(run, docs.schema), docs)


def dropped_digests(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row, from its text and its bitmap."""
    bound_batches(docs.sparkSession)
    marked, bitmap = with_bitmaps(id_and_text(docs), keep_bitmaps(docs, min_chars, min_docs))

    def run(batches):
        for batch in columns_of(batches):
            rows = [kept_lines(t, m) for t, m in zip(texts_of(batch), batch.column(bitmap).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lines for _, lines, _ in rows], pa.int64()),
                    pa.array([dropped for *_, dropped in rows], pa.int64()),
                    pa.array([hashlib.sha256(kept.encode()).hexdigest() for kept, *_ in rows], pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return marked.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
