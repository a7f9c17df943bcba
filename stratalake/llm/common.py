"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.session import scratch_path

#: Rows in one Arrow batch: whole texts pass through Python, so a batch must stay small.
BATCH_ROWS = 256


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep the Arrow batches that carry whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(key, build: Callable):
    """``build()`` once for each Python worker process and key (workers serve many tasks)."""
    store = vars(sys).setdefault("_stratalake_worker_cache", {})
    if key not in store:
        store[key] = build()
    return store[key]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null counts as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def columns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (b for b in batches if b.num_rows)


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone: other columns are not read."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def schema_text(df: DataFrame, *more: str) -> str:
    """The schema of ``df`` as text, with further columns."""
    own = ("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in df.schema)
    return ", ".join([*own, *more])


def same(left: Column, right: Column) -> Column:
    """Equality that also matches null with null."""
    return left.eqNullSafe(right)


def like_documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    """Columns of ``docs``, in its order and types; ``n_chars`` follows the text if it is there."""
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return df.select(*quoted(docs))


def in_fold(doc_id: Column) -> Column:
    """True for the held-out fifth: crc32 of the id as text, modulo 5, is 0 (a null id: true)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 5 == 0


#: Code points of the texts of one class that training reads at most.
CHARS_PER_CLASS = 16_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int, chars_per_class: int = CHARS_PER_CLASS) -> DataFrame:
    """(doc_id, text, label) of at most ``rows_per_class`` labelled rows of each class, outside the
    held-out fifth, smallest id hash first, as far as their texts together hold ``chars_per_class`` code points: one task trains
    on them. The picked ids are bounded by the parameter, so they
    are broadcast and the texts are read in one scan. An id with several labels counts as 1 if any is."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~in_fold(F.col("doc_id"))
    )
    one = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = one.where("label = 1").orderBy(*order).limit(rows_per_class).unionByName(
        one.where("label = 0").orderBy(*order).limit(rows_per_class)
    )
    texts = id_and_text(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.max(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label")
    )
    so_far = F.sum(F.length("text")).over(Window.partitionBy("label").orderBy(*order))
    return texts.withColumn("so_far", so_far).where(F.col("so_far") <= chars_per_class).drop("so_far")


def one_task(sample: DataFrame, work: Callable, schema: str):
    """The row that ``work`` makes of a bounded sample in one task (None without rows)."""
    found = sample.repartition(1).mapInArrow(work, schema).collect()
    return found[0] if found else None
