"""File layout: compaction and clustering. Rows never change, only the files that hold them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from stratalake.sources.files import file_inventory, union_all
from stratalake.sources.sinks import current_path, publish_path

TARGET_FILE_BYTES = 256 * 1024**2


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session whose scans put files together up to ``target_bytes`` for one task."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", target_bytes)
    own.conf.set("spark.sql.files.openCostInBytes", 0)
    own.conf.set("spark.sql.files.minPartitionNum", 1)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def packed(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """The table at ``path`` with one partition for about ``target_bytes`` of files: nothing is shuffled,
    and the rows of each file stay in order."""
    return packing_session(spark, target_bytes).read.parquet(path)


def compact(
    spark: SparkSession,
    path: str,
    out: str,
    target_bytes: int = TARGET_FILE_BYTES,
    partition_by: Sequence[str] = (),
) -> str:
    """Rewrite the table at ``path`` to ``out`` in files of about ``target_bytes``."""
    if partition_by:
        # merges each folder's small files and splits a folder that outgrows the target
        df = spark.read.parquet(path)
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(out)
    else:
        packed(spark, path, target_bytes).write.parquet(out)
    return out


def compact_published(spark: SparkSession, root: str, target_bytes: int = TARGET_FILE_BYTES) -> str:
    """Compact the table that ``root`` points at and switch ``root`` to the new files."""
    return publish_path(packed(spark, current_path(spark, root), target_bytes), root)


#: Bytes of rows that one task of a clustering sorts, about.
SORTED_BYTES = 256 * 1024**2


def cluster(df: DataFrame, columns: str | Sequence[str], files: int, sorted_bytes: int = SORTED_BYTES) -> DataFrame:
    """Order the rows so that each output file covers a narrow range of ``columns``.

    There are ``files`` files, or more if one of them would have a task sort more than ``sorted_bytes``.

    One column: range partitions of that column. Several: range partitions of a Z-order key,
    the interleaved bits of each column's range. A row hash completes the range
    key, so a value that holds a third of the rows fills several files instead of one
    task; each of those files still has a single value as its minimum and maximum.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    files = max(files, math.ceil(row_bytes(df) / sorted_bytes))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    if len(columns) == 1:
        key = F.col(columns[0])
        return df.repartitionByRange(files, key, spread).sortWithinPartitions(key)
    ordered = with_z_value(df, columns, bits_for(files, len(columns)), "__z").withColumn("__spread", spread)
    return ordered.repartitionByRange(files, "__z", "__spread").sortWithinPartitions("__z").drop("__z", "__spread")


def row_bytes(df: DataFrame) -> int:
    """About how many bytes the rows hold in memory: the lengths of texts and a fixed size for each value. One scan, of those columns alone."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields if not isinstance(f.dataType, _FIXED)]
    held = reduce(lambda a, b: a + b, texts, F.lit(0).cast("bigint"))
    rows, lengths = df.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    return rows * (8 + 16 * len(df.columns)) + lengths


_FIXED = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def bits_for(files: int, columns: int) -> int:
    """Bits per column that give about four cells for each file."""
    return max(1, math.ceil((math.log2(max(1, files)) + 2) / columns))


#: Rows for each border that are sampled, on average.
ROWS_PER_BORDER = 64


def with_z_value(df: DataFrame, columns: Sequence[str], bits: int, name: str) -> DataFrame:
    """``df`` with the interleaved bits of the ranges that the values of ``columns`` fall into.

    The size of the plan depends on the number of columns alone: borders are one sorted array a column, which a
    subquery makes, each row searches them in ``bits`` halvings, and one more loop interleaves the found ranges."""
    if bits * len(columns) > 62:
        raise ValueError("too many columns or bits for a 64-bit key")
    borders = range_borders(df, columns, bits)
    arrays, buckets = ([f"__{kind}{place}" for place in range(len(columns))] for kind in ("borders", "bucket"))
    held = df.withColumns({array: borders.select(f"b{place}").scalar() for place, array in enumerate(arrays)})
    found = held.withColumns({bucket: _bucket(F.col(f"`{column}`"), F.col(array), bits) for bucket, column, array in zip(buckets, columns, arrays)}).drop(*arrays)
    taken = " | ".join(f"shiftleft(shiftright({bucket}, bit) & 1L, bit * {len(columns)} + {place})" for place, bucket in enumerate(buckets))
    return found.withColumn(name, F.expr(f"aggregate(sequence(0, {bits - 1}), 0L, (key, bit) -> key | {taken})")).drop(*buckets)


def range_borders(df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """One row of arrays ``b0``, ``b1``, ...: for each column the ``2 ** bits - 1`` values that part it into ranges of about
    equal size, ascending, of any type Spark can order.

    They come from one random sample of the rows, about ``ROWS_PER_BORDER`` for each range whatever the size of the
    table, which one task sorts; where the values of the sample are few, borders repeat."""
    wanted = ROWS_PER_BORDER << bits
    total = df.count()
    sample = df.sample(min(1.0, 1.1 * wanted / total), seed=7) if total > wanted else df
    values = sample.agg(*[F.sort_array(F.collect_list(F.col(f"`{c}`"))).alias(f"v{i}") for i, c in enumerate(columns)])
    place = f"cast(k * size(v{{i}}) div {1 << bits} as int)"
    return values.select(*[F.expr(f"transform(sequence(1, {(1 << bits) - 1}), k -> get(v{i}, {place.format(i=i)}))").alias(f"b{i}") for i in range(len(columns))])


def _bucket(value: Column, borders: Column, bits: int) -> Column:
    """Number of borders at or below the value, by halving; NULL counts as lowest."""
    steps = F.array(*[F.lit(1 << bit).cast("bigint") for bit in reversed(range(bits))])

    def halved(low: Column, step: Column) -> Column:
        return F.when(F.get(borders, (low + step - 1).cast("int")) <= value, low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0).cast("bigint"), halved)


def layout_report(spark: SparkSession, layouts: Mapping[str, str], condition: Column) -> DataFrame:
    """One row per layout (name to path): files, bytes, rows that meet the condition, files that hold them."""
    def one(name: str, path: str) -> DataFrame:
        total = file_inventory(spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        hits = spark.read.parquet(path).where(condition).select(F.col("_metadata.file_path").alias("file"))
        found = hits.groupBy("file").count().agg(F.count("*").alias("files_hit"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows_hit"))
        whole = total.withColumns({c: found.select(c).scalar() for c in found.columns})
        return whole.select(F.lit(name).alias("layout"), "files", "bytes", "files_hit", "rows_hit")

    return union_all(one(name, path) for name, path in layouts.items())


def scanned(df: DataFrame) -> dict[str, int]:
    """Run a query without shuffles and return what its scans counted themselves: ``files`` listed and ``rows`` of the row
    groups read, those that a filter above the scan drops included."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    leaves = run.executedPlan().collectLeaves()
    found = {"files": 0, "rows": 0}
    for place in range(leaves.size()):
        metrics = leaves.apply(place).metrics()
        for name, metric in (("files", "numFiles"), ("rows", "numOutputRows")):
            if metrics.contains(metric):
                found[name] += metrics.apply(metric).value()
    return found
