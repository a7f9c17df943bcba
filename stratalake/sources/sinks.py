"""Writing tables and exporting slices."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.operators.schema import SchemaMismatch


def create_table(df: DataFrame, path: str) -> str:
    """Write a new table; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)
    return path


def overwrite_table(df: DataFrame, path: str) -> str:
    """Replace rows and schema. ``df`` must not read from ``path``; readers see no table while this runs
    (``publish_path`` switches at once)."""
    df.write.mode("overwrite").parquet(path)
    return path


def overwrite_merging(df: DataFrame, path: str) -> str:
    """Replace the rows and keep the columns: those that only the old table has are NULL in the new rows,
    new ones are added. A column with another type raises ``SchemaMismatch`` before anything is written."""
    old = df.sparkSession.read.parquet(path).schema
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in old.fields:
        if field.name in have and have[field.name] != field.dataType:
            raise SchemaMismatch(f"column {field.name}: {have[field.name].simpleString()}, table has {field.dataType.simpleString()}")
    kept = [F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in old.fields]
    added = [F.col(f"`{c}`") for c in df.columns if c not in old.names]
    return overwrite_table(df.select(*kept, *added), path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> str:
    """Write one folder per value of ``columns``.

    The rebalance step gathers each folder's rows into few files and lets adaptive
    execution split a folder that is much larger than the others, so neither many tiny
    files nor one huge task results.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)
    return path


def write_with_filters(df: DataFrame, path: str, values: Mapping[str, int], group_bytes: int | None = None) -> str:
    """Write with a Bloom filter for each column of ``values``, sized for that many different values in a row group.

    For equality on columns the table is not ordered by, whose values every file's minimum and maximum span: a scan skips
    the row groups whose filter says no. A filter costs about 10 bits for each value. ``group_bytes`` sets the size of row groups."""
    writer = df.write.mode("errorifexists")
    for column, distinct in values.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True).option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, null_marker: str | None = None) -> str:
    """Write a CSV folder with header lines that ``read_csv`` reads, each part compressed; ``null_marker`` stands for NULL.

    A part is then read by one task, so it is as large as one partition of ``df``."""
    writer = df.write.mode("errorifexists").option("header", True).option("compression", "gzip")
    (writer if null_marker is None else writer.option("nullValue", null_marker)).csv(path)
    return path


def create_empty(spark: SparkSession, path: str, schema: StructType | str, partition_by: Sequence[str] = ()) -> str:
    writer = spark.createDataFrame([], schema).write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def append_by_name(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Append with columns matched by name and types enforced.

    Missing or extra columns and types that do not fit raise ``SchemaMismatch`` before
    anything is written, so a rejected append leaves the table as it was.
    """
    target = df.sparkSession.read.parquet(path).schema
    writer = matched_by_name(df, target).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def matched_by_name(df: DataFrame, target: StructType) -> DataFrame:
    """``df`` with the columns of ``target`` in its order; only widening casts are allowed."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in target.fields}
    if set(have) != set(want):
        raise SchemaMismatch(f"columns {sorted(have)}, table has {sorted(want)}")
    for name, kind in want.items():
        if have[name] != kind and not _widens(have[name].simpleString(), kind.simpleString()):
            raise SchemaMismatch(
                f"column {name}: {have[name].simpleString()} does not fit {kind.simpleString()}"
            )
    return df.select([F.col(f"`{n}`").cast(t).alias(n) for n, t in want.items()])


def _widens(have: str, want: str) -> bool:
    ladder = ["tinyint", "smallint", "int", "bigint"]
    if have in ladder and want in ladder:
        return ladder.index(have) <= ladder.index(want)
    return (have, want) in {("float", "double"), ("int", "double"), ("smallint", "double"), ("void", want)}


def export_slices(df: DataFrame, path: str, column: str) -> str:
    """One folder per value of ``column``, written in a single pass over the data."""
    return write_partitioned(df, path, [column])


def publish_overwrite(df: DataFrame, table: str, root: str) -> str:
    """Replace the whole content of a catalog table, which ``df`` may itself read from.

    The new files are complete in a fresh folder before the table points at them; readers
    that started on the old files finish on them. Returns the new location.
    """
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/{table.split('.')[-1]}/{uuid.uuid4().hex}"
    df.write.parquet(location)
    if spark.catalog.tableExists(table):
        same = [(f.name, f.dataType) for f in spark.table(table).schema.fields] == [
            (f.name, f.dataType) for f in df.schema.fields
        ]
        if same:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return location
        spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    return location


#: Codec of the tables that layers write: texts without repeats, such as row ids, take half the bytes that Spark's default takes.
COMPRESSION = "zstd"

#: Options of those tables. The second page format writes numbers and texts as differences to those before, a quarter less.
LAYER_OPTIONS = {"compression": COMPRESSION, "parquet.writer.version": "v2"}

CURRENT = "_current"
_CURRENT_SCHEMA = "revision bigint, location string"


def publish_path(df: DataFrame, root: str, keep_former: bool = True) -> str:
    """Write a table to a fresh folder below ``root`` and switch ``root`` to it; returns the folder.

    ``df`` may read the folder that is current. A write that fails leaves the former folder current and
    readable. ``superseded_paths`` lists the folders that may be removed; without ``keep_former`` those are
    removed after the switch, for callers who know that nobody reads them any more.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.options(**LAYER_OPTIONS).parquet(f"{root}/{name}")
    entries = _published(spark, root)
    row = spark.createDataFrame([(len(entries), name)], _CURRENT_SCHEMA)
    row.coalesce(1).write.mode("append").json(f"{root}/{CURRENT}")
    if not keep_former:
        for former in entries:
            remove_folder(spark, f"{root}/{former}")
    return f"{root}/{name}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system it lies; one that is gone already is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _published(spark: SparkSession, root: str) -> list[str]:
    """Folder names in the order they were published."""
    try:
        rows = spark.read.schema(_CURRENT_SCHEMA).json(f"{root}/{CURRENT}").orderBy("revision").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r.location for r in rows]


def current_path(spark: SparkSession, root: str) -> str:
    """The folder that ``root`` points at."""
    published = _published(spark, root)
    if not published:
        raise FileNotFoundError(f"nothing published at {root}")
    return f"{root}/{published[-1]}"


def table_path(spark: SparkSession, root: str) -> str:
    """The folder that ``root`` points at, or ``root`` itself for a table that was never published."""
    published = _published(spark, root)
    return f"{root}/{published[-1]}" if published else root


def superseded_paths(spark: SparkSession, root: str) -> list[str]:
    """Formerly published folders, oldest first. Removing them is the caller's, once their readers have ended."""
    return [f"{root}/{name}" for name in _published(spark, root)[:-1]]
