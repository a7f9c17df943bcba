"""Reading landing files and tables."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Mapping
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NULL_MARKER = "\\N"


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """No header, no inference: text columns ``_c0``, ``_c1``, ... and header lines are data."""
    return spark.read.csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer: bool = False,
    null_marker: str | None = None,
) -> DataFrame:
    """CSV with a header line.

    Without ``schema`` and ``infer`` every column is text. ``infer`` reads the data twice;
    declare ``schema`` for large files. ``null_marker`` (for example ``NULL_MARKER``) turns
    that text into NULL, which also lets inference see a numeric column as numeric.
    """
    reader = spark.read.option("header", True)
    if null_marker is not None:
        reader = reader.option("nullValue", null_marker)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_path_sql(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """``SELECT *`` straight from a directory, without a catalog entry."""
    escaped = path.replace("`", "``")
    return spark.sql(f"SELECT * FROM {file_format}.`{escaped}`")


def stamped(df: DataFrame, column: str = "bronze_ingestion", stamp: Column | None = None) -> DataFrame:
    """Add the processing time; pass ``stamp`` to fix it."""
    return df.withColumn(column, F.current_timestamp() if stamp is None else stamp)


def landing_manifest(spark: SparkSession, directory: str, suffix: str = ".csv") -> dict[str, str]:
    """Table name to path for every entry ``<table><suffix>`` directly below ``directory``.

    An entry is a file or a folder of part files. Only names are listed (no file is
    opened) and only one row per table reaches the driver.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(directory)
        .select("path")
    )
    base = urlparse(directory).path.rstrip("/")
    entry = F.regexp_extract("path", f"^(.*?{_quoted(base)}/[^/]*{_quoted(suffix)})(?:/|$)", 1)
    rows = listing.select(entry.alias("entry")).where("entry <> ''").distinct().collect()
    return {posixpath.basename(r.entry)[: -len(suffix)]: r.entry for r in sorted(rows)}


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def file_inventory(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """One row per file below ``directory``: path and length, without opening the files."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(directory)
        .select("path", "length")
    )


def file_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes of every file that ``df`` really reads (pruned files do not appear)."""
    return (
        df.select("_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path", "file_size")
        .agg(F.count("*").alias("rows"))
    )


def table_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row count per table in one job; a missing table (``None``) is reported with NULL rows."""
    spark = next(t for t in tables.values() if t is not None).sparkSession
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
        if df is not None
    ]
    absent = [(name, None) for name, df in tables.items() if df is None]
    if absent:
        counted.append(spark.createDataFrame(absent, "table_name string, row_count bigint"))
    return union_all(counted)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
