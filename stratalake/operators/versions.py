"""Batch versions of a table: append or overwrite, read an earlier state, list the history.

A version is a Parquet partition ``_operation=.../_version=n``; the state at version ``n`` is
every row from the last overwrite up to ``n``, so reading a version prunes folders and
never touches newer or replaced data. A small log beside the data (one row per version: number,
operation, stamps, row count, schema) says which versions exist, so a version without rows and
one with other columns are versions like any other, and the history opens no data file.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from stratalake.operators.schema import SchemaMismatch

VERSION = "_version"
OPERATION = "_operation"
STAMP = "_stamp"
LOG = "_log"  # the underscore hides it from readers of the data

_LOG_SCHEMA = (
    "version int, operation string, row_count bigint, first_stamp timestamp, last_stamp timestamp, body string, "
    "logged timestamp"
)


def write_version(
    df: DataFrame,
    path: str,
    version: int | None = None,
    operation: str = "append",
    stamp: Column | None = None,
) -> int:
    """Add a version and return its number (default: one after the newest).

    Writing the same version and operation again replaces it, so a repeated run is harmless. An
    append may add columns; a column with another type than before raises ``SchemaMismatch``.
    """
    if operation not in ("append", "overwrite"):
        raise ValueError(f"unknown operation {operation}")
    spark = df.sparkSession
    log = read_log(spark, path)
    newest = None if log is None else log.agg(F.max("version")).first()[0]
    if version is None:
        version = 0 if newest is None else newest + 1
    elif log is not None and not log.where((F.col("version") == version) & (F.col("operation") != operation)).isEmpty():
        raise ValueError(f"version {version} exists as another operation")
    if operation == "append" and newest is not None and version > 0:
        _merged([*_schemas(spark, path, version - 1), df.schema])
    _write(tagged(df, F.lit(version), operation, stamp), path)
    moment = F.current_timestamp() if stamp is None else stamp
    row = spark.range(1).select(F.lit(version).alias(VERSION), moment.alias(STAMP))
    counted = _written(spark, path, operation).where(F.col(VERSION) == version).agg(F.count("*").alias("row_count"))
    row = row.withColumns({"row_count": counted.scalar(), "first_stamp": F.col(STAMP), "last_stamp": F.col(STAMP)})
    _log(row, path, operation, df.schema)
    return version


def write_batches(df: DataFrame, path: str, batch: str, stamp: Column | None = None) -> str:
    """Write many appends in one pass: every value of the integer column ``batch`` is a version."""
    marked = tagged(df, F.col(batch).cast("int"), "append", stamp)
    _write(marked.hint("rebalance", VERSION), path)
    counted = (
        _written(df.sparkSession, path, "append").groupBy(VERSION)
        .agg(F.count("*").alias("row_count"), F.min(STAMP).alias("first_stamp"), F.max(STAMP).alias("last_stamp"))
    )
    _log(counted, path, "append", df.schema)
    return path


def tagged(df: DataFrame, version: Column, operation: str, stamp: Column | None) -> DataFrame:
    return df.withColumns(
        {
            STAMP: F.current_timestamp() if stamp is None else stamp,
            OPERATION: F.lit(operation),
            VERSION: version,
        }
    )


def _write(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(OPERATION, VERSION).parquet(path)


_TAGS = [StructField(OPERATION, StringType()), StructField(VERSION, IntegerType())]


def _written(spark: SparkSession, path: str, operation: str) -> DataFrame:
    """Stamps and version numbers of the files there are."""
    tags = StructType([StructField(STAMP, TimestampType()), *_TAGS])
    return spark.read.schema(tags).parquet(path).where(F.col(OPERATION) == operation)


def _log(rows: DataFrame, path: str, operation: str, schema: StructType) -> None:
    entry = rows.select(
        F.col(VERSION).alias("version"), F.lit(operation).alias("operation"), "row_count", "first_stamp", "last_stamp",
        F.lit(schema.json()).alias("body"), F.current_timestamp().alias("logged"),
    )
    entry.write.mode("append").parquet(f"{path}/{LOG}")


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest log row of every version; None where there is no table yet. Any other fault raises."""
    try:
        rows = spark.read.schema(_LOG_SCHEMA).parquet(f"{path}/{LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    fields = ["operation", "row_count", "first_stamp", "last_stamp", "body"]
    newest = F.max_by(F.struct(*fields), F.col("logged")).alias("entry")
    return rows.groupBy("version").agg(newest).select("version", "entry.*")


def newest_version(spark: SparkSession, path: str) -> int | None:
    log = read_log(spark, path)
    return None if log is None else log.agg(F.max("version")).first()[0]


def _state(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """Log rows of the versions that make up the state at ``version``."""
    log = read_log(spark, path)
    if log is None:
        raise ValueError(f"no versions at {path}")
    upto = log if version is None else log.where(F.col("version") <= version)
    start = upto.where("operation = 'overwrite'").agg(F.max("version").alias("v")).scalar()
    return upto.where(start.isNull() | (F.col("version") >= start))


def _schemas(spark: SparkSession, path: str, version: int | None) -> list[StructType]:
    """The different schemas of a state, oldest first."""
    rows = _state(spark, path, version).groupBy("body").agg(F.min("version").alias("v")).orderBy("v").collect()
    return [StructType.fromJson(json.loads(r.body)) for r in rows]


def _merged(schemas: list[StructType]) -> StructType:
    """All columns by name, in the order of their first appearance; one type each."""
    fields: dict[str, StructField] = {}
    for field in (f for schema in schemas for f in schema.fields):
        known = fields.setdefault(field.name, StructField(field.name, field.dataType))
        if known.dataType != field.dataType:
            raise SchemaMismatch(f"column {field.name}: {field.dataType.simpleString()}, before {known.dataType.simpleString()}")
    return StructType(list(fields.values()))


def as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as it was right after ``version`` (default: now), without the version columns.

    Columns that some of its versions lack are NULL there. Two numbers from the log bound the folders.
    """
    schema = _merged(_schemas(spark, path, version))
    first, last = _state(spark, path, version).agg(F.min("version"), F.max("version")).first()
    table = spark.read.schema(StructType([*schema.fields, *_TAGS])).parquet(path)
    return table.where(F.col(VERSION).between(first, last)).select(schema.names)


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version: operation, rows written, first and last write time."""
    log = read_log(spark, path)
    if log is None:
        raise ValueError(f"no versions at {path}")
    return log.drop("body")
