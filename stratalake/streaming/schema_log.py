"""Tracked stream schemas: kept beside the checkpoint and widened when new columns or wider values arrive."""

from __future__ import annotations

import csv
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from stratalake.operators.schema import SchemaMismatch

# every value of the earlier type has the same value in a later one of its row
_LADDERS = (
    (ByteType(), ShortType(), IntegerType(), LongType()),
    (ByteType(), ShortType(), IntegerType(), DoubleType()),
    (FloatType(), DoubleType()),
    (DateType(), TimestampType()),
)


def wider(known: DataType, found: DataType) -> DataType:
    """The narrowest type that holds all values of both; text if nothing else does without loss.

    A 64-bit integer and a fraction have no common number type that keeps every digit, so they are text.
    """
    if known == found:
        return known
    for ladder in _LADDERS:
        if known in ladder and found in ladder:
            return ladder[max(ladder.index(known), ladder.index(found))]
    return StringType()


def discover(spark: SparkSession, path: str, file_format: str) -> StructType:
    """Schema of the files at ``path``: Parquet footers, or CSV headers and values."""
    if file_format == "csv":
        return _discover_csv(spark, path)
    return spark.read.format(file_format).option("mergeSchema", True).load(path).schema


def _discover_csv(spark: SparkSession, path: str) -> StructType:
    """The widest header, with the narrowest types that fit every value of every file.

    CSV values are read by position, so every other header must be the beginning of it. One aggregate
    over all rows tests each column against each type; one row reaches the driver.
    """
    names = _widest_header(spark, path)
    texts = StructType([StructField(name, StringType()) for name in names])
    return _typed(spark.read.option("header", True).schema(texts).csv(path))


def _typed(rows: DataFrame) -> StructType:
    """The narrowest types that fit every value of each text column; a column without values is text."""
    names, tests = rows.columns, _type_tests()
    checks = [
        F.bool_and(F.col(f"`{name}`").isNull() | F.coalesce(test(F.col(f"`{name}`")), F.lit(False))).alias(f"{i}_{kind}")
        for i, name in enumerate(names)
        for kind, (_, test) in enumerate(tests)
    ]
    present = [F.count(F.col(f"`{name}`")).alias(f"n_{i}") for i, name in enumerate(names)]
    fits = rows.agg(*checks, *present).first()
    fields = []
    for i, name in enumerate(names):
        kinds = [t for kind, (t, _) in enumerate(tests) if fits[f"n_{i}"] and fits[f"{i}_{kind}"]]
        fields.append(StructField(name, kinds[0] if kinds else StringType()))
    return StructType(fields)


def _discover_by_name(spark: SparkSession, headers: dict[str, list[str]]) -> StructType:
    """Columns of all headers by name: the files of each header are one scan, and one aggregate tests the union."""
    scans = []
    for header in _distinct(headers):
        texts = StructType([StructField(name, StringType()) for name in header])
        scans.append(spark.read.option("header", True).schema(texts).csv([file for file, own in headers.items() if own == header]))
    whole = scans[0]
    for scan in scans[1:]:
        whole = whole.unionByName(scan, allowMissingColumns=True)
    return _typed(whole)


def _distinct(headers: dict[str, list[str]]) -> list[list[str]]:
    """Different headers in the order of their first files."""
    return [list(header) for header in dict.fromkeys(tuple(headers[file]) for file in sorted(headers)) if header]


def _type_tests():
    """Types from narrow to wide, each with a test that a text reads as such a value."""
    whole, number = "^[+-]?[0-9]+$", "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
    day, moment = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"

    def text_like(pattern: str, kind: str):
        def test(value: Column) -> Column:
            return value.rlike(pattern) & value.try_cast(kind).isNotNull()

        return test

    def fraction(value: Column) -> Column:
        # whole numbers beyond 15 digits would lose some as doubles
        digits = F.length(F.regexp_replace(value, "^[+-]?0*|[eE].*$|[.]", ""))
        return value.rlike(number) & (digits <= 15)

    return [
        (BooleanType(), text_like("^(?i)(true|false)$", "boolean")),
        (IntegerType(), text_like(whole, "int")),
        (LongType(), text_like(whole, "bigint")),
        (DoubleType(), fraction),
        (DateType(), text_like(day, "date")),
        (TimestampType(), text_like(f"{day}|{moment}", "timestamp")),
    ]


def file_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header of every file at ``path`` that is not empty, by file. Each file is a task that stops after its first line; the
    names of the files and their headers reach the driver."""
    own = spark.newSession()  # one file a task, one row a batch, whatever the caller's session does
    for name in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{name}", 1 << 40)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)

    def first_line(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch
                return

    lines = own.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    found = {r.file: next(csv.reader([r.value]), []) for r in lines.mapInArrow(first_line, "value string, file string").collect()}
    for file, header in found.items():
        if len(set(header)) < len(header):
            raise SchemaMismatch(f"CSV header {header} of {file} repeats a name")
    return found


def _widest_header(spark: SparkSession, path: str) -> list[str]:
    """The longest of the header lines, of which all others must be the beginning."""
    headers = list(file_headers(spark, path).values())
    widest = max(headers, key=len, default=[])
    for header in headers:
        if header != widest[: len(header)]:
            raise SchemaMismatch(f"CSV headers {header} and {widest} differ in order")
    return widest


def widened(known: StructType | None, found: StructType) -> StructType:
    """Known columns keep their place and get the wider type; new ones follow in the order found."""
    if known is None:
        return found
    types = {f.name: f.dataType for f in found.fields}
    kept = [StructField(f.name, wider(f.dataType, types.get(f.name, f.dataType))) for f in known.fields]
    return StructType([*kept, *(f for f in found.fields if f.name not in known.names)])


def load(spark: SparkSession, log: str) -> StructType | None:
    """The newest saved schema, or None for a new stream. Only a missing log means a new stream."""
    entries = _entries(spark, log)
    newest = None if entries is None else entries.orderBy("revision", ascending=False).first()
    return StructType.fromJson(json.loads(newest.body)) if newest else None


def _entries(spark: SparkSession, log: str) -> DataFrame | None:
    try:
        return spark.read.schema("revision int, body string").json(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def track(
    spark: SparkSession,
    path: str,
    log: str,
    file_format: str,
) -> StructType:
    """Merge what the files at ``path`` (usually the newest drop) hold into the saved schema.

    A CSV drop may only add columns at the end; any other header order raises
    ``SchemaMismatch`` instead of reading values into wrong columns.
    """
    known = load(spark, log)
    found = discover(spark, path, file_format)
    if file_format == "csv" and known is not None:
        shared = min(len(known.names), len(found.names))
        if known.names[:shared] != found.names[:shared]:
            raise SchemaMismatch(f"CSV header {found.names}, tracked {known.names}")
    return _save(spark, log, known, found)


def _save(spark: SparkSession, log: str, known: StructType | None, found: StructType) -> StructType:
    merged = widened(known, found)
    if known is None or merged != known:
        entries = _entries(spark, log)
        revision = 0 if entries is None else entries.count()
        row = spark.createDataFrame([(revision, merged.json())], "revision int, body string")
        row.write.mode("append").json(log)
    return merged


_HEADERS = "file string, header array<string>"


def track_by_name(spark: SparkSession, path: str, log: str) -> StructType:
    """Merge what the CSV files at ``path`` (usually the newest drop) hold into the saved schema, whatever the order of
    their columns, and remember the header of each file for ``stream_by_name``."""
    headers = {file: header for file, header in file_headers(spark, path).items() if header}
    known = load(spark, log)
    if not headers:
        return known if known is not None else StructType([])
    rows = spark.createDataFrame(list(headers.items()), _HEADERS)
    rows.write.mode("append").json(f"{log}_headers")
    return _save(spark, log, known, _discover_by_name(spark, headers))


def stream_by_name(spark: SparkSession, path: str, schema: StructType, log: str) -> DataFrame:
    """Unbounded table of the CSV files that arrive at ``path``, each read by its own header, in one scan.

    Values are read by place and taken by name: a row meets the header of its file, and each column is
    the place that this header gives it, NULL where it has none. A value that does not fit its type, or a file that
    ``track_by_name`` has not seen, fails the run."""
    known = spark.read.schema(_HEADERS).json(f"{log}_headers").distinct()
    headers = [r.header for r in known.select("header").distinct().orderBy("header").collect()]
    place, file = "__place", "__file"
    number = F.coalesce(*[F.when(F.col("header") == F.array(*map(F.lit, header)), F.lit(i)) for i, header in enumerate(headers)])
    numbered = known.select(F.col("file").alias(f"{file}_"), number.alias("__header"))
    texts = StructType([StructField(f"{place}{i}", StringType()) for i in range(max(map(len, headers)))])
    rows = spark.readStream.format("csv").schema(texts).option("header", True).load(path).select("*", F.col("_metadata.file_path").alias(file))
    met = rows.join(numbered, F.col(file) == F.col(f"{file}_"), "left")
    unknown = F.raise_error(F.concat(F.lit("no header is known of "), F.col(file)))

    def value(field: StructField) -> Column:
        own = [F.when(F.col("__header") == i, F.col(f"{place}{header.index(field.name)}")) for i, header in enumerate(headers) if field.name in header]
        text = F.coalesce(*own, F.lit(None).cast("string")) if own else F.lit(None).cast("string")
        return F.when(F.col("__header").isNull(), unknown.cast("string")).otherwise(text).alias(field.name)

    named = met.select([value(field) for field in schema.fields])
    return named.select([fitting(field) for field in schema.fields])


def fitting(field: StructField) -> Column:
    """The text column of this name as its type; a value that does not fit fails the run."""
    text, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
    if kind == "string":
        return text
    value = text.try_cast(kind)
    said = F.concat(F.lit(f"column {field.name}: not a {kind}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(said).cast(kind)).otherwise(value).alias(field.name)
