"""Declared schemas: conforming projections and checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


class SchemaMismatch(ValueError):
    """A table does not have its declared schema."""


def ddl(text: str) -> StructType:
    return StructType.fromDDL(text)


def wide_keys(schema: StructType) -> StructType:
    """The same schema with 64-bit ids: ``int`` columns named ``...ID`` or ``...Key``.

    The declared 32-bit ids run out at 2.1 billion rows; larger tables use this form.
    """
    def widen(field: StructField) -> StructField:
        is_key = field.name.endswith(("ID", "Key")) and isinstance(field.dataType, IntegerType)
        return StructField(field.name, LongType(), field.nullable) if is_key else field

    return StructType([widen(f) for f in schema.fields])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select, cast and order the declared columns; a value that cannot be cast raises."""
    return df.selectExpr([f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def positional_difference(df: DataFrame, schema: StructType) -> str | None:
    """Same number of columns and, place by place, same name and kind of type.

    Decimal precision and nullability are not compared. Returns the first difference.
    """
    actual = df.schema.fields
    if len(actual) != len(schema.fields):
        return f"{len(actual)} columns, declared {len(schema.fields)}"
    for place, (have, want) in enumerate(zip(actual, schema.fields), start=1):
        if have.name != want.name or type(have.dataType) is not type(want.dataType):
            return (
                f"column {place}: {have.name} {have.dataType.simpleString()}, "
                f"declared {want.name} {want.dataType.simpleString()}"
            )
    return None


def exact_difference(df: DataFrame, schema: StructType) -> str | None:
    """Every declared column exists with the equal type, precision included.

    Extra columns and column order are ignored. Returns the first difference.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    for want in schema.fields:
        have = actual.get(want.name)
        if have != want.dataType:
            shown = have.simpleString() if have is not None else "missing"
            return f"column {want.name}: {shown}, declared {want.dataType.simpleString()}"
    return None


def require_schema(
    df: DataFrame,
    schema: StructType,
    difference: Callable[[DataFrame, StructType], str | None] = positional_difference,
    table: str = "table",
) -> DataFrame:
    """``df`` itself, or ``SchemaMismatch``. Looks at the schema only; no job runs."""
    found = difference(df, schema)
    if found:
        raise SchemaMismatch(f"{table}: {found}")
    return df
