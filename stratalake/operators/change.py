"""Row-level changes: each takes a table and returns the changed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stratalake.session import scratch_path


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows)


def is_true(condition: str | Column) -> Column:
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(condition, F.lit(False))


def update_where(table: DataFrame, condition: str | Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; where it is NULL the row stays as it is."""
    hit = is_true(condition)
    types = {f.name: f.dataType for f in table.schema.fields}
    return table.withColumns(
        {name: F.when(hit, value.cast(types[name])).otherwise(F.col(name)) for name, value in values.items()}
    )


def delete_where(table: DataFrame, condition: str | Column) -> DataFrame:
    """Drop rows where the condition is true; where it is NULL the row stays."""
    return table.where(~is_true(condition))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    delete_missing: bool | str | Column = False,
    checked: bool = False,
) -> DataFrame:
    """Update matched rows, insert the others, optionally delete target rows the source lacks.

    Rows match on equal keys; a NULL key matches nothing, so such target rows stay and such
    source rows are inserted. Columns that only the source has are added, NULL in old rows.
    ``delete_missing`` is ``True`` for all unmatched target rows or a condition on them.
    Unless ``checked`` says the source keys are known to be unique, the merge fails when it runs
    if a target row has two matches; the check is part of the plan, so the source is read once for it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    absent = [c for c in target.columns if c not in source.columns]
    if absent:
        raise ValueError(f"the source lacks columns {absent}")
    kinds = {f.name: f.dataType for f in target.schema.fields}
    incoming = source.select(
        [F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in source.columns]
    )
    if delete_missing is True and checked:
        return _ordered(incoming, target)
    matches = incoming.where(_all_present(keys)).groupBy(*keys).agg(F.count("*").alias(_MATCHES))
    found = target.join(matches, keys, "left")
    if isinstance(delete_missing, bool):
        stays = F.lit(not delete_missing)
    else:
        stays = ~is_true(delete_missing)
    # one expression: no part of it can be evaluated below the join, past the check
    matches = F.col(_MATCHES)
    decided = F.when(matches.isNull(), stays).otherwise(F.lit(False))
    if not checked:
        shown = F.concat(F.lit(AMBIGUOUS), F.to_json(F.struct(*keys)))
        decided = F.when(matches > 1, F.raise_error(shown).cast("boolean")).otherwise(decided)
    kept = found.where(decided).select(target.columns)
    return kept.unionByName(_ordered(incoming, target), allowMissingColumns=True)


_MATCHES = "__matches"
AMBIGUOUS = "several source rows match one target row: "


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _ordered(incoming: DataFrame, target: DataFrame) -> DataFrame:
    added = [c for c in incoming.columns if c not in target.columns]
    return incoming.select([*target.columns, *added])


def merge_partitions(
    path: str,
    source: DataFrame,
    keys: str | Sequence[str],
    partition_column: str,
) -> None:
    """Merge into a table partitioned by ``partition_column``, rewriting only its touched folders.

    The partition value must be a function of the key. Folder names are read as the source's type of
    the column, so ``01`` stays text, and a NULL value matches the folder of NULLs. The source is
    written to scratch once, as it is needed several times. The touched values (a row for each folder to
    be rewritten) prune the folders at planning time. Partition overwrite stages the new files before
    it replaces a folder.
    """
    spark = source.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    staged = scratch_path(spark, "merge")
    source.write.parquet(staged)
    source = spark.read.schema(source.schema).parquet(staged)
    touched = [r[0] for r in source.select(partition_column).distinct().collect()]
    kind = source.schema[partition_column].dataType
    table = spark.read.parquet(path).schema
    declared = StructType([StructField(f.name, kind) if f.name == partition_column else f for f in table.fields])
    column = F.col(f"`{partition_column}`")
    wanted = column.isin([v for v in touched if v is not None])
    if None in touched:
        wanted = column.isNull() | wanted
    old = spark.read.schema(declared).parquet(path).where(wanted)
    (
        merge(old, source, keys)
        .hint("rebalance", partition_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_column)
        .parquet(path)
    )
