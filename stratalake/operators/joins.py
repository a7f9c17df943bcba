"""Equi-joins of a large table with a lookup table.

Joins are plain: adaptive execution broadcasts a lookup by its measured size and splits skewed
partitions by rows, whatever their values. Salting by hand is for keys that the caller names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
_KEY = "__key"


def hot_values(source: DataFrame, key: str, pieces: int) -> list:
    """Values of ``key`` that hold at least one in ``pieces`` of the rows, by exact counts.

    At most ``pieces`` values qualify, so the list is bounded. One scan of the key column with
    map-side counts; call it once for a column and use the list for all joins on it.
    """
    counted = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = source.count()
    return [r[0] for r in counted.where(F.col("n") * pieces >= total).select(key).collect()]


def salted_join(
    big: DataFrame, lookup: DataFrame, big_key: str, lookup_key: str, how: str, hot: Sequence, salts: int
) -> DataFrame:
    """Join on one key with the rows of the ``hot`` values dealt over ``salts`` salts, row by row.

    Equal rows get different salts too. Only the lookup rows of hot values are repeated; everything
    else joins once under salt 0. ``how`` is ``inner`` or ``left``. The result has the columns of
    ``big`` followed by those of ``lookup``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    _require_distinct_names(big, lookup)
    row = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    left = big.withColumn(_SALT, F.when(F.col(big_key).isin(*hot), row).otherwise(F.lit(0)))
    last = F.when(F.col(lookup_key).isin(*hot), F.lit(salts - 1)).otherwise(F.lit(0))
    right = lookup.select(
        F.col(lookup_key).alias(_KEY), F.explode(F.sequence(F.lit(0), last)).alias(f"{_SALT}r"), *lookup.columns
    )
    same = (F.col(big_key) == F.col(_KEY)) & (F.col(_SALT) == F.col(f"{_SALT}r"))
    return left.join(right, same, how).drop(_SALT, _KEY, f"{_SALT}r")


def sized(lookup: DataFrame, most_bytes: int = 10 * 1024**2) -> DataFrame:
    """A stored lookup, with a broadcast hint if its rows take at most ``most_bytes`` in memory.

    Its rows are counted first, which reads no column, and few enough rows are measured by their texts.
    """
    if lookup.count() * 16 > most_bytes:
        return lookup
    flexible = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in lookup.dtypes if kind == "string"]
    if len(flexible) < sum(kind.startswith(("string", "binary", "array", "map", "struct", "variant")) for _, kind in lookup.dtypes):
        return lookup
    row = sum(flexible, F.lit(8 + 16 * len(lookup.columns)).cast("bigint"))
    return F.broadcast(lookup) if (lookup.agg(F.sum(row)).first()[0] or 0) <= most_bytes else lookup


def lookup_join(big: DataFrame, lookup: DataFrame, big_key: str, lookup_key: str, how: str = "left") -> DataFrame:
    """Join ``big`` with ``lookup``, without a hint. Column names of the two sides must differ."""
    _require_distinct_names(big, lookup)
    return big.join(lookup, F.col(big_key) == F.col(lookup_key), how)


def _require_distinct_names(big: DataFrame, lookup: DataFrame) -> None:
    shared = set(big.columns) & set(lookup.columns)
    if shared:
        raise ValueError(f"rename before joining: {sorted(shared)}")


def semi_join(big: DataFrame, keys: DataFrame, big_key: str, key: str) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``keys``: the ``IN (subquery)`` of SQL.

    Repeated keys do not repeat rows. Each key is sent once and hashed; rows of ``big`` are sent but never sorted,
    so wide ones do not spill. Both sides are exchanges, so adaptive execution splits a hot key of ``big`` by itself.
    """
    wanted = keys.select(F.col(key).alias(_KEY)).distinct().hint("shuffle_hash")
    return big.join(wanted, F.col(big_key) == F.col(_KEY), "left_semi")
