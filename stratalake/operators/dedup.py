"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str] = "ModifiedDate",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest ``order`` value for each key.

    Equal order values are settled by ``tie_break`` and then by every other column, left to
    right, larger first, missing last, so the result does not depend on how the input is
    partitioned. ``row_number() = 1`` directly above the window lets Spark run a
    WindowGroupLimit on both sides of the shuffle: each map task sends at most one row per
    key, so a key that holds a third of the table arrives as one row per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    ranked = [c for c in dict.fromkeys([*order, *tie_break, *df.columns]) if c not in keys]
    ranking = ", ".join(f"`{c}` DESC NULLS LAST" for c in ranked)
    grouping = ", ".join(f"`{c}`" for c in keys)
    rank = F.expr(f"row_number() OVER (PARTITION BY {grouping} ORDER BY {ranking})")
    return df.withColumn(_RANK, rank).where(f"{_RANK} = 1").drop(_RANK)


def is_unique(table: DataFrame, key: str) -> bool:
    """Whether no value of ``key`` (NULL too) occurs twice in a stored table: a job that moves the key column alone."""
    return table.groupBy(F.col(f"`{key}`")).count().where("count > 1").isEmpty()
