"""Synthetic sales rows for layout experiments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.calendar import year_month

# Category names and the first and last sales day.
CATEGORIES = ("Eletrônicos", "Roupas", "Alimentos", "Livros", "Brinquedos")
FIRST_DAY = "2022-01-01"
DAYS = 729


def seeded_draws(seed: int) -> list[Column]:
    """Six independent uniform draws per row."""
    return [F.rand(seed + i) for i in range(6)]


def hashed_draws(row_id: Column) -> list[Column]:
    """Six uniform draws per row that depend only on the row's id, whatever the partitioning."""
    def draw(i: int) -> Column:
        digest = F.md5(F.concat(row_id.cast("string"), F.lit(f":{i}")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))

    return [draw(i) for i in range(6)]


def cascade(draws: list[Column]) -> Column:
    """Category by a chain of independent draws against 0.2, 0.4, 0.6, 0.8.

    A row reaches the second test only if it failed the first, so the shares are
    0.20, 0.32, 0.288, 0.154 and 0.038 and not a fifth each.
    """
    chosen = F.lit(CATEGORIES[-1])
    for place in range(len(CATEGORIES) - 2, -1, -1):
        chosen = F.when(draws[place] < (place + 1) / 5, CATEGORIES[place]).otherwise(chosen)
    return chosen


def synthetic_sales(base: DataFrame, draws: list[Column], keep: Sequence[str] = ()) -> DataFrame:
    """One sale per row of ``base``: the columns to ``keep``, day, category, amount in [0, 1000) and month key."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(draws[0] * DAYS).cast("int"))
    sales = base.select(
        *keep,
        day.alias("data_venda"),
        cascade(draws[1:5]).alias("categoria"),
        (draws[5] * 1000).alias("valor"),
    )
    return sales.withColumn("ano_mes", year_month(F.col("data_venda")))


def generate_sales(spark: SparkSession, rows: int, seed: int = 7) -> DataFrame:
    return synthetic_sales(spark.range(rows), seeded_draws(seed))
