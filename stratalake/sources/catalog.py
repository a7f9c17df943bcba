"""Databases and named tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.sinks import matched_by_name


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    """Without ``cascade`` a database that still has tables is an error."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` {'CASCADE' if cascade else 'RESTRICT'}")


def create_table(df: DataFrame, table: str) -> None:
    """New Parquet table; an existing one is an error."""
    df.write.format("parquet").mode("errorifexists").saveAsTable(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Create the table or replace its rows and schema. ``df`` must not read from ``table``."""
    df.write.format("parquet").mode("overwrite").saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Append with columns matched by name; a column or type that does not fit raises first."""
    matched_by_name(df, df.sparkSession.table(table).schema).write.mode("append").saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
