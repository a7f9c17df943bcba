"""Bucketed tables: rows that share a key lie in one file, so joins and deduplication on it need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def publish_bucketed(df: DataFrame, table: str, root: str, keys: str | Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as the catalog table ``table``, bucketed and sorted by ``keys``; returns the table.

    The rows are dealt as Spark deals buckets, so each task writes one file: tables of equal ``buckets`` on the same
    key meet file by file. The files lie in a fresh folder below ``root`` and stay when the table is dropped.
    ``buckets`` is for the largest of the tables that meet: as many as keep a bucket in one task's memory (a table of
    10 TB: about 50,000). A key that holds more than that does not suit buckets, as they are not split at run time.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    location = f"{root.rstrip('/')}/{table.split('.')[-1]}/{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", location)
    writer.format("parquet").mode("errorifexists").saveAsTable(table)
    return df.sparkSession.table(table)
