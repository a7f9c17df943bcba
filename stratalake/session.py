"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

GIB = 1024**3


def scale_conf(shuffle_bytes: int, cores: int, partition_bytes: int = 192 * 1024**2) -> dict[str, str]:
    """Settings for a run whose widest shuffle moves ``shuffle_bytes``.

    The shuffle starts with partitions of ``partition_bytes`` (never fewer than two
    waves per core) and adaptive execution merges the small ones afterwards, so the same
    code serves a laptop and a thousand executors: 100 TB gives about 546,000 initial
    partitions, 600 KB gives ``2 * cores``.
    """
    initial = max(2 * cores, math.ceil(shuffle_bytes / partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(min(GIB // 2, max(32 * 1024**2, partition_bytes))),
    }


def build_session(
    app: str = "stratalake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` entries win."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with these settings inside a ``with`` block and its own afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def measured_broadcasts(spark: SparkSession) -> dict[str, str]:
    """Settings under which a join side is sent to all by its measured size alone, up to the session's limit.

    Before a run Spark knows a table by the size of its files, and texts that compress well take a hundred times that on
    the driver. Adaptive execution knows the bytes of the rows. Explicit hints count as ever.
    """
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    return {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": adaptive or most}


#: Shuffle files are removed once the query that made them has ended, not when the driver collects its garbage.
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def run_settings(spark: SparkSession) -> dict[str, str]:
    """For runs that write table after table: ``measured_broadcasts`` and ``SHORT_SHUFFLES``."""
    return {**measured_broadcasts(spark), **SHORT_SHUFFLES}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Executors on other machines must see what is written there, so a machine-local
    folder is used only when the whole session is local and nothing is configured.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="stratalake-")
    return f"{base.rstrip('/')}/stratalake/{label}-{uuid.uuid4().hex}"
