"""Intermediate tables shared by several queries of a session.

A stored table is written once to the shared scratch folder and read back, which
cuts its lineage: later plans start from a scan with column pruning and filter
push-down, and a lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# fixed value: rows of the intervals for one partition, so that what a task holds does not grow with them
PART_ROWS = 100_000

_TABLES: dict[tuple, tuple[str, object]] = {}


def input_version(spark: SparkSession, paths: list[str]) -> tuple:
    """Name, length and time of every file of the inputs; a changed file gives other stored tables."""
    conf, found = spark._jsc.hadoopConfiguration(), []
    for path in (spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths):
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def is_stored(spark: SparkSession, key: tuple, name: str) -> bool:
    return (spark.sparkContext.applicationId, *key, name) in _TABLES


def stored(spark: SparkSession, key: tuple, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    full_key = (spark.sparkContext.applicationId, *key, name)
    if full_key not in _TABLES:
        frame, path = build(), scratch_path(spark, name)
        frame.write.parquet(path)
        _TABLES[full_key] = (path, frame.schema)
    path, schema = _TABLES[full_key]
    return spark.read.schema(schema).parquet(path)


def parts_of(spark: SparkSession, rows: DataFrame) -> int:
    """Partitions for a step that holds its rows in memory: the session's number or one per ``PART_ROWS`` rows of a stored table."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))


def stored_in_buckets(spark: SparkSession, key: tuple, name: str, build: Callable[[], DataFrame], by: list[str],
                      buckets: int | None = None) -> DataFrame:
    """A stored table in sorted buckets of ``by`` (as many as shuffles have partitions, where not given): joins and groupings
    by these columns read it without an exchange."""
    full_key = (spark.sparkContext.applicationId, *key, name)
    if full_key not in _TABLES:
        frame, path, table = build(), scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}"
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        frame.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(table)
        _TABLES[full_key] = (path, table)
    return spark.table(_TABLES[full_key][1])


def stored_in_partitions(spark: SparkSession, key: tuple, name: str, build: Callable[[], DataFrame], by: str) -> str:
    """The path of a stored table with a folder per value of ``by``; its rows come spread and sorted by it."""
    full_key = (spark.sparkContext.applicationId, *key, name)
    if full_key not in _TABLES:
        frame, path = build(), scratch_path(spark, name)
        frame.write.partitionBy(by).parquet(path)
        _TABLES[full_key] = (path, frame.schema)
    return _TABLES[full_key][0]


def forget(keep: tuple[str, ...] = ()) -> None:
    """Deletes every stored table but those named; the next use builds it anew.

    Frames that still read a deleted table fail, so this is for between queries.
    """
    spark = SparkSession.getActiveSession()
    for key in [k for k in _TABLES if k[-1] not in keep]:
        path, what = _TABLES.pop(key)
        if spark is not None:
            if isinstance(what, str):  # a table in buckets
                spark.sql(f"drop table if exists {what}")
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
