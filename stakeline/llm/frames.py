"""Small helpers that the operators share: stored tables, Arrow batches, text columns."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows and bytes of one Arrow batch: a worker holds one batch at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
#: Batches after which a worker gives unused memory back.
GIVE_BACK = 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Writes ``frame`` once to the shared folder and reads it back.

    This cuts the lineage: what follows starts from files that every executor sees, so a lost
    executor costs only its running tasks.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def map_arrow(frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes."""
    conf = frame.sparkSession.conf
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    for name, value in limits.items():
        if conf.get(name) != str(value):
            conf.set(name, str(value))

    def tidy(batches):
        for k, batch in enumerate(work(batches), 1):
            yield batch
            if k % GIVE_BACK == 0:
                give_back()
        give_back()
    return frame.mapInArrow(tidy, schema)


def give_back() -> None:
    """Returns what a worker no longer uses; workers live as long as the session and would hold on to their peaks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def texts_as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator needs, under its own names; others can't clash with its results."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *more)
