"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# fixed values: settings the engine expects of a session
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # stored tables compress to a few MB; at the default of 1 MB they would end in one file, read by one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(app: str = "stakeline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``extra`` wins (underscores stand for dots)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not is_local(spark.sparkContext.master):
        ship(spark)
    return spark


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of a cluster, which need not have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="stakeline-package-", dir="/tmp")  # on the driver, which serves it to the workers
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/stakeline", "zip", root, "stakeline"))


_LOCAL: dict[str, str] = {}


def refuse_remote(master: str) -> None:
    if not is_local(master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Where that setting is absent, a local master gets a folder of its own; any other master is
    refused, because its executors would not see one another's files.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    base = base or _LOCAL.get(context.applicationId)
    if not base:
        refuse_remote(context.master)
        base = _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="spark-stakeline-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
