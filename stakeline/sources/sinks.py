"""Writers.

Documents are laid out as rows: one line per point, unit or interval, keyed by
slug. They are spread by range over (slug, section, position) and sorted, so a
very large document is split over tasks and files instead of being gathered
into one value, and a reader of one slug skips all other files.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import scalars as X
from .readers import _exists
from ..operators.checks import CheckFailed, require_empty



JSON = {"ignoreNullFields": "false"}


def section(rows: DataFrame, name: str, slug: str, order: list[str], text: bool = True) -> DataFrame:
    """Lines of one document section: slug, section, sort text and JSON body.

    Without ``text`` the body stays a struct until it is written; sections of one layout can be put together so.
    """
    body = [c for c in rows.columns if c != slug]
    position = F.concat_ws("|", *[F.col(c).cast("string") for c in order]) if order else F.lit("")
    packed = F.struct(*body)
    return rows.select(
        F.col(slug).alias("slug"), F.lit(name).alias("section"), position.alias("position"),
        (F.to_json(packed, JSON) if text else packed).alias("body"),
    )


def documents(sections: Iterable[DataFrame]) -> DataFrame:
    parts = list(sections)
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined


DOCUMENT = "slug string, section string, position string, body string"


def write_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Deterministic layout: range-partitioned and sorted by slug, section and position.

    Ranges take a pass of their own over the rows; bodies that are structs become text after it and after the exchange.
    """
    order = ["slug", "section", "position"]
    spread = docs.select(*order, "body").repartitionByRange(*order).sortWithinPartitions(*order)
    if dict(spread.dtypes)["body"] != "string":
        spread = spread.withColumn("body", F.to_json("body", JSON))
    spread.write.mode(mode).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).parquet(path)


def read_document(spark: SparkSession, path: str, slug: str) -> DataFrame:
    """The lines of one document; other files and row groups are skipped by their smallest and largest slug."""
    return read_documents(spark, path).where(F.col("slug") == slug)


def combined_size(rows: DataFrame) -> DataFrame:
    """Rows and bytes of the JSON form."""
    return rows.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    )


def write_sized(docs: DataFrame, path: str) -> DataFrame:
    """Writes documents in the one layout there is for every size, and measures them.

    The size is a figure for whoever publishes them; it decides nothing here.
    """
    write_documents(docs, path)
    return combined_size(docs)


def point_features(latest: DataFrame) -> DataFrame:
    """One feature per field at its mean position."""
    return latest.select(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col("lon").cast("double"), F.col("lat").cast("double")).alias("coordinates"),
        ).alias("geometry"),
        F.struct(*[F.col(c) for c in latest.columns if c not in ("lon", "lat")]).alias("properties"),
    )


def polygon_features(shapes: DataFrame) -> DataFrame:
    """One feature per shape; coordinates as JSON text because the two shapes nest differently."""
    rings = F.col("rings")
    coordinates = F.when(F.size(rings) == 1, F.to_json(rings)).otherwise(F.to_json(X.polygon_parts(rings)))
    return shapes.select(
        F.lit("Feature").alias("type"),
        X.geometry_type(rings).alias("geometry_type"),
        coordinates.alias("coordinates"),
        F.struct(*[F.col(c) for c in shapes.columns if c != "rings"]).alias("properties"),
    )


def write_csv(rows: DataFrame, path: str, order: list[str]) -> None:
    """Sorted, with a header; nulls become empty cells."""
    rows.orderBy(*order).write.mode("errorifexists").option("header", True).option("nullValue", "").option(
        "emptyValue", ""
    ).csv(path)


def anomalies(parts: dict[str, DataFrame], period: str = "period") -> DataFrame:
    """Several kinds of findings in one table: kind and JSON payload."""
    return documents([
        rows.select(F.lit(kind).alias("kind"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"))
        for kind, rows in parts.items()
    ])


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark._jvm.org.apache.hadoop.fs
    src, dst = jvm.Path(source), jvm.Path(target)
    fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
    if dst.getParent() is not None:
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise CheckFailed(f"could not move {source} to {target}")


def _commits(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the commits there are: one small file each."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(int(name) for s in fs.listStatus(path) if (name := s.getPath().getName().removesuffix(".json")).isdigit())


def newest_commit(spark: SparkSession, target: str) -> int:
    """Number of the build in force; 0 before the first one."""
    return max(_commits(spark, target), default=0)


def _commit(spark: SparkSession, target: str, number: int, build_id: str) -> None:
    """Creates the commit's file if there is none of its number; the file system lets one of several writers do so."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/commits/{number:012d}.json")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(path, False)
    except Py4JJavaError as error:
        if fs.exists(path):
            raise CheckFailed(f"build {build_id}: another build was published after commit {number - 1}") from error
        raise
    out.write(bytearray(json.dumps({"build_id": build_id}).encode()))
    out.close()


def publish(spark: SparkSession, target: str, build_id: str, tables: dict[str, DataFrame], checks: dict[str, DataFrame],
            write: Callable[[DataFrame, str], None] | None = None, after: int | None = None) -> str:
    """All or nothing: check, write every table to a staging folder, move it into place as one build, commit.

    Readers follow the commit with the largest number. A build follows commit ``after`` (the newest one when it starts,
    by default) and takes the next number, whose file is created only if it is absent: of two builds from one predecessor
    the second is refused, whatever their clocks say. A build that fails before leaves the previous one in force.
    """
    after = newest_commit(spark, target) if after is None else after
    for what, offenders in checks.items():
        require_empty(offenders, what)
    staging, final = f"{target}/_staging/{build_id}", f"{target}/builds/{build_id}"
    if _exists(spark, final):
        raise CheckFailed(f"build {build_id} already exists")
    save = write or (lambda frame, path: frame.write.mode("overwrite").parquet(path))
    for name, frame in tables.items():
        save(frame, f"{staging}/{name}")
    _rename(spark, staging, final)
    _commit(spark, target, after + 1, build_id)
    return final


def current_build(spark: SparkSession, target: str) -> str | None:
    """Path of the build in force, or None before the first one."""
    number = newest_commit(spark, target)
    if not number:
        return None
    row = spark.read.schema("build_id string").option("mode", "FAILFAST").json(f"{target}/commits/{number:012d}.json").first()
    return f"{target}/builds/{row['build_id']}"
