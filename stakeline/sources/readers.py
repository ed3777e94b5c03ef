"""Readers of landed source data.

The sources are read where a transfer job has put them: pages of a feature
service as JSON, exported tables as CSV or Parquet. Schemas are explicit.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from ..functions import scalars as X
from . import schemas


class SourceError(RuntimeError):
    """A source does not look the way it must."""


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_pages(spark: SparkSession, path: str, schema: str = schemas.FEATURE_PAGE) -> DataFrame:
    """One row per landed page; a malformed page is an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def land_pages(pages: DataFrame, path: str) -> None:
    """Writes pages, one JSON document a line, and beside them the number of features the extract had for each.

    Where the extract counts its pages (``n``) the numbers are taken from there, without gathering the features again.
    """
    pages.drop("n").write.json(f"{path}/pages")
    count = F.col("n") if "n" in pages.columns else F.size("features")
    pages.select("offset", count.cast("bigint").alias("features")).write.parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).parquet(f"{path}/manifest")


def page_stream(spark: SparkSession, path: str, page_size: int, geometry: bool = True) -> DataFrame:
    """``offset, n, exceeded, features`` of the pages that belong to the answer, from JSON lines; a malformed page is an error.

    In the order of their offsets, pages count up to the first that ends the answer: an empty one, or one that is shorter than
    ``page_size`` and doesn't carry the flag that more was left. What lies behind it is not part of the answer.
    """
    shape = schemas.LANDED_PAGE if geometry else schemas.LANDED_PAGE.replace(", geometry: struct<x: double, y: double>", "")
    pages = spark.read.schema(shape).option("mode", "FAILFAST").json(f"{path}/pages").select(
        "offset", F.coalesce(F.size("features"), F.lit(0)).alias("n"),
        F.coalesce("exceededTransferLimit", F.lit(False)).alias("exceeded"), "features")
    ends = (F.col("n") <= 0) | ((F.col("n") < page_size) & ~F.col("exceeded"))
    last = pages.where(ends).agg(F.min("offset")).scalar()
    return pages.where(F.coalesce(F.col("offset") <= last, F.lit(True)))


def page_gaps(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """``offset, expected, fetched`` of pages with another number of features than the extract had for them."""
    fetched = pages.select("offset", F.col("n").cast("bigint").alias("n")).groupBy("offset").agg(F.sum("n").alias("fetched"))
    expected = manifest.select("offset", F.col("features").alias("expected"))
    counts = expected.join(fetched, "offset", "full").select(
        "offset", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("fetched", F.lit(0)).alias("fetched"))
    return counts.where(F.col("expected") != F.col("fetched"))


def fetched_features(spark: SparkSession, path: str, page_size: int, save: Callable[[DataFrame], DataFrame],
                     geometry: bool = True) -> DataFrame:
    """The features of an answer, stored by ``save`` and counted on the way; another count than the extract's is an error.

    The count is observed where the rows pass, so it costs no second reading, and is held against the manifest.
    """
    seen = Observation("fetched")
    stored = save(features(page_stream(spark, path, page_size, geometry), geometry).observe(seen, F.count("*").alias("rows")))
    last = page_stream(spark, path, page_size, geometry).agg(F.max("offset")).scalar()
    expected = read_manifest(spark, path).where(F.col("offset") <= last).agg(F.sum("features")).first()[0] or 0
    if seen.get["rows"] != expected:
        raise SourceError(f"fetched {seen.get['rows']} rows, the extract had {expected}")
    return stored


def features(pages: DataFrame, geometry: bool = True) -> DataFrame:
    """One row per feature. Without geometry the nested columns are never read."""
    rows = pages.select(F.explode("features").alias("f"))
    columns = ["f.attributes.*"] + (["f.geometry.*"] if geometry else [])
    return rows.select(*columns)


def repeated_features(rows: DataFrame, key: str = "object_id") -> DataFrame:
    """Keys that arrived on more than one page."""
    return rows.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def statistics(rows: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Smallest and largest value and row count under a predicate, in one pass."""
    scanned = rows if where is None else rows.where(where)
    return scanned.agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"), F.count("*").alias("row_count")
    )


def footer_statistics(spark: SparkSession, path: str, schema: str, column: str) -> DataFrame:
    """Smallest and largest value of a stored column and the row count, from file footers: no row is read.

    The columnar reader of Spark's second data source API answers these; it is chosen in a session of its own, so
    that no setting of the caller's changes.
    """
    own = spark.newSession()
    for name, value in (("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text"), ("spark.sql.parquet.aggregatePushdown", "true"),
                        ("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))):
        own.conf.set(name, value)
    return statistics(own.read.schema(schema).parquet(path), column)


def newest_year(spark: SparkSession, path: str, schema: str, year: str = "year") -> DataFrame:
    """The largest partition value of a landing, as one row; only the partition column is asked for."""
    return spark.read.schema(schema).parquet(path).agg(F.max(year).alias(year))


def latest_landed(spark: SparkSession, path: str, schema: str, day: str = "reported_on", year: str = "year") -> DataFrame:
    """The reports of the newest month of a landing by year.

    The newest year is found while the query runs and prunes the folders; the newest month within it is a range of the stored day.
    """
    landed = spark.read.schema(schema).parquet(path)
    newest = landed.where(F.col(year) == newest_year(spark, path, schema, year).scalar())
    month = newest.select(F.date_trunc("month", F.max(day)).cast("date")).scalar()
    return newest.where(F.col(day) >= month)


def in_months(spark: SparkSession, path: str, schema: str, first: str, last: str, day: str = "reported_on", year: str = "year") -> DataFrame:
    """The reports of the months YYYYMM from ``first`` to ``last`` of a landing by year: folders by year, row groups by day."""
    begin, end = date(int(first[:4]), int(first[4:]), 1), date(int(last[:4]), int(last[4:]), 1)
    after = date(end.year + end.month // 12, end.month % 12 + 1, 1)
    return spark.read.schema(schema).parquet(path).where(
        F.col(year).between(begin.year, end.year) & (F.col(day) >= F.lit(begin)) & (F.col(day) < F.lit(after)))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with exactly the contract's header; another header or a bad value is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option(
        "mode", "FAILFAST"
    ).csv(path)


def read_classification(spark: SparkSession, path: str) -> DataFrame:
    return checked_classification(read_csv(spark, path, schemas.CLASSIFICATION))


def checked_classification(rows: DataFrame) -> DataFrame:
    """Only 'production' and 'storage' are classes."""
    value = F.trim("classification")
    complaint = F.concat(F.lit("invalid classification: "), F.coalesce(value, F.lit("<null>")))
    return rows.withColumn(
        "classification",
        F.when(value.isin("production", "storage"), value).otherwise(F.raise_error(complaint).cast("string")),
    )


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """No file means no aliases; both names of a row must be filled."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.ALIASES)
    return checked_aliases(read_csv(spark, path, schemas.ALIASES))


def checked_aliases(rows: DataFrame) -> DataFrame:
    def filled(name: str) -> Column:
        return F.when(F.trim(F.coalesce(name, F.lit(""))) != "", F.col(name)).otherwise(
            F.raise_error(F.lit(f"empty {name} in alias list")).cast("string")
        ).alias(name)

    return rows.select(filled("production_name"), filled("equity_name"))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return effective_overrides(read_csv(spark, path, schemas.OVERRIDES))


def effective_overrides(rows: DataFrame) -> DataFrame:
    """Blank entities are skipped; the last line of a repeated entity counts."""
    named = rows.withColumn("entity", F.trim("entity")).where(F.col("entity") != "")
    last = F.max(F.struct("line_no", "display_group", "basis", "status")).alias("o")
    return named.groupBy("entity").agg(last).select("entity", "o.*")


def read_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The previous build's record: empty on a first run, an error when unreadable."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def stakes_wide(rows: DataFrame) -> DataFrame:
    """The interval table with descriptive columns; fully empty rows dropped."""
    return rows.dropna(how="all")


def stakes_narrow(rows: DataFrame) -> DataFrame:
    """Seven columns: names, percentage, dates and the two flags."""
    return stakes_wide(rows).select(
        "field_name", "company_name", "interest_pct", "start_date", "end_date",
        (F.year("start_date") < X.SENTINEL_YEAR).alias("start_is_sentinel"),
        (F.col("interest_pct") == 0).alias("is_zero_interest"),
    )


def published_history(documents: DataFrame) -> DataFrame:
    """Field documents back to one row per (field, month)."""
    return documents.select("field", F.explode("series").alias("p")).select(
        "field", "p.*", X.month_start(F.col("p.period")).alias("month_start")
    )


def field_universe(history: DataFrame, attributes: DataFrame) -> DataFrame:
    """Field -> slug, span, operator, region."""
    spans = history.groupBy("field").agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period")
    )
    return spans.join(attributes.select("field", "operator", "region"), "field").select(
        "field", X.slugify(F.col("field")).alias("slug"), "first_period", "last_period", "operator", "region"
    )


def repeated_names(universe: DataFrame, name: str = "field") -> DataFrame:
    return universe.groupBy(name).agg(F.count("*").alias("copies")).where("copies > 1")
