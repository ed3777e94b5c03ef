"""Top-N with a remainder, ranked search and other ordered results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.volumes import PUBLISHED, TOTAL, round3
from .production import annual_average, last_known

OTHER_COMPANIES = "Other companies"
OTHER_FIELDS = "Other fields"
# fixed values: sizes a field chart may ask for
TOP_SIZES = (5, 10, 15, 20)


def leaders(latest: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n keys with the highest last known value, numbered; smaller key first on ties.

    The limit is applied by a distributed top-k first; the numbering then runs
    over n rows only.
    """
    top = latest.orderBy(F.desc(value), key).limit(n)
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(value), key))
    return top.select(key, F.col(value), position.alias("position"))


def labelled(series: DataFrame, key: str, value: str, n: int, other: str) -> DataFrame:
    """``series`` with a ``label``: the key itself for a leader, else ``other``.

    Keys that never had a value belong to neither side and are dropped.
    """
    latest = last_known(series, key, value)
    top = leaders(latest, key, value, n).select(key, F.lit(True).alias("leads"))
    known = latest.select(key).join(F.broadcast(top), key, "left")
    return series.join(known, key).withColumn(
        "label", F.when(F.coalesce("leads", F.lit(False)), F.col(key)).otherwise(other)
    )


def top_n_direct(series: DataFrame, key: str, value: str, n: int = 10, other: str = OTHER_COMPANIES) -> DataFrame:
    """(label, period): leaders as they are, everyone else added up; null only where all are null."""
    return labelled(series, key, value, n, other).groupBy("label", "period").agg(
        F.sum(value).cast(PUBLISHED).alias(value)
    )


def remainder(total: Column, shown: Column) -> Column:
    """What the leaders leave of the total, never below zero; null where the total is unknown."""
    rest = round3(total - F.coalesce(shown, F.lit(0)))
    return F.when(total.isNotNull(), F.greatest(rest, F.lit(0).cast(PUBLISHED)))


def top_n_of_total(series: DataFrame, totals: DataFrame, key: str, value: str, chosen: DataFrame,
                   annual: bool = True, other: str = OTHER_FIELDS) -> DataFrame:
    """(label, bucket): the chosen keys, and the total minus them.

    ``chosen(key)`` holds a bounded selection. When annual, averages are taken
    first and the subtraction is done on the averages.
    """
    shown = series.join(F.broadcast(chosen.select(key)), key, "left_semi").select(key, "period", value)
    whole = totals.select("period", F.col(value).alias("whole"))
    if annual:
        shown = annual_average(shown, [key], [value]).withColumnRenamed("year", "bucket")
        whole = annual_average(whole, [], ["whole"]).withColumnRenamed("year", "bucket")
    else:
        shown = shown.withColumnRenamed("period", "bucket")
        whole = whole.withColumnRenamed("period", "bucket")
    added = shown.groupBy("bucket").agg(F.sum(value).cast(TOTAL).alias("shown"))
    rest = whole.join(added, "bucket", "left").select(
        F.lit(other).alias("label"), "bucket", remainder(F.col("whole"), F.col("shown")).alias(value)
    )
    return shown.select(F.col(key).alias("label"), "bucket", value).unionByName(rest)


def top_n_within(series: DataFrame, totals: DataFrame, key: str, value: str, n: int = 10,
                 other: str = OTHER_FIELDS) -> DataFrame:
    """One owner's fields by month: leaders and the monthly remainder of the owner's own total.

    The remainder exists only when at least one field with a known value is not a leader.
    """
    latest = last_known(series, key, value)
    top = leaders(latest, key, value, n).select(key)
    shown = series.join(F.broadcast(top), key, "left_semi").select(key, "period", value)
    added = shown.groupBy("period").agg(F.sum(value).cast(TOTAL).alias("shown"))
    left_out = latest.agg(F.count("*") > n).scalar()
    rest = totals.select("period", F.col(value).alias("whole")).join(added, "period", "left").where(left_out).select(
        F.lit(other).alias("label"), "period", remainder(F.col("whole"), F.col("shown")).alias(value)
    )
    return shown.select(F.col(key).alias("label"), "period", value).unionByName(rest)


def left_out_names(latest: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The names inside the remainder, one row each."""
    top = leaders(latest, key, value, n).select(key)
    return latest.join(F.broadcast(top), key, "left_anti").select(key)


def field_status(latest: DataFrame, newest: Column, value: str = "total_mboed") -> DataFrame:
    """``producing`` when the last known point is the newest month overall and above zero."""
    return latest.withColumn("producing", (F.col("last_period") == newest) & (F.col(value) > 0))


def search(entries: DataFrame, query: str, k: int = 20) -> DataFrame:
    """Ranked substring search: prefixes, then word starts, then the rest; short labels first."""
    text = query.strip().lower()
    if not text:
        return entries.withColumn("rank", F.lit(0)).where(F.lit(False))
    label = F.lower("label")
    at = F.instr(label, F.lit(text))
    before = F.substring(label, at - 1, F.lit(1))
    rank = F.when(at == 1, 0).when(before.rlike(r"[\s\-(/]"), 1).otherwise(2)
    return (
        entries.where(at > 0)
        .withColumn("rank", rank)
        .orderBy("rank", F.length("label"), "label", "type", "slug")
        .limit(k)
    )


GRAM = 3


def grams(text: Column) -> Column:
    """The different runs of three characters of a text."""
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda k: F.substring(text, k, F.lit(GRAM))))


def postings(entries: DataFrame) -> DataFrame:
    """An inverted index of the entries: one row per entry and run of three characters of its label."""
    return entries.select(F.explode(grams(F.lower("label"))).alias("gram"), *entries.columns)


def search_index(entries: DataFrame, index: DataFrame, query: str, k: int = 20) -> DataFrame:
    """``search`` by an index of ``postings``: only entries that have all runs of the query are ranked.

    ``index`` is read for the query's runs alone; a query of fewer than three characters has none and scans the entries.
    """
    text = query.strip().lower()
    if len(text) < GRAM:
        return search(entries, query, k)
    wanted = sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})
    found = index.where(F.col("gram").isin(wanted)).groupBy(*entries.columns).agg(F.count("*").alias("hits"))
    return search(found.where(F.col("hits") == len(wanted)).drop("hits"), query, k)


def sample_with_total(offenders: DataFrame, order: list[str], k: int = 20) -> DataFrame:
    """The first k offenders and how many more there are."""
    more = offenders.agg(F.greatest(F.count("*") - k, F.lit(0))).scalar()
    return offenders.orderBy(*order).limit(k).withColumn("more", more)


def wide(series: DataFrame, index: str, label: str, value: str, labels: list[str]) -> DataFrame:
    """One column per requested label; null where a label has no point."""
    return series.groupBy(index).pivot(label, labels).agg(F.first(value))
