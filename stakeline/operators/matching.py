"""Name matching between two sources: exact, then normalised, then listed aliases. Never fuzzy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import EQUITY_STREAMS, TOTAL


def right_names(stakes: DataFrame) -> DataFrame:
    return stakes.select(F.col("field_name").alias("equity_field")).distinct()


def normalized_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Right names no left name claims exactly, by key; a key with several names is refused.

    Counting and taking the smallest name replaces collecting a key's names.
    """
    leftovers = right.join(left, right["equity_field"] == left["field"], "left_anti")
    keyed = leftovers.groupBy(X.normalize_name(F.col("equity_field")).alias("name_key")).agg(
        F.count("*").alias("names"), F.min("equity_field").alias("normalized_name")
    )
    return keyed.where("names = 1").select("name_key", "normalized_name")


def match_names(left: DataFrame, right: DataFrame, aliases: DataFrame) -> DataFrame:
    """``left(field)`` x ``right(equity_field)`` -> every left name once, with the match and method.

    A normalised right name stays available to every left name with its key, and
    an alias may point at a right name that is already taken; both as published.
    An alias list with two rows for one left name, or a used alias whose target
    does not exist, stops the job.
    """
    exact = right.select(F.col("equity_field").alias("field"), F.col("equity_field").alias("exact_name"))
    listed = aliases.groupBy(F.col("production_name").alias("field")).agg(
        F.count("*").alias("rows"), F.min("equity_name").alias("alias_name")
    ).select(
        "field",
        F.when(F.col("rows") == 1, F.col("alias_name"))
        .otherwise(F.raise_error(F.concat(F.lit("more than one alias for "), "field")).cast("string"))
        .alias("alias_name"),
    )
    targets = right.select(F.col("equity_field").alias("alias_name"), F.lit(True).alias("alias_exists"))
    known = listed.join(targets, "alias_name", "left")
    keyed = normalized_candidates(left, right)
    # a name that is already matched keeps its own text as key: a null key would put
    # all of them into one partition, and what the key finds is not used for them
    key = F.when(F.col("exact_name").isNull(), X.normalize_name(F.col("field"))).otherwise(F.col("field"))
    joined = (
        left.join(exact, "field", "left")
        .withColumn("name_key", key)
        .join(keyed, "name_key", "left")
        .join(known, "field", "left")
    )
    alias_target = F.when(F.col("alias_exists"), F.col("alias_name")).otherwise(
        F.raise_error(F.concat(F.lit("alias target does not exist: "), "alias_name")).cast("string")
    )
    return joined.select(
        "field",
        F.when(F.col("exact_name").isNotNull(), F.col("exact_name"))
        .when(F.col("normalized_name").isNotNull(), F.col("normalized_name"))
        .when(F.col("alias_name").isNotNull(), alias_target)
        .alias("equity_field"),
        F.when(F.col("exact_name").isNotNull(), "exact")
        .when(F.col("normalized_name").isNotNull(), "normalized")
        .when(F.col("alias_name").isNotNull(), "alias")
        .alias("method"),
    )


def unmatched_left(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("method").isNull()).select("field")


def unmatched_right(matches: DataFrame, right: DataFrame) -> DataFrame:
    claimed = matches.where(F.col("equity_field").isNotNull()).select("equity_field")
    return right.join(claimed, "equity_field", "left_anti")


def name_collisions(right: DataFrame) -> DataFrame:
    """Right names that share a key, one row per name."""
    keyed = right.withColumn("name_key", X.normalize_name(F.col("equity_field")))
    shared = keyed.groupBy("name_key").agg(F.count("*").alias("names")).where("names > 1")
    return keyed.join(shared, "name_key").select("name_key", "equity_field", "names")


def matched_coverage(volumes: DataFrame, matches: DataFrame, pct_decimals: int = 2) -> DataFrame:
    """Per stream: total, matched and unmatched volume, and the share matched.

    One pass over ``volumes`` at field grain; the four streams are unpivoted
    after they have become a single row.
    """
    flagged = volumes.join(matches.select("field", "method"), "field", "left")
    is_matched = F.col("method").isNotNull()
    sums = flagged.agg(
        *[F.sum(s).cast(TOTAL).alias(f"{s}_all") for s in EQUITY_STREAMS],
        *[F.sum(F.when(is_matched, F.col(s)).otherwise(0)).cast(TOTAL).alias(f"{s}_in") for s in EQUITY_STREAMS],
    )
    rows = sums.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("stream"), F.col(f"{s}_all").alias("total"), F.col(f"{s}_in").alias("matched"))
        for s in EQUITY_STREAMS
    ])).alias("r")).select("r.*")
    share = F.lit(100.0) * F.col("matched").cast("double") / F.when(F.col("total") > 0, F.col("total").cast("double"))
    return rows.select(
        "stream",
        F.round("total", 3).alias("total"),
        F.round("matched", 3).alias("matched"),
        F.round(F.col("total") - F.col("matched"), 3).alias("unmatched"),
        F.round(share, pct_decimals).alias("coverage_pct"),
    )


def unmatched_detail(matches: DataFrame, history: DataFrame) -> DataFrame:
    """Span of each unmatched field and its volumes in the overall latest month, if it has any."""
    dated = history.withColumn("latest", history.select(F.max("period")).scalar())
    spans = dated.groupBy("field").agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        *[F.sum(F.when(F.col("period") == F.col("latest"), F.col(s))).alias(s) for s in EQUITY_STREAMS],
        F.max("latest").alias("latest"),
    )
    return spans.join(unmatched_left(matches), "field").select(
        "field", "first_period", "last_period",
        (F.col("last_period") == F.col("latest")).alias("produced_in_latest"), *EQUITY_STREAMS,
    )


def unmatched_cumulative(matches: DataFrame, history: DataFrame) -> DataFrame:
    """Span and whole-history volumes of each unmatched field."""
    return (
        history.join(unmatched_left(matches), "field")
        .groupBy("field")
        .agg(
            F.min("period").alias("first_period"), F.max("period").alias("last_period"),
            *[F.round(F.sum(s), 4).alias(s) for s in EQUITY_STREAMS],
        )
    )


def unmatched_impact(latest: DataFrame, matches: DataFrame) -> DataFrame:
    """Fields without a match: how many, how much they produce now, and which share that is."""
    flagged = matches.join(latest.select("field", "total_mboed"), "field", "left")
    missing = F.col("method").isNull()
    return flagged.agg(
        F.count_if(missing).alias("unmatched_field_count"),
        F.sum(F.when(missing, F.col("total_mboed")).otherwise(0)).cast(TOTAL).alias("u"),
        F.sum("total_mboed").cast(TOTAL).alias("t"),
    ).select(
        "unmatched_field_count",
        F.round("u", 3).alias("unmatched_total_mboed"),
        X.coverage_pct(F.col("u"), F.col("t")).alias("unmatched_production_pct"),
    )


def field_volumes(history: DataFrame) -> DataFrame:
    """Whole-history volumes per field."""
    return history.groupBy("field").agg(*[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS])
