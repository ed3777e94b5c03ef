"""Legal entities mapped to display groups, and series at group grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, PUBLISHED, TOTAL
from .attribution import STREAMS
from .rows import one_row

UNRESOLVED = "Unresolved legal entities"

# fixed values: how a mapping row was established
BASIS_EVIDENCE = "licence equity group"
BASIS_SELF = "registered company identity"
BASIS_REVIEWED = "reviewed manual mapping"


def holder_evidence(holders: DataFrame) -> DataFrame:
    """(entity, group) -> rows in which the entity is the only holder at the row's percentage."""
    named = holders.select(
        X.row_holder(F.col("holder_text"), F.col("equity_pct")).alias("entity"), F.col("holder_group").alias("grp")
    )
    return (
        named.where(F.col("entity").isNotNull() & (F.coalesce("grp", F.lit("")) != ""))
        .groupBy("entity", "grp").agg(F.count("*").alias("rows"))
    )


def build_mapping(entities: DataFrame, evidence: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per entity: override, else single group, else itself (conflict or no evidence)."""
    found = evidence.groupBy("entity").agg(F.count("*").alias("groups"), F.min("grp").alias("only_group"))
    latest = overrides.where(F.trim("entity") != "").groupBy(F.trim("entity").alias("entity")).agg(
        F.max(F.struct("line_no", "display_group", "basis", "status")).alias("o")
    )
    joined = entities.join(found, "entity", "left").join(latest, "entity", "left")
    listed, groups = F.col("o").isNotNull(), F.coalesce("groups", F.lit(0))
    return joined.select(
        "entity",
        F.when(listed, F.col("o.display_group")).when(groups == 1, F.col("only_group"))
        .otherwise(F.col("entity")).alias("display_group"),
        F.when(listed, F.col("o.basis")).when(groups == 1, BASIS_EVIDENCE).otherwise(BASIS_SELF).alias("basis"),
        F.when(listed, F.col("o.status")).when(groups == 1, "approved").otherwise("unresolved").alias("status"),
        F.when(listed, "override").when(groups == 1, "evidence").when(groups > 1, "conflict")
        .otherwise("none").alias("evidence"),
    )


def grouped_entities(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """(entity, grp); an entity without a mapping row is its own group."""
    known = mapping.select("entity", "display_group")
    return entities.join(known, "entity", "left").select(
        "entity", F.coalesce("display_group", F.col("entity")).alias("grp")
    )


def collapsed_entities(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """(entity, grp) with every entity that is not approved in one shared bucket."""
    known = mapping.select("entity", "display_group", "status")
    return entities.join(known, "entity", "left").select(
        "entity",
        F.when(F.col("status") == "approved", F.col("display_group")).otherwise(UNRESOLVED).alias("grp"),
    )


def group_series(series: DataFrame, membership: DataFrame) -> DataFrame:
    """(grp, period, stream): null-safe sum and status over *all* members of the group.

    A member without a row in a month counts as missing. Missing members are
    found by comparing counts, so no member-by-month grid is built.
    """
    sizes = membership.groupBy("grp").agg(F.count("*").alias("members"))
    rated = series.join(membership, series["company"] == membership["entity"])
    sums = rated.groupBy("grp", "period", "stream").agg(
        F.sum("value").cast(TOTAL).alias("value"),
        F.count("value").alias("present"),
        F.count_if(F.col("value").isNotNull() & (F.col("status") == "complete")).alias("complete"),
        F.count_if(F.col("value").isNotNull() & (F.col("status") == "warning")).alias("warning"),
    )
    return sums.join(sizes, "grp").select(
        "grp", "period", "stream",
        F.round("value", 3).cast(PUBLISHED).alias("value"),
        X.group_status(F.col("present"), F.col("members"), F.col("complete"), F.col("warning")).alias("status"),
        "members",
    )


# fixed values: what a stream of a month can be
STATUSES = ("complete", "warning", "unavailable", "not_applicable")


def group_months(wide: DataFrame, membership: DataFrame) -> DataFrame:
    """(grp, period): sum, number of known values and the month's status of every stream, side by side.

    Statuses are numbers while they are grouped: a largest text would have the rows sorted instead of hashed.
    """
    number = lambda status: F.coalesce(*[F.when(status == x, i) for i, x in enumerate(STATUSES)])
    named = lambda code: F.coalesce(*[F.when(code == i, x) for i, x in enumerate(STATUSES)])
    rated = wide.join(membership, wide["company"] == membership["entity"])
    return rated.groupBy("grp", "period").agg(*[
        c for s in STREAMS for c in (
            F.sum(f"{s}.value").cast(TOTAL).alias(s), F.count(f"{s}.value").alias(f"{s}_present"),
            named(F.max(number(F.col(f"{s}.status")))).alias(f"{s}_status"))
    ])


def month_series(months: DataFrame, membership: DataFrame) -> DataFrame:
    """``group_series`` from sums laid side by side: they are unpivoted after the shuffle.

    All members of a month share the status of a stream, so counts of complete and of
    warned values follow from the number of known ones.
    """
    sizes = membership.groupBy("grp").agg(F.count("*").alias("members"))
    points = F.array(*[F.struct(
        F.lit(s).alias("stream"), F.col(s).alias("value"), F.col(f"{s}_present").alias("present"),
        F.col(f"{s}_status").alias("month_status")) for s in STREAMS])
    rows = months.select("grp", "period", F.explode(points).alias("p")).select("grp", "period", "p.*")
    known = lambda status: F.when(F.col("month_status") == status, F.col("present")).otherwise(0)
    return rows.join(sizes, "grp").select(
        "grp", "period", "stream", F.round("value", 3).cast(PUBLISHED).alias("value"),
        X.group_status(F.col("present"), F.col("members"), known("complete"), known("warning")).alias("status"),
        "members",
    )


def energy_months(months: DataFrame) -> DataFrame:
    """Energy equivalents side by side; one row per (grp, period)."""
    return months.select("grp", "period", *[F.round(s, 3).cast(PUBLISHED).alias(s) for s in DERIVED_STREAMS])


def review_report(mapping: DataFrame, series: DataFrame, membership: DataFrame) -> DataFrame:
    """Grouping figures as one row.

    Counts of entities by status, distinct groups, the share of the latest
    month's total under approved mappings and the share of all history that
    groups with several members re-label.
    """
    total = series.where(F.col("stream") == "total_mboed")
    approved_groups = membership.join(
        mapping.where(F.col("status") == "approved").select("entity"), "entity", "left_semi"
    ).select("grp", F.lit(True).alias("has_approved")).distinct()
    value = F.coalesce("value", F.lit(0))
    approved = F.coalesce("has_approved", F.lit(False))
    by_month = total.join(approved_groups, "grp", "left").groupBy("period").agg(
        F.sum(value).cast(TOTAL).alias("all"),
        F.sum(F.when(approved, value)).cast(TOTAL).alias("approved"),
        F.sum(F.when(~approved, value)).cast(TOTAL).alias("rest"),
        F.sum(F.when(F.col("members") > 1, value)).cast(TOTAL).alias("merged"),
    )
    newest = F.max(F.struct("period", "all", "approved", "rest"))
    shares = by_month.agg(
        newest.alias("newest"), F.sum("all").cast(TOTAL).alias("ever"), F.sum("merged").cast(TOTAL).alias("ever_merged")
    ).select(
        F.col("newest.all").alias("latest"), F.col("newest.approved").alias("latest_approved"),
        F.col("newest.rest").alias("latest_rest"), "ever", "ever_merged",
    )
    groups = mapping.groupBy("display_group").agg(
        F.count_if(F.col("status") == "approved").alias("approved"),
        F.count_if(F.col("status") == "unresolved").alias("unresolved"),
    ).agg(
        F.count_if(F.col("approved") > 0).alias("distinct_approved_groups"),
        F.count_if(F.col("unresolved") > 0).alias("unresolved_fallback_count"),
        F.count("*").alias("distinct_display_groups"),
    )
    merged = membership.groupBy("grp").agg(F.count("*").alias("n")).agg(
        F.count_if(F.col("n") > 1).alias("non_singleton_group_count")
    )
    zero = F.lit(0).cast(TOTAL)
    counts = mapping.agg(
        F.count("*").alias("total_legal_entities"),
        F.count_if(F.col("status") == "approved").alias("approved_count"),
        F.count_if(F.col("basis") == BASIS_REVIEWED).alias("reviewed_manual_count"),
        F.count_if(F.col("status") == "unresolved").alias("unresolved_count"),
        F.count_if(F.col("status") == "excluded").alias("excluded_count"),
        F.count_if(F.col("evidence") == "conflict").alias("ambiguous_count"),
    )
    rates = shares.select(
        X.coverage_pct(F.coalesce("latest_approved", zero), F.col("latest")).alias("latest_approved_pct"),
        X.coverage_pct(F.coalesce("latest_rest", zero), F.col("latest")).alias("latest_unresolved_pct"),
        X.coverage_pct(F.coalesce("ever_merged", zero), F.col("ever")).alias("history_relabelled_pct"),
    )
    return one_row(counts, groups, merged, rates)
