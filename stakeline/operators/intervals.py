"""Dated ownership intervals resolved at month starts.

A half-open interval is active in exactly the months whose first day lies in
it, so the range join between production months and intervals becomes an
equality join on (field, month) once every interval is laid out over its
months. That keeps a field with very many intervals spread over the cluster,
leaves no range test between the two sides, and lets the interval side be
reduced to one row per (field, month) by partial aggregation before it meets
production. Months outside the production window are never generated.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as X
from ..functions.volumes import EQUITY_STREAMS, PERCENT, PUBLISHED, SHARE, TOTAL

MICRO = Decimal("0.000001")

# fixed values: every field-month is in exactly one of these
CATEGORIES = (
    "resolved", "unmatched", "no_equity_history", "quarantined", "e1_sum_mismatch",
    "pre_equity_history", "month_start_boundary", "genuine_interval_gap", "future_only",
)
GAP_CATEGORIES = (
    "pre_equity_history", "month_start_boundary", "genuine_interval_gap", "future_only", "no_equity_history",
)


def micro_percent(pct: Column) -> Column:
    """Percentages as millionths: integer sums are exact and cheap."""
    return F.rint(pct * 1e6).cast("bigint")


def percent_of(micro: Column) -> Column:
    return (micro.cast("decimal(20,0)") * F.lit(MICRO)).cast("decimal(38,6)")


def active_months(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Array of the month starts inside [start, end), clipped to [first, last]; null when none."""
    starts_on_first = F.dayofmonth(start) == 1
    begin = F.greatest(F.when(starts_on_first, start).otherwise(X.next_month(start)), first)
    stop = F.least(F.coalesce(X.month_floor(F.date_sub(end, 1)), last), last)
    return F.when(begin <= stop, F.sequence(begin, stop, F.expr("interval 1 month")))


def start_months(stakes: DataFrame) -> DataFrame:
    """(equity_field, start_month): the earliest start in the month and whether one lies after its first day.

    What names, first starts and starts within a month are all read from, in one pass over the intervals.
    """
    start = F.col("start_date")
    return stakes.groupBy(F.col("field_name").alias("equity_field"), X.month_floor(start).alias("start_month")).agg(
        F.min(start).alias("first_start"), F.max(F.dayofmonth(start) > 1).alias("within"))


def month_layout(stakes: DataFrame, first: Column, last: Column, starts: DataFrame | None = None) -> DataFrame:
    """(equity_field, month_start): one row per interval and month it is active in, and one, not active, where any starts within the month.

    The one layout that all questions of field-months are answered from. Kept as a table in buckets of its
    two keys (see ``store``), it meets months by joins and groupings that move only the other side.
    ``starts`` are the ``start_months`` of ``stakes``, where stored.
    """
    held = stakes.select(
        F.col("field_name").alias("equity_field"),
        F.explode(active_months(F.col("start_date"), F.col("end_date"), first, last)).alias("month_start"),
        F.lit(True).alias("active"), "company_name", "interest_pct", "start_date", "end_date", "operator_flag")
    begins = F.col("start_month")
    begun = (starts if starts is not None else start_months(stakes)).where(F.col("within") & (begins >= first) & (begins <= last))
    return held.unionByName(
        begun.select("equity_field", begins.alias("month_start"), F.lit(False).alias("active")), allowMissingColumns=True)


def active_in(layout: DataFrame) -> DataFrame:
    return layout.where("active").drop("active")


def month_facts(layout: DataFrame) -> DataFrame:
    """(equity_field, month): active rows, their positive sum, repeated companies, mid-month starts.

    Two steps of grouping: by company first, so that a repeated company shows up
    as a count above one and no set of companies is ever built.
    """
    pct = micro_percent(F.col("interest_pct"))
    by_company = layout.groupBy("equity_field", "month_start", "company_name").agg(
        F.count_if("active").alias("rows"),
        F.sum(F.when(F.col("active") & (pct > 0), pct).otherwise(0)).alias("positive"),
        F.count_if(~F.col("active")).alias("mid_starts"),
    )
    return by_company.groupBy("equity_field", "month_start").agg(
        F.sum("rows").alias("active_rows"),
        percent_of(F.sum("positive")).alias("positive_sum"),
        F.count_if(F.col("rows") > 1).alias("repeated_companies"),
        (F.sum("mid_starts") > 0).alias("mid_month_start"),
    )


def first_starts(starts: DataFrame) -> DataFrame:
    """Earliest and latest-starting evidence per equity field, from its ``start_months``."""
    return starts.groupBy("equity_field").agg(
        F.min("start_month").alias("first_start_month"),
        F.min("first_start").alias("first_start"),
    )


def matched_starts(matches: DataFrame, starts: DataFrame) -> DataFrame:
    """Matched fields with the first start of their intervals; unmatched fields would only share a null key."""
    found = matches.where(F.col("equity_field").isNotNull())
    return found.join(first_starts(starts), "equity_field", "left")


def window_of(prod: DataFrame) -> tuple[Column, Column]:
    """First and last reported month, as scalar subqueries over the period column alone."""
    return (
        prod.select(X.month_start(F.min("period"))).scalar(),
        prod.select(X.month_start(F.max("period"))).scalar(),
    )


def join_months(months: DataFrame, facts: DataFrame) -> DataFrame:
    """Left outer join on (equity_field, month_start).

    Unmatched fields join under a name of their own, so they don't meet under one null key.
    """
    own = F.coalesce("equity_field", F.concat(F.lit("\0"), "field"))
    found = facts.withColumnRenamed("equity_field", "join_field")
    return months.withColumn("join_field", own).join(found, ["join_field", "month_start"], "left").drop("join_field")


def resolve(history: DataFrame, matches: DataFrame, stakes: DataFrame, today_month: str,
            first: Column, last: Column, layout: DataFrame | None = None, starts: DataFrame | None = None) -> DataFrame:
    """(field, period) with its category, match method and active-interest figures.

    ``history`` may be the months alone; then there are no volumes.
    ``first`` and ``last`` bound the production months (see ``window_of``); ``layout`` and ``starts`` are those of ``stakes``, where stored.
    ``today_month`` (first of a month, ISO) separates fields whose ownership is
    still in the future from fields whose ownership simply began later.
    """
    starts = starts if starts is not None else start_months(stakes)
    by_field = matched_starts(matches, starts)
    keyed = history.join(by_field, "field", "left")
    joined = join_months(keyed, month_facts(layout if layout is not None else month_layout(stakes, first, last, starts)))
    active = F.coalesce("active_rows", F.lit(0))
    total = F.coalesce("positive_sum", F.lit(0).cast("decimal(38,6)"))
    rounded = F.round(total, 4)
    gap = (
        F.when(
            F.col("month_start") < F.col("first_start_month"),
            F.when(F.col("first_start_month") > F.lit(today_month).cast("date"), "future_only")
            .otherwise("pre_equity_history"),
        )
        .when(F.coalesce("mid_month_start", F.lit(False)), "month_start_boundary")
        .otherwise("genuine_interval_gap")
    )
    category = (
        F.when(F.col("method").isNull(), "unmatched")
        .when(F.col("first_start_month").isNull(), "no_equity_history")
        .when(active == 0, gap)
        .when((F.col("repeated_companies") > 0) | (total > 100.0 + X.SUM_TOLERANCE), "quarantined")
        .when(F.abs(rounded - 100) > X.SUM_TOLERANCE, "e1_sum_mismatch")
        .otherwise("resolved")
    )
    return joined.select(
        "field", "period", "month_start", "equity_field", "method",
        category.alias("category"),
        active.alias("active_rows"),
        F.when(active > 0, rounded).alias("positive_sum"),
        F.coalesce("repeated_companies", F.lit(0)).alias("repeated_companies"),
        *[s for s in EQUITY_STREAMS if s in history.columns],
    )


def resolve_latest(latest: DataFrame, matches: DataFrame, stakes: DataFrame, month: Column,
                   starts: DataFrame | None = None) -> DataFrame:
    """The single-month form: five categories, for fields that produce in the latest ``month``."""
    dated = latest.withColumn("month_start", X.month_start(F.col("period")))
    starts = starts if starts is not None else start_months(stakes)
    by_field = matched_starts(matches, starts)
    joined = join_months(dated.join(by_field, "field", "left"), month_facts(month_layout(stakes, month, month, starts)))
    active = F.coalesce("active_rows", F.lit(0))
    total = F.coalesce("positive_sum", F.lit(0).cast("decimal(38,6)"))
    category = (
        F.when(F.col("method").isNull(), "unmatched")
        .when((active == 0) & (F.col("first_start") > F.col("month_start")), "future_only")
        .when(active == 0, "unresolved_gap")
        .when((F.col("repeated_companies") > 0) | (total > 100.0 + X.SUM_TOLERANCE), "quarantined")
        .when(F.abs(F.round(total, 4) - 100) > X.SUM_TOLERANCE, "unresolved_gap")
        .otherwise("resolved")
    )
    return joined.select(
        "field", "period", "month_start", "equity_field", "method",
        category.alias("category"), active.alias("active_rows"),
        F.when(active > 0, F.round(total, 4)).alias("positive_sum"),
        *EQUITY_STREAMS,
    )


def active_rows(resolved: DataFrame, layout: DataFrame) -> DataFrame:
    """Field-months with every interval active in them, whatever their category (inner)."""
    laid = active_in(layout).withColumn("interest_pct", F.col("interest_pct").cast(PERCENT))
    return resolved.join(laid, ["equity_field", "month_start"])


def attribute(resolved: DataFrame, layout: DataFrame) -> DataFrame:
    """(field, period, company): volume x interest, for resolved months and positive interests."""
    wanted = resolved.where(F.col("category") == "resolved")
    rows = active_rows(wanted, layout.where(F.col("interest_pct") > 0))
    return rows.select(
        "field", "period", F.col("company_name").alias("company"), "interest_pct",
        *[F.round(F.col(s) * F.col("interest_pct") / 100, 6).cast(SHARE).alias(s) for s in EQUITY_STREAMS],
        "start_date", "end_date", "operator_flag", "method",
    )


def category_counts(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("category").agg(F.count("*").alias("field_months"))


def gap_summary(resolved: DataFrame) -> DataFrame:
    """Per gap category: field-months, fields, span and the volume left out."""
    by_field = resolved.where(F.col("category").isin(*GAP_CATEGORIES)).groupBy("category", "field").agg(
        F.count("*").alias("n"), F.min("period").alias("lo"), F.max("period").alias("hi"),
        *[F.sum(s).alias(s) for s in EQUITY_STREAMS],
    )
    return by_field.groupBy("category").agg(
        F.sum("n").alias("field_months"), F.count("*").alias("field_count"),
        F.min("lo").alias("first_period"), F.max("hi").alias("last_period"),
        *[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS],
    ).select("category", "field_months", "field_count", "first_period", "last_period",
             *[F.round(s, 4).alias(s) for s in EQUITY_STREAMS])


def gap_examples(resolved: DataFrame, names: int = 10) -> DataFrame:
    """The first field names of every gap category.

    The filter on the row number lets Spark keep only that many rows per
    category in each task before the shuffle.
    """
    fields = resolved.where(F.col("category").isin(*GAP_CATEGORIES)).select("category", "field").distinct()
    w = Window.partitionBy("category").orderBy("field")
    return fields.withColumn("position", F.row_number().over(w)).where(F.col("position") <= names)


def field_focus(resolved: DataFrame, stakes: DataFrame, field: str) -> DataFrame:
    """One named field: months, span and volume per category, and how many interval rows it has."""
    own = stakes.where(F.col("field_name") == field).agg(F.count("*")).scalar()
    return (
        resolved.where(F.col("field") == field)
        .groupBy("field", "category")
        .agg(F.count("*").alias("months"), F.min("period").alias("first_period"),
             F.max("period").alias("last_period"), *[F.round(F.sum(s), 4).alias(s) for s in EQUITY_STREAMS])
        .withColumn("own_interval_rows", own)
    )


def related_names(stakes: DataFrame, fragments: list[str]) -> DataFrame:
    """Interval field names that contain any of the fragments."""
    name = F.col("field_name")
    hit = F.lit(False)
    for fragment in fragments:
        hit = hit | name.contains(fragment)
    return stakes.where(hit).select("field_name").distinct()


def company_summary(attributed: DataFrame) -> DataFrame:
    """Per company: fields held and volumes, over whatever months ``attributed`` covers."""
    by_field = attributed.groupBy("company", "field").agg(
        F.min("period").alias("lo"), F.max("period").alias("hi"), *[F.sum(s).alias(s) for s in EQUITY_STREAMS]
    )
    return by_field.groupBy("company").agg(
        F.min("lo").alias("first_period"), F.max("hi").alias("last_period"),
        F.count("*").alias("field_count"),
        *[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS],
    )


def excluded_hits(resolved: DataFrame, layout: DataFrame) -> DataFrame:
    """Per company: active rows in quarantined or mismatched field-months."""
    held = resolved.where(F.col("category").isin("quarantined", "e1_sum_mismatch"))
    return (
        active_rows(held, layout)
        .groupBy(F.col("company_name").alias("company"))
        .agg(F.count("*").alias("excluded_rows"))
    )


def company_history_summary(attributed: DataFrame, hits: DataFrame) -> DataFrame:
    return company_summary(attributed).join(hits, "company", "left").withColumn(
        "excluded_rows", F.coalesce("excluded_rows", F.lit(0))
    )


def latest_value_rounding(rows: DataFrame, names: tuple[str, ...] = EQUITY_STREAMS) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c not in names],
                       *[F.round(F.col(n), 3).cast(PUBLISHED).alias(n) for n in names])


def join_active(months: DataFrame, layout: DataFrame) -> DataFrame:
    """Left outer: every field-month with its 0..n active intervals."""
    return join_months(months, active_in(layout).drop("operator_flag"))


def field_documents_summary(published: DataFrame, stakes: DataFrame) -> DataFrame:
    """Head of each matched field's ownership document."""
    heads = published.where(F.col("method").isNotNull()).groupBy("field", "equity_field", "method").agg(
        F.count("*").alias("months"), F.count_if(F.col("category") != "resolved").alias("excluded_months")
    )
    sizes = stakes.groupBy(F.col("field_name").alias("equity_field")).agg(F.count("*").alias("interval_rows"))
    return heads.join(sizes, "equity_field", "left")


def holders_of(companies: DataFrame, matches: DataFrame, stakes: DataFrame, field: str) -> DataFrame:
    """Companies that appear in the field's recorded intervals, resolved or not."""
    own = matches.where(F.col("field") == field).select("equity_field")
    listed = stakes.join(own, stakes["field_name"] == own["equity_field"], "left_semi").select(
        F.col("company_name").alias("company")
    )
    return companies.join(listed, "company", "left_semi")
