"""Whole reports: the parts of a batch run as one long table (section, key, measure, value).

Every part is a named query of its own; a report puts the parts of one run together. They start
from the same stored tables, so the interval join is done once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import EQUITY_STREAMS, TOTAL
from ..operators import diagnostics, intervals, licence
from ..session import scratch_path
from ..sources import adapters, sinks
from .domain import CANDIDATE_STARTS, Domain
from .reference_sql import slug
from .registry import ENTRIES, entry
from .shape import plain

VOLUMES = tuple(EQUITY_STREAMS)


@dataclass(frozen=True)
class Part:
    section: str
    query: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]


def long_rows(part: Part, frame: DataFrame) -> DataFrame:
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in part.keys])
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in part.measures])
    return frame.select(F.lit(part.section).alias("section"), key.alias("key"), F.explode(values).alias("m")).select("section", "key", "m.*")


def long_sql(part: Part) -> str:
    key = "concat_ws('|', " + ", ".join(f"coalesce(cast({k} as varchar), '')" for k in part.keys or ("''",)) + ")"
    values = ", ".join(f"{{'measure': '{m}', 'value': cast({m} as double)}}" for m in part.measures)
    return (f"select section, key, u.measure as measure, u.value as value from (select '{part.section}' section, {key} key, "
            f"unnest([{values}]) u from ({ENTRIES[part.query].sql}) x) y")


def report(name: str, parts: list[Part], first: tuple[str, ...] = ()) -> None:
    """``first``: stored tables that later parts need and earlier ones would do without, at the cost of a scan of their own."""
    def build(t: Domain) -> DataFrame:
        if first:
            t.side_by_side(*first)
        out = None
        for part in parts:
            rows = long_rows(part, ENTRIES[part.query].build(t))
            out = rows if out is None else out.unionByName(rows)
        return out
    entry(name, " union all ".join(long_sql(p) for p in parts))(build)


@entry("A13_window_exclusions", f"""
select s.start_period, c.category, c.stream, cast(round(sum(c.volume), 4) as double) volume
from cat_all c join (values {', '.join(f"('{p}')" for p in CANDIDATE_STARTS)}) s(start_period) on c.period >= s.start_period
where c.category <> 'resolved' group by 1, 2, 3""")
def _(t: Domain):
    starts = F.filter(F.array(*[F.lit(p) for p in CANDIDATE_STARTS]), lambda s: s <= F.col("period"))
    left_out = t.categories_all.where("category <> 'resolved'").select("category", "stream", "volume", F.explode(starts).alias("start_period"))
    return plain(left_out.groupBy("start_period", "category", "stream").agg(F.round(F.sum("volume").cast(TOTAL), 4).alias("volume")))


@entry("S5_orders_in_intervals", """
select count(*) orders, cast(sum(case when o_custkey is not null and o_orderdate is not null then 1 else 0 end) as bigint) in_intervals from orders""")
def _(t: Domain):
    spans = adapters.ownership_spans(t.raw("orders"))
    return spans.agg(F.count("ok").alias("in_intervals")).select(
        t.raw("orders").select(F.count(F.lit(1))).scalar().alias("orders"), "in_intervals")


# --- what a report names, as rows --------------------------------------------------------------


@entry("A1_unit_rows", "select distinct field, unit, unit_class, unit_type, period from latestc")
def _(t: Domain):
    return t.latest_classified.select("field", "unit", "unit_class", "unit_type", "period").distinct()


@entry("A26_gap_rows", f"""
select field, period, category, {', '.join(f"cast({s} as double) {s}" for s in EQUITY_STREAMS)} from fm
where category in ({', '.join(f"'{c}'" for c in intervals.GAP_CATEGORIES)})""")
def _(t: Domain):
    return plain(t.resolved.where(F.col("category").isin(*intervals.GAP_CATEGORIES)).select("field", "period", "category", *EQUITY_STREAMS))


@entry("A30_mismatch_rows", """
select field_name, company_name, strftime(start_date, '%Y-%m-%d') start_date, strftime(end_date, '%Y-%m-%d') end_date, period_label from equity
where (period_label = 'Current' and end_date is not null) or (period_label like 'Previous-%' and
 period_label <> concat('Previous-', cast(year(start_date) as varchar), ' to ', coalesce(cast(year(end_date) as varchar), '')))""")
def _(t: Domain):
    return plain(t.stakes.where(diagnostics.label_disagrees()).select("field_name", "company_name", "start_date", "end_date", "period_label"))


@entry("A36_mapping_names", "select status, basis, display_group, entity from mapping")
def _(t: Domain):
    return t.mapping.select("status", "basis", "display_group", "entity")


@entry("A37_subarea_rows", f"select grp, {slug('grp')} slug, licence_reference, block_reference, subarea_name, operated, licence_status from entry")
def _(t: Domain):
    named = t.subarea_entries.withColumn("grp", licence.holder_or_unmapped(F.col("display_group")))
    return named.select("grp", X.slugify(F.col("grp")).alias("slug"), "licence_reference", "block_reference",
                        "subarea_name", "operated", "licence_status")


@entry("A47_field_interval_rows", """
select m.field, e.company_name, e.interest_pct, strftime(e.start_date, '%Y-%m-%d') start_date, strftime(e.end_date, '%Y-%m-%d') end_date, e.operator_flag
from matched m join equity e on e.field_name = m.equity_field""")
def _(t: Domain):
    own = t.matches.where("equity_field is not null").select("field", F.col("equity_field").alias("field_name"))
    return plain(t.stakes.join(own, "field_name").select("field", "company_name", "interest_pct", "start_date", "end_date", "operator_flag"))


@entry("A47_field_period_rows", "select field, period, category, cast(positive_sum as double) positive_sum from pub")
def _(t: Domain):
    return plain(t.published.select("field", "period", "category", "positive_sum"))


@entry("K10_field_documents", f"""
select {slug('m.field')} slug, 'intervals' section, concat_ws('|', strftime(e.start_date, '%Y-%m-%d'), e.company_name) as position, count(*) as lines
from matched m join equity e on e.field_name = m.equity_field group by 1, 2, 3
union all select {slug('field')}, 'periods', period, count(*) from pub group by 1, 2, 3""")
def _(t: Domain):
    own = t.matches.where("equity_field is not null").select("field", F.col("equity_field").alias("field_name"))
    held = plain(t.stakes.join(own, "field_name").select("field", "start_date", "company_name", "interest_pct", "end_date"))
    months = plain(t.published.select("field", "period", "category", "positive_sum"))
    slugged = lambda rows: rows.withColumn("slug", X.slugify(F.col("field"))).drop("field")
    path = scratch_path(t.spark, "field-documents")
    sinks.write_documents(sinks.documents([sinks.section(slugged(held), "intervals", "slug", ["start_date", "company_name"]),
                                           sinks.section(slugged(months), "periods", "slug", ["period"])]), path)
    lines = sinks.read_documents(t.spark, path)
    return lines.groupBy("slug", "section", "position").agg(F.count("body").alias("lines"))


report("Q15_latest_checkpoint_report", [
    Part("categories", "Q15_latest_join_checkpoint", ("category",), ("field_count", "distinct_fields", "attributed_rows", *VOLUMES)),
    Part("coverage", "A57_latest_coverage_report", ("category",), ("fields", *VOLUMES)),
    Part("companies", "A24_company_summary_latest", ("company",), ("field_count", *VOLUMES)),
    Part("names", "A15_match_coverage_latest", ("stream",), ("total", "matched", "unmatched", "coverage_pct")),
    Part("interest sums", "V12_interest_sums", (), ("passing", "below_100", "above_100")),
    Part("dates", "V14_categories_and_dates", (), ("uncategorised", "rows_checked", "start_after_end", "zero_length")),
], first=("reported", "starts"))

report("Q16_history_diagnostic_report", [
    Part("categories", "Q16_history_join_diagnostic", ("category", "first_period", "last_period"), ("field_months", "distinct_fields", "attributed_rows", *VOLUMES)),
    Part("coverage", "A11_coverage_levels", ("level", "label", "stream"), ("total", "resolved", "coverage_pct")),
    Part("left out", "A11_excluded_totals", ("category", "stream"), ("volume",)),
    Part("names", "A16_match_coverage_history", ("stream",), ("total", "matched", "unmatched", "coverage_pct")),
    Part("unmatched fields", "A16_unmatched_fields_cumulative", ("field", "first_period", "last_period"), VOLUMES),
    Part("companies", "A25_company_summary_history", ("company", "first_period", "last_period"), ("field_count", "excluded_rows", *VOLUMES)),
    Part("gaps", "A26_gap_diagnostics", ("category", "first_period", "last_period"), ("field_months", "field_count", *VOLUMES)),
    Part("named field", "A27_named_field_analysis", ("field", "category", "first_period", "last_period"), ("months", "own_interval_rows", *VOLUMES)),
    Part("interest sums", "V12_interest_sums", (), ("passing", "below_100", "above_100")),
    Part("quarantine", "V13_quarantine_summary", ("first_period", "last_period"), ("field_months", "field_count", *VOLUMES)),
    Part("dates", "V14_categories_and_dates", (), ("uncategorised", "rows_checked", "start_after_end", "zero_length")),
    Part("conservation", "V16_attribution_conservation", ("period", "stream"), ("expected", "actual")),
])

report("Q17_window_evidence_report", [
    Part("streams", "Q17_coverage_window_evidence", ("stream", "stable_from"), (
        "longest_run_below", "at_100", "from_99_5_to_100", "from_95_to_99_5", "below_95", "lowest_pct")),
    Part("windows", "A13_window_candidates", ("start_period", "stream"), (
        "overall_pct", "lowest_pct", "median_pct", "at_100", "from_99_5_to_100", "from_95_to_99_5", "below_95", "longest_run_below", "month_count")),
    Part("left out", "A13_window_exclusions", ("start_period", "category", "stream"), ("volume",)),
    Part("stable from", "W3_stability_point", ("stream", "stable_from"), ("threshold",)),
    Part("causes", "A14_breach_causes", ("stream", "cause"), ("months",)),
    Part("lowest months", "T5_lowest_coverage_months", ("stream", "period"), ("coverage_pct", "position")),
])
