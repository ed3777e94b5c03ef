"""Queries over names, ownership intervals and attributed volumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.volumes import EQUITY_STREAMS
from ..operators import checks, diagnostics as D, intervals as I, matching as M
from ..sources import readers
from .catalog_production import d
from .domain import LATEST_MONTH, Domain
from .reference_sql import FOUR, norm, pct
from .registry import entry
from .shape import plain

FOUR_SQL = d(*FOUR)
ISO = "strftime({0}, '%Y-%m-%d')"
STAKE_SQL = f"field_name, company_name, interest_pct, {ISO.format('start_date')} start_date, {ISO.format('end_date')} end_date"


def four_sum(digits: int = 4, prefix: str = "") -> str:
    return ", ".join(f"cast(round(sum({prefix}{s}), {digits}) as double) {s}" for s in FOUR)


# --- sources of ownership ------------------------------------------------------

@entry("S5_interval_scan_narrow", f"""
select {STAKE_SQL}, year(start_date) < 1960 start_is_sentinel, interest_pct = 0 is_zero_interest from equity""")
def _(t: Domain):
    return plain(readers.stakes_narrow(t.stakes))


@entry("S6_interval_scan_wide", f"select {STAKE_SQL}, on_offshore, status, operator_flag, period_label from equity")
def _(t: Domain):
    return plain(readers.stakes_wide(t.stakes))


@entry("S18_right_hand_names", "select distinct field_name equity_field from equity")
def _(t: Domain):
    return t.right_names


# --- name matching ---------------------------------------------------------------

@entry("J2_exact_name_match", "select field, equity_field from matched where method = 'exact'")
def _(t: Domain):
    right = t.right_names
    return t.left_names.join(right, t.left_names["field"] == right["equity_field"])


@entry("J3_normalized_name_match", "select field, equity_field from matched where method = 'normalized'")
def _(t: Domain):
    return t.matches.where(F.col("method") == "normalized").select("field", "equity_field")


@entry("J4_alias_match", "select field, equity_field from matched where method = 'alias'")
def _(t: Domain):
    return t.matches.where(F.col("method") == "alias").select("field", "equity_field")


@entry("J5_match_cascade", "select field, equity_field, method from matched")
def _(t: Domain):
    return t.matches


@entry("U2_one_sided_names", """
select 'left' side, field as name from matched where method is null
union all select 'right', field_name from rnames where field_name not in (select equity_field from matched where equity_field is not null)""")
def _(t: Domain):
    left = M.unmatched_left(t.matches).select(F.lit("left").alias("side"), F.col("field").alias("name"))
    right = M.unmatched_right(t.matches, t.right_names)
    return left.unionByName(right.select(F.lit("right").alias("side"), F.col("equity_field").alias("name")))


@entry("U3_common_names", "select field from lnames intersect select field_name from rnames")
def _(t: Domain):
    return t.left_names.intersect(t.right_names.select(F.col("equity_field").alias("field")))


@entry("A15_match_coverage_latest", " union all ".join(f"""
select '{s}' stream, cast(round(sum(l.{s}), 3) as double) total, cast(round(sum(case when m.method is not null then l.{s} else 0 end), 3) as double) matched,
 cast(round(sum(case when m.method is null then l.{s} else 0 end), 3) as double) unmatched,
 round(100.0 * cast(sum(case when m.method is not null then l.{s} else 0 end) as double) / case when sum(l.{s}) > 0 then cast(sum(l.{s}) as double) end, 2) coverage_pct
from latest l join matched m on l.field = m.field""" for s in FOUR))
def _(t: Domain):
    return plain(M.matched_coverage(t.latest, t.matches))


@entry("A16_match_coverage_history", " union all ".join(f"""
select '{s}' stream, cast(round(sum(l.{s}), 3) as double) total, cast(round(sum(case when m.method is not null then l.{s} else 0 end), 3) as double) matched,
 cast(round(sum(case when m.method is null then l.{s} else 0 end), 3) as double) unmatched,
 round(100.0 * cast(sum(case when m.method is not null then l.{s} else 0 end) as double) / case when sum(l.{s}) > 0 then cast(sum(l.{s}) as double) end, 3) coverage_pct
from hist l join matched m on l.field = m.field""" for s in FOUR))
def _(t: Domain):
    return plain(M.matched_coverage(M.field_volumes(t.volumes), t.matches, 3))


@entry("A16_unmatched_fields_cumulative", f"""
select h.field, min(period) first_period, max(period) last_period, {four_sum()} from hist h join matched m on m.field = h.field
where m.method is null group by h.field""")
def _(t: Domain):
    return plain(M.unmatched_cumulative(history=t.volumes, matches=t.matches))


@entry("A42_unmatched_production_impact", f"""
select count(case when m.method is null then 1 end) unmatched_field_count,
 cast(round(sum(case when m.method is null then coalesce(l.total_mboed, 0) else 0 end), 3) as double) unmatched_total_mboed,
 {pct('sum(case when m.method is null then coalesce(l.total_mboed, 0) else 0 end)', 'sum(l.total_mboed)')} unmatched_production_pct
from polym m left join latest l on l.field = m.field""")
def _(t: Domain):
    return plain(M.unmatched_impact(t.latest, t.polygon_matches))


@entry("A55_unmatched_field_detail", f"""
select h.field, min(h.period) first_period, max(h.period) last_period, max(h.period) = (select max(period) from hist) produced_in_latest,
 {', '.join(f"cast(sum(case when h.period = (select max(period) from hist) then h.{s} end) as double) {s}" for s in FOUR)}
from hist h join matched m on m.field = h.field where m.method is null group by h.field""")
def _(t: Domain):
    return plain(M.unmatched_detail(history=t.history, matches=t.matches))


@entry("A56_normalization_collisions", f"""
select r.k name_key, r.field_name equity_field, g.n as names from (select field_name, {norm('field_name')} k from rnames) r
join (select {norm('field_name')} k, count(*) n from rnames group by 1 having count(*) > 1) g on g.k = r.k""")
def _(t: Domain):
    return M.name_collisions(t.right_names)


# --- the interval join -------------------------------------------------------------

@entry("J6_interval_join", f"""
select h.field, h.period, a.company_name, a.interest_pct, {ISO.format('a.start_date')} start_date, {ISO.format('a.end_date')} end_date
from hist h left join act a on a.field = h.field and a.period = h.period""")
def _(t: Domain):
    months = t.history.select("field", "period", "month_start").join(t.matches.select("field", "equity_field"), "field", "left")
    return plain(I.join_active(months, t.layout).select(
        "field", "period", "company_name", "interest_pct", "start_date", "end_date"))


@entry("P7_half_open_containment", """
select field_name, company_name, interest_pct, strftime(start_date, '%Y-%m-%d') start_date from equity
where start_date <= date '1998-07-01' and (end_date is null or date '1998-07-01' < end_date)""")
def _(t: Domain):
    day = F.lit("1998-07-01").cast("date")
    return plain(t.stakes.where(X.contains(F.col("start_date"), F.col("end_date"), day)).select(
        "field_name", "company_name", "interest_pct", "start_date"))


@entry("A17_active_interest_sum", """
select field, period, active_rows, cast(round(positive_sum, 4) as double) positive_sum, extra > 0 has_repeats from actsum""")
def _(t: Domain):
    rows = t.resolved.where(F.col("active_rows") > 0)
    return plain(rows.select("field", "period", "active_rows", "positive_sum", (F.col("repeated_companies") > 0).alias("has_repeats")))


@entry("X19_field_month_category", "select field, period, equity_field, method, category, active_rows, positive_sum from fm")
def _(t: Domain):
    return plain(t.resolved.select("field", "period", "equity_field", "method", "category", "active_rows", "positive_sum"))


@entry("X19_latest_category", "select field, period, method, category, active_rows, positive_sum from fml")
def _(t: Domain):
    return plain(t.resolved_latest.select("field", "period", "method", "category", "active_rows", "positive_sum"))


@entry("X20_gap_category", """
select field, period, category from fm where category in ('pre_equity_history', 'month_start_boundary', 'genuine_interval_gap', 'future_only')""")
def _(t: Domain):
    return t.resolved.where(F.col("category").isin(
        "pre_equity_history", "month_start_boundary", "genuine_interval_gap", "future_only"
    )).select("field", "period", "category")


@entry("A50_category_counts", "select category, count(*) field_months from fm group by category")
def _(t: Domain):
    return I.category_counts(t.resolved)


@entry("P8_resolved_positive_interest", """
select field, period, company, interest_pct, operator_flag, method from att_all""")
def _(t: Domain):
    return plain(t.attributed_all.select("field", "period", "company", "interest_pct", "operator_flag", "method"))


@entry("A18_attribution", f"""
select field, period, company, interest_pct, {', '.join(f'cast(round({s}, 3) as double) {s}' for s in FOUR)},
 {ISO.format('start_date')} start_date, {ISO.format('end_date')} end_date, method from att_all""")
def _(t: Domain):
    return plain(I.latest_value_rounding(t.attributed_all).drop("operator_flag"))


@entry("A18_attribution_latest", f"""
select field, period, company, interest_pct, {', '.join(f'cast(round({s}, 3) as double) {s}' for s in FOUR)}, operator_flag, method from attl""")
def _(t: Domain):
    return plain(I.latest_value_rounding(t.attributed_latest).drop("start_date", "end_date"))


@entry("A24_company_summary_latest", f"select company, count(distinct field) field_count, {four_sum(3)} from attl group by company")
def _(t: Domain):
    rows = I.company_summary(t.attributed_latest).drop("first_period", "last_period")
    return plain(I.latest_value_rounding(rows))


@entry("A25_company_summary_history", f"""
select a.company, min(a.period) first_period, max(a.period) last_period, count(distinct a.field) field_count, {four_sum(3, 'a.')},
 coalesce(max(x.n), 0) excluded_rows from att_all a left join (
 select c.company_name company, count(*) n from act c join fm f on f.field = c.field and f.period = c.period
 where f.category in ('quarantined', 'e1_sum_mismatch') group by 1) x on x.company = a.company group by a.company""")
def _(t: Domain):
    hits = I.excluded_hits(t.resolved, t.layout)
    return plain(I.latest_value_rounding(I.company_history_summary(t.shares, hits)))


@entry("A26_gap_diagnostics", f"""
select category, count(*) field_months, count(distinct field) field_count, min(period) first_period, max(period) last_period, {four_sum()}
from fm where category in ('pre_equity_history', 'month_start_boundary', 'genuine_interval_gap', 'future_only', 'no_equity_history') group by category""")
def _(t: Domain):
    return plain(I.gap_summary(t.resolved))


@entry("A26_gap_example_fields", """
select category, field, position from (select category, field, row_number() over (partition by category order by field) as position
 from (select distinct category, field from fm where category in
  ('pre_equity_history', 'month_start_boundary', 'genuine_interval_gap', 'future_only', 'no_equity_history')) a) b where position <= 10""")
def _(t: Domain):
    return plain(I.gap_examples(t.resolved))


FOCUS = "FIELD 0000000037"


@entry("A27_named_field_analysis", f"""
select field, category, count(*) as months, min(period) first_period, max(period) last_period, {four_sum()},
 (select count(*) from equity where field_name = '{FOCUS}') own_interval_rows from fm where field = '{FOCUS}' group by field, category""")
def _(t: Domain):
    return plain(I.field_focus(t.resolved, t.stakes, FOCUS))


@entry("A27_related_names", "select distinct field_name from equity where contains(field_name, 'OLD') or contains(field_name, 'RETIRED')")
def _(t: Domain):
    return I.related_names(t.stakes, ["OLD", "RETIRED"])


@entry("A57_latest_coverage_report", f"""
select category, count(*) as fields, {', '.join(f"cast(sum({s}) as double) {s}" for s in FOUR)} from fml group by category""")
def _(t: Domain):
    return plain(t.resolved_latest.groupBy("category").agg(
        F.count("*").alias("fields"), *[F.sum(s).alias(s) for s in EQUITY_STREAMS]))


# --- diagnostics of the interval table ------------------------------------------------

ZL_SQL = """
select z.field_name, z.company_name, z.interest_pct, z.start_date, z.on_offshore, z.status, z.operator_flag, b.pct before_pct, a.pct after_pct,
 case when b.pct is not null and a.pct is not null then case when z.interest_pct = b.pct and b.pct = a.pct then 'boundary_duplicate' else 'boundary_transition' end
  when a.pct is not null then case when z.interest_pct = a.pct then 'boundary_duplicate' else 'boundary_transition' end
  when b.pct is not null then 'termination_marker' else 'standalone_snapshot' end category
from equity z left join (select * from (select field_name, company_name, end_date, interest_pct pct, row_number() over (
  partition by field_name, company_name, end_date order by start_date, interest_pct) rn from equity where end_date is not null and start_date <> end_date) q where rn = 1) b
 on b.field_name = z.field_name and b.company_name = z.company_name and b.end_date = z.start_date
left join (select field_name, company_name, start_date, min(interest_pct) pct from equity where end_date is null or start_date <> end_date group by 1, 2, 3) a
 on a.field_name = z.field_name and a.company_name = z.company_name and a.start_date = z.start_date
where z.start_date = z.end_date"""


@entry("J12_adjacent_intervals", f"""
select field_name, company_name, interest_pct, {ISO.format('start_date')} start_date, before_pct, after_pct from ({ZL_SQL}) t""")
def _(t: Domain):
    return plain(D.zero_length_neighbours(t.stakes).select(
        "field_name", "company_name", "interest_pct", "start_date", "before_pct", "after_pct"))


@entry("W8_zero_length_neighbours", f"""
select field_name, company_name, {ISO.format('start_date')} start_date, before_pct is not null has_before, after_pct is not null has_after from ({ZL_SQL}) t""")
def _(t: Domain):
    return plain(D.zero_length_neighbours(t.stakes).select(
        "field_name", "company_name", "start_date", F.col("before_pct").isNotNull().alias("has_before"),
        F.col("after_pct").isNotNull().alias("has_after")))


@entry("X18_zero_length_category", f"select field_name, company_name, {ISO.format('start_date')} start_date, category from ({ZL_SQL}) t")
def _(t: Domain):
    return plain(D.zero_length_neighbours(t.stakes).select("field_name", "company_name", "start_date", "category"))


@entry("A29_zero_length_profile", " union all ".join(f"select '{n}' facet, {e} as value, count(*) as rows from ({ZL_SQL}) t group by 2" for n, e in {
    "category": "category", "year": "strftime(start_date, '%Y')", "date": "strftime(start_date, '%Y-%m-%d')",
    "interest": "case when interest_pct = 0 then 'zero' when interest_pct = 100 then 'hundred' else 'partial' end",
    "operator_flag": "operator_flag", "status": "status", "on_offshore": "on_offshore"}.items()))
def _(t: Domain):
    return D.zero_length_profile(t.stakes)


OPZ = "select * from equity where interest_pct = 0 and operator_flag = 'Y'"
COVERED = """exists (select 1 from equity p where p.field_name = z.field_name and p.company_name <> z.company_name and p.interest_pct > 0
 and p.start_date < coalesce(z.end_date, date '9999-12-31') and z.start_date < coalesce(p.end_date, date '9999-12-31'))"""


@entry("J13_overlap_semi_join", f"""
select z.field_name, z.company_name, {ISO.format('z.start_date')} start_date, {ISO.format('z.end_date')} end_date from ({OPZ}) z where {COVERED}""")
def _(t: Domain):
    rows = D.covered_by_others(t.stakes).where("covered_by_other")
    return plain(rows.select("field_name", "company_name", "start_date", "end_date"))


@entry("J14_positive_elsewhere", f"""
select z.field_name, z.company_name, {ISO.format('z.start_date')} start_date from ({OPZ}) z where exists (select 1 from equity p
 where p.field_name = z.field_name and p.company_name = z.company_name and p.interest_pct > 0)""")
def _(t: Domain):
    return plain(D.positive_elsewhere(t.stakes).select("field_name", "company_name", "start_date"))


@entry("A31_zero_interest_profile", f"""
select *, operator_rows - covered_by_other not_covered from (select count(case when interest_pct = 0 then 1 end) zero_rows,
 count(case when interest_pct = 0 and operator_flag = 'Y' then 1 end) operator_rows,
 count(case when interest_pct = 0 and end_date is null then 1 end) zero_open, count(case when interest_pct = 0 and end_date is not null then 1 end) zero_closed,
 count(case when interest_pct = 0 and operator_flag = 'Y' and end_date is null then 1 end) operator_open,
 count(case when interest_pct = 0 and operator_flag = 'Y' and end_date is not null then 1 end) operator_closed,
 (select count(*) from ({OPZ}) z where {COVERED}) covered_by_other,
 (select count(*) from ({OPZ}) z where exists (select 1 from equity p where p.field_name = z.field_name and p.company_name = z.company_name and p.interest_pct > 0)) positive_elsewhere
 from equity) t""")
def _(t: Domain):
    return D.zero_interest_profile(t.stakes)


@entry("P24_zero_interest_operators", f"select {STAKE_SQL} from ({OPZ}) z")
def _(t: Domain):
    return plain(D.operator_zero_rows(t.stakes).select("field_name", "company_name", "interest_pct", "start_date", "end_date"))


@entry("J15_open_peers", f"""
select field_name, count(*) field_rows, count(case when end_date is null and start_date <= date '{LATEST_MONTH}' then 1 end) open_started from equity group by field_name""")
def _(t: Domain):
    return D.open_peers(t.stakes, LATEST_MONTH)


@entry("P21_future_dated_rows", f"select {STAKE_SQL} from equity where start_date >= date '2002-01-01'")
def _(t: Domain):
    return plain(D.future_dated(t.stakes, LATEST_MONTH).select("field_name", "company_name", "interest_pct", "start_date", "end_date"))


@entry("A32_future_dated_profile", f"""
select e.field_name, e.company_name, e.interest_pct, {ISO.format('e.start_date')} start_date, p.n - 1 peer_rows, p.o open_peers, p.o > 0 overlaps_open
from equity e join (select field_name, count(*) n, count(case when end_date is null and start_date <= date '{LATEST_MONTH}' then 1 end) o from equity group by 1) p
 on p.field_name = e.field_name where e.start_date >= date '2002-01-01'""")
def _(t: Domain):
    return plain(D.future_profile(t.stakes, LATEST_MONTH).select(
        "field_name", "company_name", "interest_pct", "start_date", "peer_rows", "open_peers", "overlaps_open"))


@entry("A33_open_ended_profile", f"""
select cast(sum(o) as bigint) open_rows, count(case when o > 0 then 1 end) fields_with_open, count(case when op > 1 then 1 end) fields_with_several_open_positive,
 count(case when o > oc then 1 end) fields_with_repeated_company, count(case when n > 0 and abs(s - 100) <= 0.5 then 1 end) current_sum_ok,
 count(case when n > 0 and abs(s - 100) > 0.5 then 1 end) current_sum_off, count(case when n = 0 then 1 end) no_current_row
from (select field_name, count(case when end_date is null then 1 end) o, count(distinct case when end_date is null then company_name end) oc,
 count(case when end_date is null and interest_pct > 0 then 1 end) op,
 count(case when end_date is null and start_date <= date '{LATEST_MONTH}' then 1 end) n,
 sum(case when end_date is null and start_date <= date '{LATEST_MONTH}' then cast(interest_pct as decimal(9,6)) end) s from equity group by field_name) t""")
def _(t: Domain):
    return D.open_ended_profile(t.stakes, LATEST_MONTH)


@entry("A30_period_label_audit", """
select count(*) total_rows, count(case when period_label = 'Current' then 1 end) current_form,
 count(case when period_label like 'Previous-%' then 1 end) previous_form, count(case when period_label = 'Unknown' then 1 end) other_form,
 count(case when (period_label = 'Current' and end_date is not null) or (period_label like 'Previous-%' and
  period_label <> concat('Previous-', cast(year(start_date) as varchar), ' to ', coalesce(cast(year(end_date) as varchar), ''))) then 1 end) mismatches from equity""")
def _(t: Domain):
    return D.label_audit(t.stakes)


@entry("X11_period_label_parse", """
select distinct period_label, case when period_label = 'Current' then 'current' when period_label like 'Previous-%' then 'previous' else 'other' end kind,
 case when period_label like 'Previous-%' then cast(substr(period_label, 10, 4) as double) end first_year,
 case when period_label like 'Previous-%' then cast(substr(period_label, 18, 4) as double) end last_year from equity""")
def _(t: Domain):
    label = F.col("period_label")
    first, last = X.label_years(label)
    return t.stakes.select(label, X.label_kind(label).alias("kind"), first.cast("double").alias("first_year"),
                           last.cast("double").alias("last_year")).distinct()


@entry("X21_interval_flags", """
select year(start_date) < 1960 start_is_sentinel, interest_pct = 0 is_zero_interest, count(*) n from equity group by 1, 2""")
def _(t: Domain):
    return readers.stakes_narrow(t.stakes).groupBy("start_is_sentinel", "is_zero_interest").agg(F.count("*").alias("n"))


LABELLED = "period_label like 'Previous-%' and period_label <> concat('Previous-', cast(year(start_date) as varchar), ' to ', coalesce(cast(year(end_date) as varchar), ''))"


@entry("J25_label_implied_override", f"""
select field_name, company_name, {ISO.format('start_date')} start_date,
 case when {LABELLED} then substr(period_label, 10, 4) || '-01-01' else {ISO.format('start_date')} end used_start,
 case when {LABELLED} then substr(period_label, 18, 4) || '-12-31' else {ISO.format('end_date')} end used_end from equity""")
def _(t: Domain):
    rows = t.stakes.select("*", F.explode(D.policy_bounds()).alias("p")).where("p.policy = 'C'")
    return plain(rows.select("field_name", "company_name", "start_date", F.col("p.s").alias("used_start"), F.col("p.e").alias("used_end")))


POLICY_ROWS = f"""
select 'A' policy, *, start_date s, end_date e from equity union all
select 'B', *, start_date, end_date from equity where end_date is null or start_date <> end_date union all
select 'C', *, case when {LABELLED} then make_date(cast(substr(period_label, 10, 4) as integer), 1, 1) else start_date end,
 case when {LABELLED} then make_date(cast(substr(period_label, 18, 4) as integer), 12, 31) else end_date end from equity"""
GRID_SQL = f"""
select g.policy, g.field_name, g.m month_start, count(r.company_name) active_rows, sum(cast(r.interest_pct as decimal(9,6))) sum_pct,
 count(r.company_name) > count(distinct r.company_name) repeats, count(case when r.start_date = r.end_date then 1 end) > 0 zero_length_active
from (select p.policy, f.field_name, cast(unnest(generate_series(f.first_month, date '{LATEST_MONTH}', interval 1 month)) as date) m
 from starts f cross join (values ('A'), ('B'), ('C')) p(policy) where f.first_month <= date '{LATEST_MONTH}') g
left join ({POLICY_ROWS}) r on r.policy = g.policy and r.field_name = g.field_name and r.s <= g.m and (r.e is null or g.m < r.e)
group by 1, 2, 3"""


@entry("J17_month_grid_evaluation", f"""
select policy, field_name, {ISO.format('month_start')} month_start, active_rows, cast(sum_pct as double) sum_pct from ({GRID_SQL}) t""")
def _(t: Domain):
    return plain(D.policy_grid(D.policy_steps(t.stakes, LATEST_MONTH, t.stake_parts)).select(
        "policy", "field_name", "month_start", "active_rows", "sum_pct"))


@entry("A28_policy_comparison", f"""
select policy, count(*) field_months, count(case when active_rows = 0 then 1 end) none_active,
 count(case when active_rows > 0 and abs(sum_pct - 100) <= 0.5 then 1 end) sum_ok, count(case when active_rows > 0 and sum_pct > 100.5 then 1 end) sum_over,
 count(case when active_rows > 0 and sum_pct < 99.5 then 1 end) sum_under, count(case when active_rows > 0 and repeats then 1 end) repeated_company_months,
 count(case when active_rows > 0 and zero_length_active then 1 end) zero_length_active_months from ({GRID_SQL}) t group by policy""")
def _(t: Domain):
    return D.policy_comparison(D.policy_steps(t.stakes, LATEST_MONTH, t.stake_parts))


@entry("A28_future_only_fields", f"select field_name, strftime(first_month, '%Y-%m-%d') first_month from starts where first_month > date '{LATEST_MONTH}'")
def _(t: Domain):
    return plain(D.future_only_fields(t.stakes, LATEST_MONTH))


@entry("T4_worst_sums", f"""
select field_name, {ISO.format('month_start')} month_start, cast(round(sum_pct, 2) as double) sum_pct, active_rows from ({GRID_SQL}) t
where policy = 'A' and abs(sum_pct - 100) > 0.5 order by abs(round(sum_pct, 2) - 100) desc, field_name, t.month_start limit 15""")
def _(t: Domain):
    return plain(D.worst_sums(D.policy_steps(t.stakes, LATEST_MONTH, t.stake_parts)))


@entry("T6_most_common_values", f"select field_name, count(*) as rows from ({OPZ}) z group by 1 order by count(*) desc, field_name limit 10")
def _(t: Domain):
    return D.most_common(D.operator_zero_rows(t.stakes), "field_name", 10)


RECENCY = f"""
select field_name, company_name, interest_pct, {ISO.format('start_date')} start_date, {ISO.format('end_date')} end_date, kind,
 rank() over (partition by field_name, kind order by case when kind = 'interval' and end_date is null then 0 else 1 end,
  case when kind = 'event' or end_date is null then start_date else end_date end desc) as position
from (select *, case when start_date = end_date then 'event' else 'interval' end kind from equity) t"""


@entry("T9_ownership_recency", RECENCY)
def _(t: Domain):
    return D.recency_order(t.stakes).transform(plain).select(
        "field_name", "company_name", "interest_pct", "start_date", "end_date", "kind", "position")


@entry("P16_interval_event_split", """
select case when start_date = end_date then 'event' else 'interval' end kind, field_name, count(*) n from equity group by 1, 2""")
def _(t: Domain):
    events = D.zero_length(t.stakes).withColumn("kind", F.lit("event"))
    lasting = D.lasting(t.stakes).withColumn("kind", F.lit("interval"))
    return events.unionByName(lasting).groupBy("kind", "field_name").agg(F.count("*").alias("n"))


@entry("A52_interval_schema_report", """
select count(*) row_count, strftime(min(start_date), '%Y-%m-%d') start_min, strftime(max(start_date), '%Y-%m-%d') start_max,
 strftime(min(end_date), '%Y-%m-%d') end_min, strftime(max(end_date), '%Y-%m-%d') end_max,
 count(case when end_date is null then 1 end) open_rows, count(case when year(start_date) < 1960 then 1 end) sentinel_rows,
 count(case when interest_pct = 0 then 1 end) zero_rows, count(distinct field_name) field_count, count(distinct company_name) company_count from equity""")
def _(t: Domain):
    return D.interval_schema_report(t.stakes)


@entry("A47_field_equity_document", f"""
select f.field, f.equity_field, f.method, count(*) as months, count(case when f.category <> 'resolved' then 1 end) excluded_months,
 max(x.n) interval_rows from pub f left join (select field_name, count(*) n from equity group by 1) x on x.field_name = f.equity_field
where f.method is not null group by 1, 2, 3""")
def _(t: Domain):
    return I.field_documents_summary(t.published, t.stakes)


@entry("J21_named_field_holders", f"""
select distinct company from att where company in (select company_name from equity e join matched m on m.equity_field = e.field_name
 where m.field = '{FOCUS}')""")
def _(t: Domain):
    return I.holders_of(t.attributed.select("company").distinct(), t.matches, t.stakes, FOCUS)
