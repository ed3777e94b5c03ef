"""Queries over coverage, statuses, owner series and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, EQUITY_STREAMS
from ..operators import attribution as A, coverage as C, groups as G, production as P
from ..operators.rows import one_row
from .catalog_production import d
from .domain import CANDIDATE_STARTS, PUBLICATION_START, Domain
from .reference_sql import DERIVED, FOUR, pct, slug
from .registry import entry
from .shape import plain

ALL7 = [*FOUR, *DERIVED]

# --- coverage --------------------------------------------------------------------


@entry("P5_publication_window", "select field, period, category from pub")
def _(t: Domain):
    return t.published.select("field", "period", "category")


@entry("A9_month_coverage_base", """
select m.period, m.stream, cast(m.total as double) total, cast(m.resolved as double) resolved from mon_all m""")
def _(t: Domain):
    return plain(t.months_all.select("period", "stream", "total", "resolved"))


@entry("A9_excluded_by_category", "select period, stream, category, cast(volume as double) volume from cat_all where category <> 'resolved'")
def _(t: Domain):
    return plain(C.excluded(t.categories_all).select("period", "stream", "category", "volume"))


@entry("A10_coverage_percent", "select period, stream, coverage_pct from mon_all")
def _(t: Domain):
    return t.months_all.select("period", "stream", "coverage_pct")


LEVEL = """select '{level}' as level, {label} as label, stream, sum(total) total, sum(resolved) resolved from mon_all group by 2, 3"""


@entry("A11_coverage_levels", f"""
select level, label, stream, cast(total as double) total, cast(resolved as double) resolved, {pct('resolved', 'total')} coverage_pct from (
 {LEVEL.format(level='month', label='period')} union all {LEVEL.format(level='year', label='substr(period, 1, 4)')}
 union all {LEVEL.format(level='all', label="'all'")}) t""")
def _(t: Domain):
    return plain(C.coverage_levels(t.months_all))


@entry("A11_excluded_totals", """
select category, stream, cast(round(sum(volume), 4) as double) volume from cat_all where category <> 'resolved' group by 1, 2""")
def _(t: Domain):
    return plain(C.excluded_totals(t.categories_all))


BUCKETS = """count(case when coverage_pct >= 100 then 1 end) at_100, count(case when coverage_pct >= 99.5 and coverage_pct < 100 then 1 end) from_99_5_to_100,
 count(case when coverage_pct >= 95 and coverage_pct < 99.5 then 1 end) from_95_to_99_5, count(case when coverage_pct < 95 then 1 end) below_95"""


@entry("A12_coverage_buckets", f"select stream, {BUCKETS} from mon_all where coverage_pct is not null group by stream")
def _(t: Domain):
    return C.buckets(t.months_all)


STARTS = ", ".join(f"('{s}')" for s in CANDIDATE_STARTS)
SPREAD = f"(select m.*, s.start_period from mon_all m join (values {STARTS}) s(start_period) on m.period >= s.start_period)"
RUN = """(select {keys}, max(n) longest_run_below from (select {keys}, grp, count(case when coverage_pct < 95 then 1 end) n from (
 select *, sum(case when coverage_pct < 95 then 0 else 1 end) over (partition by {keys} order by period rows unbounded preceding) grp
 from {source} q where coverage_pct is not null) w group by {keys}, grp) v group by {keys})"""


@entry("A13_window_candidates", f"""
select o.start_period, o.stream, overall_pct, lowest_pct, median_pct, at_100, from_99_5_to_100, from_95_to_99_5, below_95, r.longest_run_below, month_count
from (select start_period, stream, {pct('sum(resolved)', 'sum(total)')} overall_pct, min(coverage_pct) lowest_pct,
 floor(median(cast(round(coverage_pct * 1000) as bigint)) + 0.5) / 1000 median_pct, {BUCKETS}, count(coverage_pct) month_count
 from {SPREAD} x group by start_period, stream having count(coverage_pct) > 0) o
join {RUN.format(keys='start_period, stream', source=SPREAD)} r on r.start_period = o.start_period and r.stream = o.stream""")
def _(t: Domain):
    return plain(C.window_statistics(t.months_all, CANDIDATE_STARTS))


@entry("W2_longest_run_below", f"select stream, longest_run_below from {RUN.format(keys='stream', source='mon_all')} z")
def _(t: Domain):
    return C.longest_run_below(t.months_all, ["stream"])


@entry("W3_stability_point", """
select stream, threshold, min(case when bad is null or period > bad then period end) stable_from from (
 select m.stream, h.threshold, m.period, max(case when m.coverage_pct < h.threshold then m.period end) over (partition by m.stream, h.threshold) bad
 from mon_all m cross join (values (50.0::double), (95.0::double), (99.0::double), (99.5::double)) h(threshold) where m.coverage_pct is not null) t group by 1, 2""")
def _(t: Domain):
    return C.stability_points(t.months_all, (50.0, *C.STABILITY_THRESHOLDS))


@entry("A14_breach_causes", """
select m.stream, coalesce(d.dominant_category, 'unexplained') cause, count(*) as months from mon_all m
left join dom_all d on d.period = m.period and d.stream = m.stream where m.coverage_pct < 95 group by 1, 2""")
def _(t: Domain):
    return C.breach_causes(t.months_all, 95.0)


@entry("T5_lowest_coverage_months", """
select period, stream, coverage_pct, position from (select period, stream, coverage_pct, row_number() over (partition by stream order by coverage_pct, period) as position
 from mon_all where coverage_pct is not null) t where position <= 10""")
def _(t: Domain):
    return plain(C.lowest_months(t.months_all).select("period", "stream", "coverage_pct", "position"))


@entry("A58_component_totals", """
select period, cast(li as double) liquids_included, cast(lt as double) liquids_total, cast(gi as double) gas_included, cast(gt as double) gas_total from dstat""")
def _(t: Domain):
    return plain(C.components(t.months))


@entry("X14_component_status", "select period, liquids_status, liquids_pct, gas_status, gas_pct from dstat")
def _(t: Domain):
    return t.derived_status.select("period", "liquids_status", "liquids_pct", "gas_status", "gas_pct")


@entry("X14b_stream_status", "select period, stream, status, coverage_pct, dominant_category from streamstat")
def _(t: Domain):
    return t.native_status


@entry("X15_total_gate", "select period, total_status, total_pct from dstat")
def _(t: Domain):
    return t.derived_status.select("period", "total_status", "total_pct")


# --- owner series -------------------------------------------------------------------

@entry("A19_company_month", f"select company, period, {', '.join(f'cast(round({s}, 3) as double) {s}' for s in FOUR)} from ownvol")
def _(t: Domain):
    return plain(t.owner_volumes.select("company", "period", *[F.round(s, 3).alias(s) for s in EQUITY_STREAMS]))


@entry("J11_period_status_attach", """
select o.company, o.period, n.stream, n.status from ownvol o join streamstat n on n.period = o.period""")
def _(t: Domain):
    return t.series.where(F.col("stream").isin(*EQUITY_STREAMS)).select("company", "period", "stream", "status")


@entry("X17_company_values", "select company, period, stream, cast(value as double) as value, status, coverage_pct from series")
def _(t: Domain):
    return plain(t.series)


@entry("P19_compact_projection", "select company, period, stream, cast(value as double) as value, status from series")
def _(t: Domain):
    return plain(A.compact(t.series))


@entry("P20_field_compact_projection", f"select field, {slug('field')} slug, period, {d(*DERIVED)} from hist")
def _(t: Domain):
    return plain(P.compact_fields(t.history))


@entry("A20_company_field_month", f"select company, field, period, {d(*DERIVED)}, liquids_status, gas_status, total_status from ofs")
def _(t: Domain):
    return plain(A.owner_field_series(t.facts, t.derived_status))


@entry("J16_zero_fill_grid", """
select company, field, count(*) as months, count(case when total_mboed = 0 then 1 end) zero_months, count(case when total_mboed is null then 1 end) null_months
from ofs group by company, field""")
def _(t: Domain):
    return A.owner_field_series(t.facts, t.derived_status).groupBy("company", "field").agg(
        F.count("*").alias("months"), F.count_if(F.col("total_mboed") == 0).alias("zero_months"),
        F.count_if(F.col("total_mboed").isNull()).alias("null_months"))


LAST7 = ", ".join(f"cast(max(case when s.stream = '{s}' then s.value end) as double) {s}_value, max(case when s.stream = '{s}' then s.status end) {s}_status" for s in ALL7)


@entry("A46_company_index", f"""
select s.company, {slug('s.company')} slug, max(f.lo) first_period, max(f.hi) last_period, max(f.n) field_count, {LAST7}
from series s join (select company, min(period) lo, max(period) hi, count(distinct field) n from att group by company) f
 on f.company = s.company and f.hi = s.period group by s.company""")
def _(t: Domain):
    return plain(A.owner_index(t.facts, t.owner_wide))


# --- groups ----------------------------------------------------------------------------

@entry("X10_holder_list_split", r"""
select object_id, cast(idx as bigint) as position, regexp_extract(part, '^(.*?) \(', 1) as name, cast(regexp_extract(part, '\((.*?)%\)', 1) as double) pct
from (select object_id, unnest(generate_series(0, 1)) idx, trim(unnest(string_split(holder_text, ','))) part from subarea where holder_text <> 'N/A') t""")
def _(t: Domain):
    return plain(t.subareas.select("object_id", F.posexplode(X.split_holders(F.col("holder_text"))).alias("position", "h")).select(
        "object_id", "position", "h.name", "h.pct"))


@entry("J22_row_holder", "select object_id, entity from (select object_id, " + r"case when holder_text = 'N/A' or equity_pct = 50 then null else regexp_extract(holder_text, '^(.*?) \(', 1) end entity from subarea) t")
def _(t: Domain):
    return t.subareas.select("object_id", X.row_holder(F.col("holder_text"), F.col("equity_pct")).alias("entity"))


@entry("A34_holder_evidence", "select entity, grp, n as rows from evid")
def _(t: Domain):
    return t.evidence


@entry("A35_mapping_build", "select entity, display_group, basis, status, evidence from mapping")
def _(t: Domain):
    return t.mapping


@entry("J10_entity_group_lookup", """
select e.entity, coalesce(v.only_group, e.entity) grp from ents e left join (
 select entity, min(grp) only_group from evid group by entity having count(*) = 1) v on v.entity = e.entity""")
def _(t: Domain):
    single = t.evidence.groupBy("entity").agg(F.count("*").alias("n"), F.min("grp").alias("display_group")).where("n = 1")
    return G.grouped_entities(t.entities, single)


@entry("A21_group_series", "select grp, period, stream, cast(value as double) as value, status, members from gser")
def _(t: Domain):
    return plain(t.group_series)


@entry("X16_group_status", "select status, stream, count(*) as points from gser group by status, stream")
def _(t: Domain):
    return t.group_series.groupBy("status", "stream").agg(F.count("*").alias("points"))


@entry("A22_group_overview", "select grp, period, stream, cast(value as double) as value, status, members from gover")
def _(t: Domain):
    return plain(t.group_overview)


@entry("A23_group_field_breakdown", f"select grp, field, period, {d(*DERIVED)}, liquids_status, gas_status, total_status from gfs")
def _(t: Domain):
    return plain(t.group_fields)


REPORT = f"""
select count(*) total_legal_entities, count(case when status = 'approved' then 1 end) approved_count,
 count(case when basis = 'reviewed manual mapping' then 1 end) reviewed_manual_count, count(case when status = 'unresolved' then 1 end) unresolved_count,
 count(case when status = 'excluded' then 1 end) excluded_count, count(case when evidence = 'conflict' then 1 end) ambiguous_count,
 count(distinct case when status = 'approved' then display_group end) distinct_approved_groups,
 count(distinct case when status = 'unresolved' then display_group end) unresolved_fallback_count,
 count(distinct display_group) distinct_display_groups,
 (select count(*) from (select grp from members group by grp having count(*) > 1) q) non_singleton_group_count,
 (select {pct('sum(case when a.grp is not null then coalesce(g.value, 0) else 0 end)', 'sum(g.value)')} from gser g left join (
  select distinct m.grp from members m join mapping p on p.entity = m.entity where p.status = 'approved') a on a.grp = g.grp
  where g.stream = 'total_mboed' and g.period = (select max(period) from gser)) latest_approved_pct,
 (select {pct('sum(case when a.grp is null then coalesce(g.value, 0) else 0 end)', 'sum(g.value)')} from gser g left join (
  select distinct m.grp from members m join mapping p on p.entity = m.entity where p.status = 'approved') a on a.grp = g.grp
  where g.stream = 'total_mboed' and g.period = (select max(period) from gser)) latest_unresolved_pct,
 (select {pct('sum(case when members > 1 then coalesce(value, 0) else 0 end)', 'sum(value)')} from gser where stream = 'total_mboed') history_relabelled_pct
from mapping"""


@entry("A36_grouping_review", REPORT)
def _(t: Domain):
    return plain(G.review_report(series=t.group_series, mapping=t.mapping, membership=t.membership))


@entry("A48_overview_metadata", f"""
select r.*, (select min(period) from country) first_period, (select max(period) from country) last_period, '{PUBLICATION_START}' equity_first_period from ({REPORT}) r""")
def _(t: Domain):
    span = t.country.agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    report = one_row(G.review_report(series=t.group_series, mapping=t.mapping, membership=t.membership), span)
    return plain(report.withColumn("equity_first_period", F.lit(PUBLICATION_START)))


@entry("A59_equity_build_metadata", f"""
select (select min(period) from pub) earliest_period, (select max(period) from pub) latest_period, (select count(*) from equity) interval_count,
 (select count(*) from matched where method is not null) matched_field_count, (select count(*) from matched where method is null) unmatched_field_count,
 (select count(*) from ents) legal_entity_count, '{PUBLICATION_START}' publication_start, 95.0::double minimum_coverage_pct, 99.5::double warning_coverage_pct, 6000::bigint scf_per_boe""")
def _(t: Domain):
    return plain(A.equity_metadata(t.published, t.stakes, t.matches, t.entities, PUBLICATION_START))


@entry("J23_group_vs_parts", f"""
select g.grp, g.period, cast(g.total_mboed as double) total_mboed, cast(sum(f.total_mboed) as double) parts_total from gowide g
left join gfs f on f.grp = g.grp and f.period = g.period group by 1, 2, 3""")
def _(t: Domain):
    from ..operators import checks
    fields = t.group_fields  # before the group months, which then read its facts
    compared = checks.parts_against_group(t.group_wide, fields, F.lit(0.0))
    return plain(compared.select("grp", "period", "total_mboed", "parts_total"))


@entry("J24_fields_vs_country", """
select h.period, cast(sum(h.total_mboed) as double) fields_total, cast(max(c.total_mboed) as double) country_total
from hist h left join country c on c.period = h.period group by h.period""")
def _(t: Domain):
    from ..operators import checks
    return plain(checks.fields_against_country(t.history, t.country).select("period", "fields_total", "country_total"))
