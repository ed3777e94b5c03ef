"""The interactive queries: charts, panels, maps, search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, EQUITY_STREAMS, NATIVE_STREAMS
from ..operators import (
    attribution as A, checks, coverage as C, diagnostics as D, groups as G, intervals as I, licence as L,
    matching as M, production as P, ranking as R,
)
from ..operators.rows import one_row
from .catalog_coverage import BUCKETS, RUN
from .catalog_licence import ACTIVE, AS_OF, EP_COUNTS, PICK, PORTFOLIO, extent_sql
from .catalog_ownership import FOUR_SQL, four_sum
from .catalog_production import COMMODITY_SQL, EIGHT_SQL, KPI_SQL, LAST_SQL, d, exact_mean
from .domain import CANDIDATE_STARTS, Domain
from .reference_sql import DERIVED, FIVE, FOUR, pct, slug
from .registry import entry
from .shape import plain

TOTAL = "total_mboed"
YEAR = "substr(period, 1, 4)"


def mean_dec(value: str) -> str:
    milli = f"cast(sum(cast({value} * 1000 as hugeint)) as hugeint)"
    n = f"case when count({value}) > 0 then count({value}) end"
    return f"cast(cast(({milli} * 2 + {n}) // (2 * {n}) as decimal(18,0)) * cast(0.001 as decimal(4,3)) as decimal(18,3))"


# --- top-N rules ------------------------------------------------------------------

def direct_sql(source: str, key: str, n: int, other: str) -> str:
    last = f"""select {key}, {TOTAL}, row_number() over (order by {TOTAL} desc, {key}) pos from (select {key}, {TOTAL},
 row_number() over (partition by {key} order by period desc) rn from {source} where {TOTAL} is not null) q where rn = 1"""
    return f"""select case when l.pos <= {n} then s.{key} else '{other}' end label, s.period, sum(s.{TOTAL}) {TOTAL}
from {source} s join ({last}) l on l.{key} = s.{key} group by 1, 2"""


@entry("T1_top_n_direct_other", f"select label, period, cast({TOTAL} as double) {TOTAL} from ({direct_sql('gowide', 'grp', 10, R.OTHER_COMPANIES)}) x")
def _(t: Domain):
    return plain(R.top_n_direct(t.group_wide, "grp", TOTAL))


TOP_FIELDS = f"(select field from ({LAST_SQL}) l order by {TOTAL} desc, field limit {{n}})"


def subtractive_sql(n: int) -> str:
    shown = f"select field label, {YEAR} bucket, {mean_dec(TOTAL)} v from hist where field in {TOP_FIELDS.format(n=n)} group by 1, 2"
    return f"""select label, bucket, cast(v as double) {TOTAL} from ({shown}) a union all
select '{R.OTHER_FIELDS}', c.bucket, cast(greatest(c.v - coalesce(s.v, 0), 0) as double) from
 (select {YEAR} bucket, {mean_dec(TOTAL)} v from country group by 1) c left join (select bucket, sum(v) v from ({shown}) b group by 1) s on s.bucket = c.bucket"""


def chosen_fields(t: Domain, n: int, status: str | None = None) -> DataFrame:
    latest = P.last_known(t.history, "field", TOTAL)
    if status is not None:
        rated = R.field_status(latest, t.country.select(F.max("period")).scalar())
        latest = rated.where(F.col("producing") == (status == "current"))
    return R.leaders(latest, "field", TOTAL, n).select("field")


@entry("T2_top_n_subtractive_other", subtractive_sql(5))
def _(t: Domain):
    return plain(R.top_n_of_total(t.history, t.country, "field", TOTAL, chosen_fields(t, 5)))


def within_sql(n: int) -> str:
    mine = f"(select field, period, {TOTAL} from gfs where grp = '{G.UNRESOLVED}')"
    ranked = f"""(select field, row_number() over (order by {TOTAL} desc, field) pos from (select field, {TOTAL}, row_number() over (partition by field order by period desc) rn
 from {mine} m where {TOTAL} is not null) q where rn = 1)"""
    shown = f"select m.field label, m.period, m.{TOTAL} v from {mine} m join {ranked} r on r.field = m.field where r.pos <= {n}"
    return f"""select label, period, v from ({shown}) a union all
select '{R.OTHER_FIELDS}', g.period, case when g.{TOTAL} is not null then greatest(g.{TOTAL} - coalesce(s.v, 0), 0) end
from gowide g left join (select period, sum(v) v from ({shown}) b group by 1) s on s.period = g.period
where g.grp = '{G.UNRESOLVED}' and (select count(*) from {ranked} r) > {n}"""


def within(t: Domain, n: int) -> DataFrame:
    fields = t.group_fields.where(F.col("grp") == G.UNRESOLVED)
    totals = t.group_wide.where(F.col("grp") == G.UNRESOLVED)
    return R.top_n_within(fields, totals, "field", TOTAL, n)


@entry("T3_top_n_within_group", f"select label, period, cast(v as double) {TOTAL} from ({within_sql(3)}) x")
def _(t: Domain):
    return plain(within(t, 3))


@entry("T11_names_in_other", f"select field from ({LAST_SQL}) l where field not in {TOP_FIELDS.format(n=5)}")
def _(t: Domain):
    return R.left_out_names(P.last_known(t.history, "field", TOTAL), "field", TOTAL, 5)


@entry("U1_period_union", f"select distinct period from hist where field in {TOP_FIELDS.format(n=5)} union select period from country")
def _(t: Domain):
    shown = t.history.join(F.broadcast(chosen_fields(t, 5)), "field", "left_semi").select("period")
    return shown.union(t.country.select("period")).distinct()


WIDE = ", ".join(f"max(case when stream = '{s}' then v end) {s}" for s in DERIVED)


@entry("P15_wide_chart_frame", f"select period, {d(*DERIVED)} from country")
def _(t: Domain):
    long = t.country.unpivot(["period"], list(DERIVED_STREAMS), "series", "value")
    return plain(R.wide(long, "period", "series", "value", list(DERIVED_STREAMS)))


# --- charts --------------------------------------------------------------------------

@entry("Q1_country_by_commodity", f"select {YEAR} as year, {', '.join(f'{exact_mean(s)} {s}' for s in DERIVED)} from country group by 1")
def _(t: Domain):
    return plain(P.annual_average(P.in_range(t.country), [], list(DERIVED_STREAMS)))


@entry("Q1_country_by_commodity_monthly", f"select period, {d(*DERIVED)} from country where period between '199603' and '200006'")
def _(t: Domain):
    return plain(P.in_range(t.country, "199603", "200006"))


def by_owner_sql(source: str, key: str) -> str:
    return f"""select label, {YEAR} as year, cast({mean_dec(TOTAL)} as double) {TOTAL} from ({direct_sql(source, key, 10, R.OTHER_COMPANIES)}) x group by 1, 2"""


@entry("Q2_by_company_group", by_owner_sql("gowide", "grp"))
def _(t: Domain):
    series = R.top_n_direct(t.group_wide, "grp", TOTAL)
    return plain(P.annual_average(series, ["label"], [TOTAL]))


@entry("Q2_by_legal_entity", by_owner_sql("swide", "company"))
def _(t: Domain):
    series = R.top_n_direct(t.owner_wide.select("company", "period", F.col(TOTAL)["value"].alias(TOTAL)), "company", TOTAL)
    return plain(P.annual_average(series, ["label"], [TOTAL]))


@entry("Q3_one_group_by_field", f"select label, {YEAR} as year, cast({mean_dec('v')} as double) {TOTAL} from ({within_sql(10)}) x group by 1, 2")
def _(t: Domain):
    return plain(P.annual_average(within(t, 10), ["label"], [TOTAL]))


@entry("Q3_one_group_by_commodity", f"""select {YEAR} as year, cast({mean_dec('liquids_mboed')} as double) liquids_mboed,
 cast({mean_dec('natural_gas_mboed')} as double) natural_gas_mboed from gowide where grp = '{G.UNRESOLVED}' group by 1""")
def _(t: Domain):
    mine = t.group_wide.where(F.col("grp") == G.UNRESOLVED)
    return plain(P.annual_average(mine, [], ["liquids_mboed", "natural_gas_mboed"]))


@entry("Q4_by_field_top_n", subtractive_sql(10))
def _(t: Domain):
    return plain(R.top_n_of_total(t.history, t.country, "field", TOTAL, chosen_fields(t, 10)))


HISTORICAL = f"""(select field from ({LAST_SQL}) l where not (last_period = (select max(period) from country) and {TOTAL} > 0) order by {TOTAL} desc, field limit 5)"""


@entry("Q4_by_field_historical_monthly", f"""
select field label, period bucket, cast({TOTAL} as double) {TOTAL} from hist where field in {HISTORICAL} union all
select '{R.OTHER_FIELDS}', c.period, cast(greatest(c.{TOTAL} - coalesce(s.v, 0), 0) as double) from country c
left join (select period, sum({TOTAL}) v from hist where field in {HISTORICAL} group by 1) s on s.period = c.period""")
def _(t: Domain):
    return plain(R.top_n_of_total(t.history, t.country, "field", TOTAL, chosen_fields(t, 5, "historical"), annual=False))


@entry("Q5_headline_row", KPI_SQL)
def _(t: Domain):
    return plain(P.headline(t.country))


# --- panels -----------------------------------------------------------------------------

FIELD = "FIELD 0000000001"


@entry("Q6_field_panel", f"""
select 'unit' kind, s.unit as name, s.unit_class detail, s.first_period from_label, s.last_period to_label, cast(null as double) oil, cast(null as double) gas
from spans s where s.field = '{FIELD}' union all
select 'year', {YEAR}, null, min(period), max(period), {exact_mean('(oil_mbd + condensate_mbd)')},
 cast(((cast(sum(cast((assoc_gas_mmscfd + dry_gas_mmscfd) * 1000 as hugeint)) as hugeint) * 2 + 6 * count(*)) // (12 * count(*))) as double) / 1000
from hist where field = '{FIELD}' group by {YEAR}""")
def _(t: Domain):
    units = t.spans.where(F.col("field") == FIELD).select(
        F.lit("unit").alias("kind"), F.col("unit").alias("name"), F.col("unit_class").alias("detail"),
        F.col("first_period").alias("from_label"), F.col("last_period").alias("to_label"))
    own = t.history.where(F.col("field") == FIELD)
    spans = own.groupBy(F.substring("period", 1, 4).alias("year")).agg(
        F.min("period").alias("from_label"), F.max("period").alias("to_label"))
    years = P.annual_oil_gas(own).join(spans, "year").select(
        F.lit("year").alias("kind"), F.col("year").alias("name"), "from_label", "to_label",
        F.col("oil_mboed").cast("double").alias("oil"), F.col("gas_mboed").cast("double").alias("gas"))
    return units.unionByName(years, allowMissingColumns=True)


@entry("Q7_ownership_panel", f"""
select r.kind, r.company_name, r.interest_pct, r.start_date, r.end_date, cast(r.position as double) as position from (
 select field_name, company_name, interest_pct, strftime(start_date, '%Y-%m-%d') start_date, strftime(end_date, '%Y-%m-%d') end_date,
  case when start_date = end_date then 'event' else 'interval' end kind,
  rank() over (partition by field_name, coalesce(start_date = end_date, false) order by case when end_date is null then 0 else 1 end,
   case when start_date = end_date or end_date is null then start_date else end_date end desc) as position
 from (select field_name, company_name, interest_pct, start_date, end_date from equity) q) r
join matched m on m.equity_field = r.field_name where m.field = '{FIELD}'
union all select 'excluded', category, null, period, null, null from pub where field = '{FIELD}' and category <> 'resolved'""")
def _(t: Domain):
    own = t.matches.where(F.col("field") == FIELD).select(F.col("equity_field").alias("field_name"))
    rows = plain(D.recency_order(t.stakes.join(own, "field_name", "left_semi"))).select(
        "kind", "company_name", "interest_pct", "start_date", "end_date", F.col("position").cast("double").alias("position"))
    missing = t.published.where((F.col("field") == FIELD) & (F.col("category") != "resolved")).select(
        F.lit("excluded").alias("kind"), F.col("category").alias("company_name"), F.col("period").alias("start_date"))
    return rows.unionByName(missing, allowMissingColumns=True)


COMPANY = "Customer#000000001"


@entry("Q8_company_panel", f"""
select period, stream, cast(value as double) as value, status, coverage_pct,
 period = (select max(period) from series where company = '{COMPANY}') is_latest from series where company = '{COMPANY}'""")
def _(t: Domain):
    own = t.series.where(F.col("company") == COMPANY)
    newest = t.owner_volumes.where(F.col("company") == COMPANY).select(F.max("period")).scalar()
    return plain(own.select("period", "stream", "value", "status", "coverage_pct", (F.col("period") == newest).alias("is_latest")))


@entry("Q9_operator_panel", f"select period, field_count, {EIGHT_SQL} from opers where operator = 'OPERATOR 3'")
def _(t: Domain):
    own = t.attributes.where(F.col("operator") == "OPERATOR 3")
    return plain(P.operator_history(t.history, own).drop("operator", *P.FULL))


@entry("Q10_current_portfolio", f"""
select * from (select {PORTFOLIO} from ({PICK}) p having count(*) > 0) a cross join ({extent_sql('(select rings from (' + PICK + ') z)')}) b""")
def _(t: Domain):
    picked = L.filter_subareas(t.subarea_entries, "group-1", False, "EXTANT")
    shapes = t.subareas.where(
        (X.slug_or_empty(L.holder_or_unmapped(F.col("holder_group"))) == "group-1")
        & ~X.is_operated(F.col("holder_group"), F.col("operator_group")) & (F.col("licence_status") == "EXTANT"))
    return plain(one_row(L.portfolio_summary(picked), L.ring_extent(shapes)))


@entry("Q10_empty", f"""
select * from (select {PORTFOLIO} from ({PICK}) p where false having count(*) > 0) a cross join ({extent_sql('(select rings from (' + PICK + ') z where false)')}) b""")
def _(t: Domain):
    picked = L.filter_subareas(t.subarea_entries, "no-such-group", False, "EXTANT")
    return plain(one_row(L.portfolio_summary(picked), L.ring_extent(t.subareas.where(F.col("holder_group") == "no such group"))))


LONG_AGO = "1800-01-01"
ACTIVE_THEN = ACTIVE.replace(AS_OF, LONG_AGO)


@entry("Q11_empty", f"""
select * from (select {EP_COUNTS} from ep where {ACTIVE_THEN} having count(*) > 0) a
cross join ({extent_sql('(select rings from ep where ' + ACTIVE_THEN + ') z')}) b""")
def _(t: Domain):
    dated = t.episodes.withColumn("start_date", X.epoch_date(F.col("start_ms"))).withColumn(
        "end_date", X.epoch_date(F.col("end_ms")))
    return one_row(L.episode_summary(L.filter_episodes(t.episode_entries, LONG_AGO)),
                   L.ring_extent(L.filter_episodes(dated, LONG_AGO)))


@entry("Q11_licences_as_of", f"""
select * from (select {EP_COUNTS} from ep where {ACTIVE} having count(*) > 0) a cross join ({extent_sql('(select rings from ep where ' + ACTIVE + ') z')}) b""")
def _(t: Domain):
    dated = t.episodes.withColumn("start_date", X.epoch_date(F.col("start_ms"))).withColumn(
        "end_date", X.epoch_date(F.col("end_ms")))
    summary = L.episode_summary(L.filter_episodes(t.episode_entries, AS_OF))
    return one_row(summary, L.ring_extent(L.filter_episodes(dated, AS_OF)))


RANK = "case when strpos(lower(label), '{q}') = 1 then 0 when regexp_matches(substr(lower(label), strpos(lower(label), '{q}') - 1, 1), '[\\s\\-(/]') then 1 else 2 end"


def search_sql(q: str) -> str:
    rank = RANK.replace("{q}", q)
    return f"""select type, label, slug, cast({rank} as bigint) rank from finder where strpos(lower(label), '{q}') > 0
order by {rank}, length(label), label, type, slug limit 20"""


@entry("T8_ranked_search", search_sql("1"))
def _(t: Domain):
    return plain(R.search(t.search_entries, " 1 "))


@entry("U4_search_union", "select type, label, slug from finder")
def _(t: Domain):
    return t.search_entries


@entry("Q12_search", search_sql("00001"))
def _(t: Domain):
    return plain(R.search_index(t.search_entries, t.search_index, "00001"))


@entry("T8_indexed_search", search_sql("or 1"))
def _(t: Domain):
    return plain(R.search_index(t.search_entries, t.search_index, " OR 1 "))


@entry("Q13_field_map_table", f"""
select l.slug, l.operator, l.lon, l.lat, {d(*DERIVED, prefix='l.')}, {COMMODITY_SQL.replace('total_mboed', 'l.total_mboed').replace('liquids_mboed', 'l.liquids_mboed')} commodity,
 p.polygon_name is null shown_as_point from latest l left join (select distinct matched_slug, min(polygon_name) over (partition by matched_slug) polygon_name from polyj where matched_slug is not null) p on p.matched_slug = l.slug""")
def _(t: Domain):
    shapes = L.polygon_matches(t.polygons, t.polygon_matches).where(F.col("matched_slug").isNotNull())
    drawn = shapes.select(F.col("matched_slug").alias("slug"), F.lit(False).alias("point")).distinct()
    commodity = X.dominant_commodity(F.col("liquids_mboed").cast("double"), F.col(TOTAL).cast("double"))
    return plain(t.latest.join(drawn, "slug", "left").select(
        "slug", "operator", "lon", "lat", *DERIVED_STREAMS, commodity.alias("commodity"),
        F.coalesce("point", F.lit(True)).alias("shown_as_point")))


@entry("Q14_group_detail", f"""
select m.grp, m.entity, {d(*DERIVED, prefix='g.')}, case when m.grp = '{G.UNRESOLVED}' then 'unresolved' else 'approved' end mapping_status
from collapsed m join (select *, row_number() over (partition by grp order by period desc) rn from gowide) g on g.grp = m.grp and g.rn = 1""")
def _(t: Domain):
    newest = t.group_wide.groupBy("grp").agg(F.max(F.struct("period", *DERIVED_STREAMS)).alias("n"))
    status = F.when(F.col("grp") == G.UNRESOLVED, "unresolved").otherwise("approved")
    return plain(t.collapsed.join(newest, "grp").select(
        "grp", "entity", *[F.col(f"n.{s}").alias(s) for s in DERIVED_STREAMS], status.alias("mapping_status")))


# --- batch reports ------------------------------------------------------------------------

@entry("Q15_latest_join_checkpoint", f"""
select f.category, count(*) field_count, count(distinct f.field) distinct_fields, {', '.join(f"cast(sum(f.{s}) as double) {s}" for s in FOUR)},
 cast(coalesce(sum(a.n), 0) as bigint) attributed_rows from fml f left join (select field, count(*) n from attl group by 1) a on a.field = f.field group by 1""")
def _(t: Domain):
    shares = t.attributed_latest.groupBy("field").agg(F.count("*").alias("n"))
    return plain(t.resolved_latest.join(shares, "field", "left").groupBy("category").agg(
        F.count("*").alias("field_count"), F.count_distinct("field").alias("distinct_fields"),
        *[F.sum(s).alias(s) for s in EQUITY_STREAMS], F.coalesce(F.sum("n"), F.lit(0)).alias("attributed_rows")))


@entry("Q16_history_join_diagnostic", f"""
select f.category, count(*) field_months, count(distinct f.field) distinct_fields, min(f.period) first_period, max(f.period) last_period,
 {', '.join(f"cast(sum(f.{s}) as double) {s}" for s in FOUR)}, cast(coalesce(sum(a.n), 0) as bigint) attributed_rows
from fm f left join (select field, period, count(*) n from att_all group by 1, 2) a on a.field = f.field and a.period = f.period group by 1""")
def _(t: Domain):
    shares = t.shares.groupBy("field", "period").agg(F.count("*").alias("n"))
    by_field = t.resolved.join(shares, ["field", "period"], "left").groupBy("category", "field").agg(
        F.count("*").alias("m"), F.min("period").alias("lo"), F.max("period").alias("hi"), F.sum("n").alias("n"),
        *[F.sum(s).alias(s) for s in EQUITY_STREAMS])
    return plain(by_field.groupBy("category").agg(
        F.sum("m").alias("field_months"), F.count("*").alias("distinct_fields"), F.min("lo").alias("first_period"),
        F.max("hi").alias("last_period"), *[F.sum(s).alias(s) for s in EQUITY_STREAMS],
        F.coalesce(F.sum("n"), F.lit(0)).alias("attributed_rows")))


@entry("Q17_coverage_window_evidence", f"""
select m.stream, r.longest_run_below, b.at_100, b.from_99_5_to_100, b.from_95_to_99_5, b.below_95, min(m.coverage_pct) lowest_pct,
 min(case when s.bad is null or m.period > s.bad then m.period end) stable_from from mon_all m
join {RUN.format(keys='stream', source='mon_all')} r on r.stream = m.stream
join (select stream, {BUCKETS} from mon_all where coverage_pct is not null group by stream) b on b.stream = m.stream
join (select stream, max(case when coverage_pct < 50 then period end) bad from mon_all group by stream) s on s.stream = m.stream
where m.coverage_pct is not null group by 1, 2, 3, 4, 5, 6""")
def _(t: Domain):
    runs = C.longest_run_below(t.months_all, ["stream"])
    stable = C.stability_points(t.months_all, (50.0,)).drop("threshold")
    lowest = t.months_all.groupBy("stream").agg(F.min("coverage_pct").alias("lowest_pct"), *C.bucket_counts())
    return lowest.join(runs, "stream").join(stable, "stream")
