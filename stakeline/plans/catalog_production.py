"""Queries over unit, field, operator and country production."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, NATIVE_STREAMS
from ..operators import licence, production as P, ranking
from .domain import Domain
from .reference_sql import DERIVED, FIVE, dec, pct, r3, slug
from .registry import entry
from .shape import plain

ALL8 = [*NATIVE_STREAMS, *DERIVED_STREAMS]


def d(*names: str, prefix: str = "") -> str:
    return ", ".join(f"cast({prefix}{n} as double) {n}" for n in names)


FIVE_SQL = d(*FIVE)
EIGHT_SQL = d(*FIVE, *DERIVED)


# --- projections and predicates ---------------------------------------------

@entry("P1_value_column_map", f"select field, period, {', '.join(f'round(sum(cast({s} as decimal(28,12))), 3)::double {s}' for s in FIVE)} from prod group by field, period")
def _(t: Domain):
    source = t.prod.withColumnsRenamed({
        "oil_mbd": "OILPRODMBD", "assoc_gas_mmscfd": "AGASPROMMS", "dry_gas_mmscfd": "DGASPROMMS",
        "condensate_mbd": "GCONDMBD", "water_mbd": "WATPRODMBD",
    })
    named = P.rename_values(source)
    return plain(named.groupBy("field", "period").agg(
        *[F.round(F.sum(F.col(s).cast("decimal(28,12)")), 3).alias(s) for s in NATIVE_STREAMS]))


@entry("P2_null_as_zero_sums", f"select field, {', '.join(r3(f'sum({dec(s)})') + ' ' + s for s in FIVE)} from prod group by field")
def _(t: Domain):
    from ..functions.volumes import exact_sum, round3
    return plain(t.prod.groupBy("field").agg(*[round3(exact_sum(F.col(s))).alias(s) for s in NATIVE_STREAMS]))


@entry("P3_storage_split", "select field, unit, unit_class, count(*) n from prodc group by field, unit, unit_class")
def _(t: Domain):
    return t.classified.groupBy("field", "unit", "unit_class").agg(F.count("*").alias("n"))


@entry("P4_latest_period_rows", "select field, unit, object_id, lon, lat from prod where period = (select p from newest)")
def _(t: Domain):
    return P.latest_rows(t.prod).select("field", "unit", "object_id", "lon", "lat")


@entry("P6_period_range", f"select field, period, {d('total_mboed')} from hist where period >= '199606' and period <= '199812'")
def _(t: Domain):
    return plain(P.in_range(t.history, "199606", "199812").select("field", "period", "total_mboed"))


@entry("P9_field_status", """
select field, last_period, cast(total_mboed as double) total_mboed,
 last_period = (select max(period) from country) and total_mboed > 0 producing
from (select field, period last_period, total_mboed, row_number() over (partition by field order by period desc) rn from hist) t where rn = 1""")
def _(t: Domain):
    newest = t.country.select(F.max("period")).scalar()
    return plain(ranking.field_status(P.last_known(t.history, "field", "total_mboed"), newest))


@entry("P14_storage_like_units", """
select distinct p.field, p.unit from prod p left join listed l on p.field = l.field and p.unit = l.unit
where l.field is null and (upper(p.unit) like '%STORAGE%' or upper(p.unit) like '%INJECTION%')""")
def _(t: Domain):
    return P.storage_like(t.prod, t.classification)


@entry("P23_last_years_preset", f"""
select period, {d(*DERIVED)} from country
where period >= concat(cast(cast((select max(substr(period, 1, 4)) from country) as integer) - 4 as varchar), '01')""")
def _(t: Domain):
    start = X.preset_start(t.country.select(F.max("period")).scalar(), 5)
    return plain(t.country.where(F.col("period") >= start))


@entry("J1_unit_classification_lookup", f"""
select field, unit, period, unit_class, count(*) n, {r3(f"sum({dec('water_mbd')})")} water_mbd
from prodc group by field, unit, period, unit_class""")
def _(t: Domain):
    from ..functions.volumes import exact_sum, round3
    return plain(t.classified.groupBy("field", "unit", "period", "unit_class").agg(
        F.count("*").alias("n"), round3(exact_sum(F.col("water_mbd"))).alias("water_mbd")))


# --- aggregations -------------------------------------------------------------

@entry("A1_field_totals_latest", f"select field, slug, period, region, location, operator, unit_count, storage_unit_count, lon, lat, {EIGHT_SQL} from latest")
def _(t: Domain):
    return plain(t.latest)


@entry("A2_field_history", f"select field, period, {EIGHT_SQL} from hist")
def _(t: Domain):
    return plain(t.history.select("field", "period", *ALL8))


@entry("A3_unit_life_spans", "select field, unit_class, unit, first_period, last_period, unit_type from spans")
def _(t: Domain):
    return t.spans


@entry("A4_operator_rollup", f"select operator, period, field_count, {EIGHT_SQL} from opers")
def _(t: Domain):
    return plain(t.operators.select("operator", "period", "field_count", *ALL8))


@entry("A5_country_totals", f"select period, {d(*DERIVED)} from country")
def _(t: Domain):
    return plain(t.country)


ANNUAL_SQL = ", ".join(
    f"round(cast(sum({s}) as double) / count({s}), 3) {s}" for s in DERIVED)


def exact_mean(value: str) -> str:
    """Half-up mean of a three-place decimal, in integers."""
    milli = f"cast(sum(cast({value} * 1000 as hugeint)) as hugeint)"
    return f"cast((({milli} * 2 + count({value})) // (2 * count({value}))) as double) / 1000"


@entry("A6_annual_average", f"select substr(period, 1, 4) as year, {', '.join(f'{exact_mean(s)} {s}' for s in DERIVED)} from country group by 1")
def _(t: Domain):
    return plain(P.annual_average(t.country, [], list(DERIVED_STREAMS)))


def _sixth_mean(value: str) -> str:
    milli = f"cast(sum(cast(({value}) * 1000 as hugeint)) as hugeint)"
    return f"cast((({milli} * 2 + 6 * count(*)) // (12 * count(*))) as double) / 1000"


@entry("A7_field_annual_oil_gas", f"""
select field, substr(period, 1, 4) as year, {exact_mean('(oil_mbd + condensate_mbd)')} oil_mboed,
 {_sixth_mean('assoc_gas_mmscfd + dry_gas_mmscfd')} gas_mboed from hist group by 1, 2""")
def _(t: Domain):
    return plain(P.annual_oil_gas(t.history))


PEAK_SQL = """select year, average from (select substr(period, 1, 4) as year, sum(total_mboed) / count(*) average
 from country group by 1 having count(*) >= 12) t order by average desc, year limit 1"""


@entry("A8_peak_complete_year", f"select year, round(average, 6) average from ({PEAK_SQL}) p")
def _(t: Domain):
    return plain(P.peak_year(t.country).select("year", F.round(F.col("average").cast("double"), 6).alias("average")))


@entry("A41_bounding_extent_points", "select min(lon) lon_min, max(lon) lon_max, min(lat) lat_min, max(lat) lat_max from latest")
def _(t: Domain):
    return plain(licence.extent(t.latest))


@entry("A43_attribute_notes", """
select field, period, attribute, count(distinct v) distinct_values, min(v) first_value, max(v) last_value from (
 select field, period, 'region' attribute, coalesce(region, '<null>') v from latestc where unit_class = 'production'
 union all select field, period, 'location', coalesce(location, '<null>') from latestc where unit_class = 'production'
 union all select field, period, 'operator', coalesce(operator, '<null>') from latestc where unit_class = 'production') t
group by field, period, attribute having count(distinct v) > 1""")
def _(t: Domain):
    return P.attribute_notes(t.latest_classified)


@entry("A44_grain_investigation", """
select field, unit, min(period) first_period, max(period) last_period, count(*) row_count, count(distinct unit_type) type_count
from prod group by field, unit""")
def _(t: Domain):
    return P.grain_profile(t.prod)


@entry("A44_grain_summary_latest", """
select count(*) field_count, cast(sum(units) as bigint) field_unit_count, count(case when units > 1 then 1 end) multi_unit_field_count
from (select field, count(distinct unit) units from prod where period = (select p from newest) group by field) t""")
def _(t: Domain):
    return P.grain_summary(P.latest_rows(t.prod))


@entry("A45_operator_index", f"""
select o.operator, {slug('o.operator')} slug, c.n field_count, f.lo first_period, o.period last_period, {d(*FIVE, *DERIVED, prefix='o.')}
from opers o join (select operator, min(period) lo, max(period) hi from opers group by operator) f on f.operator = o.operator and f.hi = o.period
join (select operator, count(*) n from attrs group by operator) c on c.operator = o.operator""")
def _(t: Domain):
    return plain(P.operator_index(t.operators, t.attributes))


KPI_SQL = f"""
select c.period, {d(*DERIVED, prefix='c.')},
 round(cast(c.liquids_mboed as double) / cast(c.total_mboed as double) * 100, 6) liquids_share_pct,
 round(cast(c.natural_gas_mboed as double) / cast(c.total_mboed as double) * 100, 6) gas_share_pct,
 round((cast(c.total_mboed as double) - cast(b.total_mboed as double)) / cast(b.total_mboed as double) * 100, 6) change_pct,
 case when b.total_mboed is null then null when (c.total_mboed - b.total_mboed) / b.total_mboed * 100 > 0.05 then 'up'
  when (c.total_mboed - b.total_mboed) / b.total_mboed * 100 < -0.05 then 'down' else 'flat' end badge,
 p.year peak_year, round(cast(c.total_mboed as double) / p.average * 100, 6) pct_of_peak
from country c left join country b on b.period = concat(cast(cast(substr(c.period, 1, 4) as integer) - 1 as varchar), substr(c.period, 5, 2))
cross join ({PEAK_SQL}) p where c.period = (select max(period) from country)"""


@entry("A51_headline_figures", KPI_SQL)
def _(t: Domain):
    return plain(P.headline(t.country))


@entry("A53_exclusion_counters", """
select count(distinct field) raw_field_count, count(distinct case when unit_class = 'production' then field end) production_field_count,
 count(distinct field) - count(distinct case when unit_class = 'production' then field end) storage_only_field_count,
 count(distinct case when unit_class = 'production' then field || '|' || unit end) production_unit_count,
 count(distinct case when unit_class = 'storage' then field || '|' || unit end) storage_unit_count,
 count(case when unit_class = 'production' then 1 end) production_row_count,
 count(case when unit_class = 'storage' then 1 end) storage_row_count from prodc""")
def _(t: Domain):
    return P.exclusion_counters(t.classified)


# --- ordered operators --------------------------------------------------------

@entry("W1_current_attributes", "select field, region, location, operator from attrs")
def _(t: Domain):
    return t.attributes


LAST_SQL = """select field, period last_period, total_mboed from (select field, period, total_mboed,
 row_number() over (partition by field order by period desc) rn from hist where total_mboed is not null) t where rn = 1"""


@entry("W4_rank_by_latest_value", f"""
select field, cast(total_mboed as double) total_mboed, row_number() over (order by total_mboed desc, field) as position
from ({LAST_SQL}) l order by total_mboed desc, field limit 20""")
def _(t: Domain):
    return plain(ranking.leaders(P.last_known(t.history, "field", "total_mboed"), "field", "total_mboed", 20))


@entry("W5_last_known_point", f"select field, last_period, cast(total_mboed as double) total_mboed from ({LAST_SQL}) l")
def _(t: Domain):
    return plain(P.last_known(t.history, "field", "total_mboed"))


@entry("W6_first_last_period", "select field, min(period) first_period, max(period) last_period from hist group by field")
def _(t: Domain):
    return t.history.groupBy("field").agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"))


@entry("W7_partial_year", """
select substr(period, 1, 4) as year, count(distinct period) as months from hist
where substr(period, 1, 4) = (select max(substr(period, 1, 4)) from hist) group by 1 having max(substr(period, 5, 2)) < '12'""")
def _(t: Domain):
    return P.partial_year(t.history)


@entry("W9_unit_handover_chain", """
select field, row_number() over (partition by field order by first_period, unit) as position, unit, first_period, last_period
from spans where unit_class = 'production'""")
def _(t: Domain):
    return plain(P.handover_chain(t.spans))


@entry("J18_year_ago", f"""
select c.period, {d('total_mboed', prefix='c.')}, cast(b.total_mboed as double) before_mboed
from country c left join country b on b.period = concat(cast(cast(substr(c.period, 1, 4) as integer) - 1 as varchar), substr(c.period, 5, 2))""")
def _(t: Domain):
    return plain(P.year_ago(t.country).select("period", "total_mboed", "before_mboed"))


@entry("J20_fallback_lookup", """
select p.polygon_name, p.matched_slug, coalesce(l.operator, a.operator) operator, coalesce(l.region, a.region) region, l.location,
 case when l.field is not null then 'latest' when a.field is not null then 'history' else 'slug' end source
from polyj p left join latest l on l.field = p.matched_field left join attrs a on a.field = p.matched_field where p.matched_field is not null""")
def _(t: Domain):
    shapes = licence.polygon_matches(t.polygons, t.polygon_matches).where(F.col("matched_field").isNotNull())
    return P.panel_fallback(shapes, t.latest, t.attributes)


# --- scalars over whole tables -------------------------------------------------

@entry("X1_round3", "select p_partkey, cast(round(cast(p_retailprice / 7 as decimal(18,9)), 3) as double) rounded from part")
def _(t: Domain):
    from ..functions.volumes import round3
    return plain(t.raw("part").select(
        "p_partkey", round3((F.col("p_retailprice") / 7).cast("decimal(18,9)")).alias("rounded")))


@entry("X2_slugify", f"select distinct p_name, {slug('p_name')} slug from part")
def _(t: Domain):
    return t.raw("part").select("p_name").distinct().select("p_name", X.slugify(F.col("p_name")).alias("slug"))


@entry("X3_normalize_name", r"select field_name, regexp_replace(upper(trim(field_name)), '\s+', ' ', 'g') name_key from rnames")
def _(t: Domain):
    return t.stakes.select("field_name").distinct().select(
        "field_name", X.normalize_name(F.col("field_name")).alias("name_key"))


@entry("X4_energy_equivalents", f"select field, period, {d(*DERIVED)} from hist")
def _(t: Domain):
    return plain(t.history.select("field", "period", *DERIVED_STREAMS))


@entry("X5_month_start", "select distinct period, strftime(strptime(period || '01', '%Y%m%d'), '%Y-%m-%d') month_start from prod")
def _(t: Domain):
    return plain(t.prod.select("period").distinct().select("period", X.month_start(F.col("period")).alias("month_start")))


@entry("X6_next_month", """
select distinct strftime(start_date, '%Y-%m-%d') start_date, strftime(date_trunc('month', start_date), '%Y-%m-%d') month_floor,
 strftime(date_trunc('month', start_date) + interval 1 month, '%Y-%m-%d') next_month from equity""")
def _(t: Domain):
    day = F.col("start_date")
    return plain(t.stakes.select("start_date").distinct().select(
        "start_date", X.month_floor(day).alias("month_floor"), X.next_month(day).alias("next_month")))


@entry("X7_epoch_to_date", """
select object_id, strftime(date '1970-01-01' + cast(start_ms // 86400000 as integer), '%Y-%m-%d') as day,
 strftime(date '1970-01-01' + cast(start_ms // 86400000 as integer), '%Y-%m-%dT00:00:00Z') as iso from episode""")
def _(t: Domain):
    return t.episodes.select("object_id", X.epoch_date(F.col("start_ms")).alias("day"), X.epoch_iso(F.col("start_ms")).alias("iso"))


_FORMS = ["substr(period, 1, 4) || '-' || substr(period, 5, 2)", "substr(period, 1, 4) || '/' || substr(period, 5, 2)",
          "substr(period, 1, 4) || ' ' || substr(period, 5, 2)", "period", "substr(period, 1, 4)",
          "substr(period, 1, 4) || '13'", "'x' || period"]


@entry("X8_period_input", " union ".join(f"""
select distinct {form} raw, {"period" if i < 4 else "substr(period, 1, 4) || '01'" if i == 4 else 'cast(null as varchar)'} from_period,
 {"period" if i < 4 else "substr(period, 1, 4) || '12'" if i == 4 else 'cast(null as varchar)'} to_period from prod""" for i, form in enumerate(_FORMS)))
def _(t: Domain):
    raw = t.prod.select("period").distinct().select(F.explode(F.array(*[F.expr(f) for f in _FORMS])).alias("raw")).distinct()
    return raw.select("raw", X.normalize_period_input(F.col("raw"), "start").alias("from_period"),
                      X.normalize_period_input(F.col("raw"), "end").alias("to_period"))


@entry("X9_period_formatting", """
select distinct period, strftime(strptime(period || '01', '%Y%m%d'), '%B %Y') long_form,
 strftime(strptime(period || '01', '%Y%m%d'), '%b %Y') short_form from prod""")
def _(t: Domain):
    return t.prod.select("period").distinct().select(
        "period", X.period_long(F.col("period")).alias("long_form"), X.period_short(F.col("period")).alias("short_form"))


COMMODITY_SQL = """case when coalesce(total_mboed, 0) <= 0 then 'none'
 when cast(liquids_mboed as double) / cast(total_mboed as double) >= 0.5 then 'oil' else 'gas' end"""


@entry("X12_dominant_commodity", f"select field, period, {COMMODITY_SQL} commodity from hist")
def _(t: Domain):
    return t.history.select("field", "period", X.dominant_commodity(
        F.col("liquids_mboed").cast("double"), F.col("total_mboed").cast("double")).alias("commodity"))


@entry("X23_change_badge", """
select c.period, round((cast(c.total_mboed as double) - cast(b.total_mboed as double)) / cast(b.total_mboed as double) * 100, 6) change_pct,
 case when (cast(c.total_mboed as double) - cast(b.total_mboed as double)) / cast(b.total_mboed as double) * 100 > 0.05 then 'up'
  when (cast(c.total_mboed as double) - cast(b.total_mboed as double)) / cast(b.total_mboed as double) * 100 < -0.05 then 'down'
  when b.total_mboed is not null then 'flat' end badge
from country c left join country b on b.period = concat(cast(cast(substr(c.period, 1, 4) as integer) - 1 as varchar), substr(c.period, 5, 2))""")
def _(t: Domain):
    now, before = F.col("total_mboed").cast("double"), F.col("before_mboed").cast("double")
    return P.year_ago(t.country).select(
        "period", F.round(X.change_pct(now, before), 6).alias("change_pct"), X.change_badge(now, before).alias("badge"))


@entry("X24_rounding_tolerance", """
select operator, n, m, round(8 * 0.5e-3 * sqrt((n + m) / 3.0), 9) tolerance from (
 select operator, sum(field_count)::bigint n, count(*) m from opers group by operator) t""")
def _(t: Domain):
    sizes = t.operators.groupBy("operator").agg(F.sum("field_count").alias("n"), F.count("*").alias("m"))
    return sizes.select("operator", "n", "m", F.round(X.rounding_tolerance(F.col("n"), F.col("m")), 9).alias("tolerance"))


# --- set operations ------------------------------------------------------------

@entry("U5_unit_table", "select field, unit, unit_class as class, unit_type, first_period, last_period from spans")
def _(t: Domain):
    columns = ["field", "unit", "unit_class", "unit_type", "first_period", "last_period"]
    spans = t.spans.select(*columns)
    both = spans.where(F.col("unit_class") == "production").unionByName(spans.where(F.col("unit_class") != "production"))
    return both.withColumnRenamed("unit_class", "class")


@entry("U6_facet_values", """
select 'operator' facet, operator as value from attrs union select 'region', region from attrs union select 'location', location from attrs""")
def _(t: Domain):
    return licence.facet_values(t.attributes, ["operator", "region", "location"])


@entry("U7_distinct_years", "select distinct substr(period, 1, 4) as year from hist")
def _(t: Domain):
    return t.history.select(F.substring("period", 1, 4).alias("year")).distinct()


@entry("P22_out_of_bounds_points", "select field, unit, object_id, lon, lat from prod where not (lon between -14 and 5 and lat between 48 and 63)")
def _(t: Domain):
    from ..operators import checks
    return checks.out_of_bounds(t.prod.select("field", "unit", "object_id", "lon", "lat"))
