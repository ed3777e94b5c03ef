"""The data checks as queries: offenders, or the compared figures where a check has no offenders here."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, NATIVE_STREAMS
from ..operators import checks as K, licence as L, production as P, ranking as R
from ..operators.rows import one_row
from ..session import scratch_path
from ..sources import adapters, readers, schemas
from .catalog_licence import EPISODE_COLUMNS
from .catalog_ownership import FOUR_SQL, four_sum
from .catalog_production import EIGHT_SQL, d
from .catalog_sources import META_SQL, PAGE_SIZE
from .domain import Domain
from .reference_sql import DERIVED, FIVE, FOUR
from .registry import ENTRIES, entry
from .shape import plain

SOURCES = {
    "production": ("prod", schemas.PRODUCTION), "classification": ("classification", schemas.CLASSIFICATION),
    "stakes": ("stakes", schemas.STAKES), "aliases": ("aliases", schemas.ALIASES),
    "overrides": ("overrides", schemas.OVERRIDES), "subareas": ("subareas", schemas.SUBAREAS),
    "episodes": ("episodes", schemas.EPISODES), "polygons": ("polygons", schemas.POLYGONS),
}
VIEW_OF = {"production": "prod", "classification": "listed", "stakes": "equity", "aliases": "renamed", "overrides": "overr",
           "subareas": "subarea", "episodes": "episode", "polygons": "poly"}


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@entry("V1_schema_contract", " union all ".join(f"select '{n}' source, count(*) row_count, 0::bigint differences from {v}" for n, v in VIEW_OF.items()))
def _(t: Domain):
    return union([
        getattr(t, attribute).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("source"), "row_count",
            F.lit(len(K.contract_differences(getattr(t, attribute).schema, contract))).cast("bigint").alias("differences"))
        for name, (attribute, contract) in SOURCES.items()])


def contract_fields(contract: str) -> list[tuple[str, str]]:
    """(name, type) of a column contract whose types hold no comma; statements are made without a session."""
    return sorted(tuple(column.strip().split(" ", 1)) for column in contract.split(","))


def contract_text(contract: str) -> str:
    """The sorted (name, type) pairs of a column contract as JSON."""
    return json.dumps([{"name": n, "type": k} for n, k in contract_fields(contract)], separators=(",", ":"))


@entry("A49_schema_fingerprint", " union all ".join(
    f"select '{name}' source, sha256('{contract_text(contract)}') fingerprint, "
    f"{len(contract_fields(contract))}::bigint as columns, count(*) row_count from {VIEW_OF[name]}"
    for name, (_, contract) in SOURCES.items()))
def _(t: Domain):
    return union([
        K.schema_fingerprint(t.spark, getattr(t, attribute)).select(F.lit(name).alias("source"), "fingerprint", "columns").withColumn(
            "row_count", getattr(t, attribute).agg(F.count("*")).scalar())
        for name, (attribute, _) in SOURCES.items()])


@entry("V2_negative_inputs", "select field, unit, object_id, 'gas_pipeline' column_name, gas_pipeline as value from prod where gas_pipeline < 0")
def _(t: Domain):
    return K.negatives(t.prod, ["field", "unit", "object_id"], [*NATIVE_STREAMS, "gas_pipeline"])


@entry("V3_negative_aggregates", " union all ".join(f"select field, period, '{s}' column_name, cast({s} as double) as value from hist where {s} < 0" for s in FIVE))
def _(t: Domain):
    return K.negatives(t.history, ["field", "period"], list(NATIVE_STREAMS))


def landed_extract(t: Domain, pages: DataFrame) -> str:
    path = scratch_path(t.spark, "extract")
    readers.land_pages(pages, path)
    return path


@entry("V4_fetched_count", "select count(*) counted, count(*) expected from prod")
def _(t: Domain):
    path = landed_extract(t, adapters.landed_pages(t.prod, PAGE_SIZE))
    fetched = readers.features(readers.page_stream(t.spark, path, PAGE_SIZE, geometry=False), geometry=False)
    return one_row(fetched.agg(F.count("*").alias("counted")), readers.read_manifest(t.spark, path).agg(F.sum("features").alias("expected")))


@entry("V4_planted_lost_pages", f"""
select object_id // {PAGE_SIZE} as "offset", count(*) expected, 0::bigint fetched from prod where object_id // {PAGE_SIZE} % 7 = 3 group by 1""")
def _(t: Domain):
    path = landed_extract(t, adapters.landed_pages(t.prod, PAGE_SIZE))
    pages = readers.page_stream(t.spark, path, PAGE_SIZE, geometry=False)
    return readers.page_gaps(pages.where(F.col("offset") % 7 != 3), readers.read_manifest(t.spark, path))


@entry("V5_repartition_conservation", " union all ".join(f"""
select '{s}' stream, cast(h.v as double) left_total, cast(o.v as double) right_total, abs(h.v - o.v) <= 0.01 holds
from (select sum({s}) v from hist) h cross join (select sum({s}) v from opers) o""" for s in FIVE))
def _(t: Domain):
    gaps = K.native_conservation(t.history, t.operators)
    return plain(gaps.select("stream", "left_total", "right_total", (F.col("gap") <= F.col("tolerance")).alias("holds")))


@entry("V6_full_precision_conservation", " union all ".join(f"""
select '{n}' stream, round(h.v, 6)::double left_total, abs(h.v - o.v) <= 0.0001 holds from (select sum({c}) v from hist) h
cross join (select sum({c}) v from hist join attrs a on a.field = hist.field) o""" for n, c in (("liquids_full", "liquids_raw"), ("gas_full", "gas_raw"))))
def _(t: Domain):
    gaps = K.exact_conservation(t.history, t.operators)
    return plain(gaps.select("stream", F.round("left_total", 6).alias("left_total"), (F.col("gap") <= F.col("tolerance")).alias("holds")))


@entry("V7_rounded_conservation", " union all ".join(f"""
select '{s}' stream, cast(h.v as double) left_total, cast(o.v as double) right_total, round(8 * 0.5e-3 * sqrt((h.n + o.n) / 3.0), 9) tolerance,
 cast(abs(h.v - o.v) as double) <= 8 * 0.5e-3 * sqrt((h.n + o.n) / 3.0) holds
from (select sum({s}) v, count(*) n from hist) h cross join (select sum({s}) v, count(*) n from opers) o""" for s in DERIVED))
def _(t: Domain):
    gaps = K.rounded_conservation(t.history, t.operators)
    return plain(gaps.select("stream", "left_total", "right_total", F.round("tolerance", 9).alias("tolerance"),
                             (F.col("gap") <= F.col("tolerance")).alias("holds")))


FORMULA = """(abs(cast(liquids_mboed as double) - (cast(oil_mbd as double) + cast(condensate_mbd as double))) > {0}
 or abs(cast(natural_gas_mboed as double) - (cast(dry_gas_mmscfd as double) + cast(assoc_gas_mmscfd as double)) / 6) > {0}
 or abs(cast(total_mboed as double) - (cast(oil_mbd as double) + cast(condensate_mbd as double) + (cast(dry_gas_mmscfd as double) + cast(assoc_gas_mmscfd as double)) / 6)) > {0})"""


@entry("V8_derived_formula", f"select operator, period, 'formula' reason from opers where {FORMULA.format('0.01')}")
def _(t: Domain):
    return K.formula_offenders(t.operators, ["operator", "period"], 0.01)


@entry("V9_unclassified_storage_like", """
select field, count(*) as units from (select distinct p.field, p.unit from prod p left join listed l on l.field = p.field and l.unit = p.unit
 where l.unit is null and (contains(upper(p.unit), 'STORAGE') or contains(upper(p.unit), 'INJECTION'))) t group by field""")
def _(t: Domain):
    return P.storage_like(t.prod, t.classification).groupBy("field").agg(F.count("*").alias("units"))


@entry("V10_bounding_box", """
select count(case when not (lon between -14 and 5 and lat between 48 and 63) then 1 end) outside, min(lon) lon_min, max(lon) lon_max,
 min(lat) lat_min, max(lat) lat_max from prod""")
def _(t: Domain):
    outside = K.out_of_bounds(t.prod.select("lon", "lat")).agg(F.count("*").alias("outside"))
    return one_row(outside, L.extent(t.prod))


@entry("V11_interval_rows", """
select field_name, company_name, strftime(start_date, '%Y-%m-%d') start_date, 'end before start' reason from equity where end_date < start_date""")
def _(t: Domain):
    return plain(K.interval_offenders(t.stakes).select("field_name", "company_name", "start_date", "reason"))


@entry("V12_interest_sums", """
select count(case when category = 'resolved' then 1 end) passing, count(case when category = 'e1_sum_mismatch' and positive_sum < 100 then 1 end) below_100,
 count(case when category = 'e1_sum_mismatch' and positive_sum >= 100 then 1 end) above_100 from fm""")
def _(t: Domain):
    return K.interest_sums(t.categorised)


@entry("V12_mismatch_examples", """
select field, period, positive_sum, greatest((select count(*) from fm where category = 'e1_sum_mismatch') - 20, 0) more
from fm where category = 'e1_sum_mismatch' order by field, period limit 20""")
def _(t: Domain):
    bad = t.resolved.where(F.col("category") == "e1_sum_mismatch").select("field", "period", "positive_sum")
    return plain(R.sample_with_total(bad, ["field", "period"]))


@entry("T7_offender_sample", """
select field, unit, object_id, lon, lat, greatest((select count(*) from prod where not (lon between -14 and 5 and lat between 48 and 63)) - 20, 0) more
from prod where not (lon between -14 and 5 and lat between 48 and 63) order by field, unit, object_id, lon, lat limit 20""")
def _(t: Domain):
    bad = K.out_of_bounds(t.prod.select("field", "unit", "object_id", "lon", "lat"))
    return R.sample_with_total(bad, ["field", "unit", "object_id", "lon", "lat"])


@entry("V13_quarantine_summary", f"""
select count(*) field_months, count(distinct field) field_count, min(period) first_period, max(period) last_period,
 {', '.join(f"coalesce(cast(round(sum({s}), 4) as double), 0) {s}" for s in FOUR)} from fm where category = 'quarantined'""")
def _(t: Domain):
    return plain(K.quarantine_summary(t.resolved))


@entry("V13_quarantined_rows", """
select f.field, f.period, a.company_name, a.interest_pct, strftime(a.start_date, '%Y-%m-%d') start_date, strftime(a.end_date, '%Y-%m-%d') end_date
from fm f join act a on a.field = f.field and a.period = f.period where f.category = 'quarantined'""")
def _(t: Domain):
    from ..operators import intervals as I
    held = t.resolved.where(F.col("category") == "quarantined")
    return plain(I.active_rows(held, t.layout).select("field", "period", "company_name", "interest_pct", "start_date", "end_date"))


@entry("V13_quarantined_but_attributed", """
select field, count(*) as rows from att where field in (select field from pub where category = 'quarantined') group by field""")
def _(t: Domain):
    return K.quarantined_but_attributed(t.published, t.attributed).groupBy("field").agg(F.count("*").alias("rows"))


@entry("V14_categories_and_dates", """
select (select count(*) from fm where category is null) uncategorised, count(*) rows_checked,
 count(case when start_date > end_date then 1 end) start_after_end, count(case when start_date = end_date then 1 end) zero_length from equity""")
def _(t: Domain):
    return one_row(K.uncategorised(t.categorised).agg(F.count("*").alias("uncategorised")), K.date_order(t.stakes))


@entry("V15_missing_rings", "select field_no, polygon_name from poly where len(rings) = 0")
def _(t: Domain):
    return K.missing_rings(t.polygons).select("field_no", "polygon_name")


@entry("V15_missing_centroid", "select field, slug from latest where lon is null or lat is null")
def _(t: Domain):
    return K.missing_centroid(t.latest).select("field", "slug")


@entry("V16_attribution_conservation", " union all ".join(f"""
select f.period, '{s}' stream, cast(f.v as double) expected, cast(round(coalesce(a.v, 0), 3) as double) actual,
 cast(abs(f.v - coalesce(a.v, 0)) as double) <= greatest(0.001, cast(f.v as double) * 0.5 / 100) holds
from (select period, sum({s}) v from pub where category = 'resolved' group by period) f
left join (select period, sum({s}) v from att group by period) a on a.period = f.period""" for s in FOUR))
def _(t: Domain):
    compared = K.attribution_conservation(t.published, t.published_shares)
    return plain(compared.select("period", "stream", "expected", F.round("actual", 3).alias("actual"),
                                 (F.col("gap") <= F.col("tolerance")).alias("holds")))


def _group_check(view: str) -> str:
    return f"""select s.stream, cast(s.v as double) left_total, cast(g.v as double) right_total, abs(s.v - g.v) <= 1e-6 holds
from (select stream, coalesce(sum(value), 0) v from series group by stream) s join (select stream, coalesce(sum(value), 0) v from {view} group by stream) g on g.stream = s.stream"""


def _group_result(gaps: DataFrame) -> DataFrame:
    return plain(gaps.select("stream", "left_total", "right_total", (F.col("gap") <= F.col("tolerance")).alias("holds")))


@entry("V17_group_conservation", _group_check("gser"))
def _(t: Domain):
    return _group_result(K.group_conservation(t.series, t.group_series))


@entry("V17_overview_conservation", _group_check("gover"))
def _(t: Domain):
    return _group_result(K.group_conservation(t.series, t.group_overview))


@entry("V18_breakdown_reconciles", """
select g.grp, g.period, cast(g.total_mboed as double) total_mboed, cast(f.v as double) parts_total from gowide g
left join (select grp, period, sum(total_mboed) v, count(total_mboed) n from gfs group by 1, 2) f on f.grp = g.grp and f.period = g.period
join (select grp, count(*) m from collapsed group by grp) s on s.grp = g.grp
where (g.total_mboed is null and coalesce(f.n, 0) > 0) or
 cast(abs(g.total_mboed - coalesce(f.v, 0)) as double) > 8 * 0.5e-3 * sqrt((coalesce(f.n, 0) + s.m) / 3.0)""")
def _(t: Domain):
    fields = t.group_fields  # before the group months, which then read its facts
    groups, sizes = t.group_wide, t.collapsed.groupBy("grp").agg(F.count("*").alias("members"))
    bound = X.rounding_tolerance(F.coalesce("parts_known", F.lit(0)), F.col("members"))
    compared = K.parts_against_group(groups.join(sizes, "grp"), fields, bound)
    return plain(K.parts_offenders(compared).select("grp", "period", "total_mboed", "parts_total"))


@entry("V19_fields_reconcile_with_country", """
select h.period, cast(sum(h.total_mboed) as double) fields_total, cast(max(c.total_mboed) as double) country_total
from hist h left join country c on c.period = h.period group by h.period having max(c.total_mboed) is null or
 cast(abs(sum(h.total_mboed) - max(c.total_mboed)) as double) > 8 * 0.5e-3 * sqrt(((select count(*) from hist) + (select count(*) from country)) / 3.0)""")
def _(t: Domain):
    return plain(K.country_offenders(K.fields_against_country(t.history, t.country)).select("period", "fields_total", "country_total"))


@entry("V20_country_parts", """
select period, cast(total_mboed as double) total_mboed from country where abs(total_mboed - liquids_mboed - natural_gas_mboed) > 0.01""")
def _(t: Domain):
    return plain(K.country_parts(t.country, 0.01).select("period", "total_mboed"))


@entry("V21_episode_dates", """
select episode_id, start_date, end_date, case when start_date is null then 'start missing' else 'end before start' end reason from ep
where start_date is null or end_date < start_date""")
def _(t: Domain):
    return K.episode_date_offenders(t.episode_entries).select("episode_id", "start_date", "end_date", "reason")


@entry("V22_unnamed_licensees", "select episode_id, licence_reference from ep where trim(licensee_names) = ''")
def _(t: Domain):
    return K.unnamed_licensees(t.episode_entries).select("episode_id", "licence_reference")


@entry("V23_no_percentage_property", "select 'ownership' words, count(*) features, 0::bigint offending from ep")
def _(t: Domain):
    return K.percentage_keys(t.episode_entries)


PREVIOUS = META_SQL.replace("from prod where period = (select p from newest)", "from old where period = (select max(period) from old)").replace("from prod", "from old")


def change_sql() -> str:
    rows = []
    for name, column, direction, limit in K.BUILD_LIMITS[:4]:
        change = f"(b.{column} - n.{column}) / b.{column}::double * 100" if direction == "drop" else f"abs(n.{column} - b.{column}) / b.{column}::double * 100"
        rows.append(f"select '{name}' as check, b.{column}::double before, n.{column}::double now, round({change}, 6) change_pct, "
                    f"case when {change} > {limit} then 'failed' else 'passed' end outcome from b cross join n")
    rows.append("select 'latest period', b.latest_period::double, n.latest_period::double, null, case when n.latest_period < b.latest_period then 'failed' else 'passed' end from b cross join n")
    return (f"select * from (with old as (select * from prod where period < (select p from newest)), b as ({PREVIOUS}), n as ({META_SQL}) "
            + " union all ".join(rows) + ") z")


@entry("V24_change_vs_previous_build", change_sql())
def _(t: Domain):
    before = t.prod.where(F.col("period") < P.latest_period(t.prod))
    return K.build_changes(K.build_metadata(before), K.build_metadata(t.prod))


@entry("V25_interval_count_vs_previous", """
select b.n::double before, c.n::double now, round(abs(c.n - b.n) / b.n::double * 100, 6) change_pct,
 case when abs(c.n - b.n) / b.n::double * 100 > 10 then 'failed' else 'passed' end outcome
from (select count(*) n from equity where start_date < date '2001-01-01') b cross join (select count(*) n from equity) c""")
def _(t: Domain):
    old = t.stakes.where(F.col("start_date") < F.lit("2001-01-01").cast("date"))
    changes = K.build_changes(K.build_metadata(t.prod, old), K.build_metadata(t.prod, t.stakes))
    return changes.where(F.col("check") == "interval count").drop("check")


@entry("V26_source_title", "select max(status) source_title, min(status) previous_title from equity having max(status) <> min(status)")
def _(t: Domain):
    current = t.stakes.agg(F.max("status").alias("source_title"))
    previous = t.stakes.agg(F.min("status").alias("source_title"))
    return K.title_changed(previous, current)


TITLE = "'Interests to ' || strftime(max(start_date), '%Y-%m-%d')"


@entry("V26_title_of_builds", f"""
select * from (with now as (select {TITLE} t from equity), old as (select {TITLE} t from equity where start_date < date '2001-01-01')
select 'after an older build' as run, old.t previous_title, now.t source_title, case when old.t = now.t then 'unchanged' else 'changed' end outcome from old, now
union all select 'again', now.t, now.t, 'unchanged' from now union all select 'first', null, now.t, 'first run' from now) z""")
def _(t: Domain):
    title = lambda stakes: stakes.agg(F.concat(F.lit("Interests to "), F.date_format(F.max("start_date"), "yyyy-MM-dd"))).scalar()
    old = t.stakes.where(F.col("start_date") < F.lit("2001-01-01").cast("date"))
    base = scratch_path(t.spark, "builds")
    current = K.titled(K.build_metadata(t.prod), title(t.stakes))
    for name, stakes in (("older", old), ("same", t.stakes)):
        K.titled(K.build_metadata(t.prod), title(stakes)).write.json(f"{base}/{name}")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in current.schema)
    runs = {"after an older build": "older", "again": "same", "first": "none"}
    return union([K.title_change(readers.read_metadata(t.spark, f"{base}/{folder}", shape), current).select(F.lit(run).alias("run"), "*")
                  for run, folder in runs.items()])


# --- the same checks over tables with planted violations -------------------------------------


@entry("V3_planted", "select field, period, 'oil_mbd' column_name, -cast(oil_mbd as double) as value from hist where period like '%06' and oil_mbd > 0")
def _(t: Domain):
    planted = t.history.withColumn("oil_mbd", F.when(F.col("period").endswith("06"), -F.col("oil_mbd")).otherwise(F.col("oil_mbd")))
    return K.negatives(planted, ["field", "period"], list(NATIVE_STREAMS))


@entry("V8_planted", f"""
select operator, period, 'formula' reason from (select * replace (case when operator = 'OPERATOR 3' then total_mboed + 1 else total_mboed end as total_mboed) from opers) o
where {FORMULA.format('0.01')}""")
def _(t: Domain):
    total = F.col("total_mboed")
    planted = t.operators.withColumn("total_mboed", F.when(F.col("operator") == "OPERATOR 3", total + 1).otherwise(total))
    return K.formula_offenders(planted, ["operator", "period"], 0.01)


@entry("V11_planted", """
select field_name, company_name, strftime(start_date, '%Y-%m-%d') start_date, 'end before start' reason from equity where end_date is not null and interest_pct = 0""")
def _(t: Domain):
    planted = t.stakes.withColumn("end_date", F.when((F.col("interest_pct") == 0) & F.col("end_date").isNotNull(), F.date_sub("start_date", 1)).otherwise(F.col("end_date")))
    return plain(K.interval_offenders(planted).select("field_name", "company_name", "start_date", "reason"))


@entry("V15_planted_centroid", "select field, slug from latest where regexp_matches(slug, '[13579]$')")
def _(t: Domain):
    planted = t.latest.withColumn("lon", F.when(~F.col("slug").rlike("[13579]$"), F.col("lon")))
    return K.missing_centroid(planted).select("field", "slug")


@entry("V19_planted", """
select h.period, cast(sum(h.total_mboed) as double) fields_total, cast(max(c.total_mboed) + 100000 as double) country_total
from hist h join country c on c.period = h.period where h.period like '%03' group by h.period""")
def _(t: Domain):
    total = F.col("total_mboed")
    planted = t.country.withColumn("total_mboed", F.when(F.col("period").endswith("03"), total + 100000).otherwise(total))
    return plain(K.country_offenders(K.fields_against_country(t.history, planted)).select("period", "fields_total", "country_total"))


@entry("V18_planted", """
select g.grp, g.period, cast(coalesce(g.total_mboed, 0) + 50 as double) total_mboed, cast(f.v as double) parts_total from gowide g
left join (select grp, period, sum(total_mboed) v from gfs group by 1, 2) f on f.grp = g.grp and f.period = g.period
where g.period like '%05'""")
def _(t: Domain):
    fields = t.group_fields  # before the group months, which then read its facts
    groups, sizes = t.group_wide, t.collapsed.groupBy("grp").agg(F.count("*").alias("members"))
    total = F.col("total_mboed")
    planted = groups.join(sizes, "grp").withColumn("total_mboed", F.when(F.col("period").endswith("05"), F.coalesce(total, F.lit(0)) + 50).otherwise(total))
    bound = X.rounding_tolerance(F.coalesce("parts_known", F.lit(0)), F.col("members"))
    return plain(K.parts_offenders(K.parts_against_group(planted, fields, bound)).select("grp", "period", "total_mboed", "parts_total"))


@entry("V20_planted", "select period, cast(total_mboed as double) total_mboed from country where period like '%11'")
def _(t: Domain):
    liquids = F.col("liquids_mboed")
    planted = t.country.withColumn("liquids_mboed", F.when(F.col("period").endswith("11"), liquids + 1).otherwise(liquids))
    return plain(K.country_parts(planted, 0.01).select("period", "total_mboed"))


OLD_SUMS = f"""(select p.field, p.period, {', '.join(f"cast(round(sum(coalesce(cast({s} as decimal(28,12)), 0)), 3) as decimal(18,3)) {s}" for s in FIVE)} from prod p group by 1, 2)"""


@entry("J19_build_comparison", f"""
select coalesce(o.field, h.field) field, coalesce(o.period, h.period) period,
 case when o.field is null then 'new' when h.field is null then 'gone' else 'changed' end as change
from {OLD_SUMS} o full outer join hist h on h.field = o.field and h.period = o.period
where o.field is null or h.field is null or not ({' and '.join(f'o.{s} = h.{s}' for s in FIVE)})""")
def _(t: Domain):
    unlisted = t.prod.withColumn("unit_class", F.lit("production"))
    keep = ["field", "period", *NATIVE_STREAMS]
    return K.table_changes(P.field_history(unlisted).select(*keep), t.history.select(*keep), ["field", "period"])


@entry("J19_comparison_by_digests", ENTRIES["J19_build_comparison"].sql)
def _(t: Domain):
    keep, keys = ["field", "period", *NATIVE_STREAMS], ["field", "period"]
    before = P.field_history(t.prod.withColumn("unit_class", F.lit("production"))).select(*keep)
    after, path = t.history.select(*keep), scratch_path(t.spark, "digests")
    K.range_digests(before, keys).write.parquet(path)  # as a build leaves them
    return K.changes_by_digest(before, after, t.spark.read.parquet(path), K.range_digests(after, keys), keys)
