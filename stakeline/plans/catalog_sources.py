"""Queries over scans and sinks. Sinks are checked by writing and reading back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, EQUITY_STREAMS, NATIVE_STREAMS
from ..operators import checks, coverage as C, intervals as I, licence as L, matching as M, production as P
from ..operators.rows import one_row
from ..session import scratch_path
from ..sources import adapters, readers, schemas, sinks
from .catalog_licence import ENTRY_COLUMNS, EPISODE_COLUMNS
from .catalog_ownership import FOUR_SQL
from .catalog_production import ALL8, EIGHT_SQL, d
from .domain import Domain
from .reference_sql import DERIVED, FIVE, FOUR, dec, r3, slug
from .registry import entry
from .shape import plain


def landed_csv(t: Domain, rows: DataFrame, name: str) -> str:
    path = scratch_path(t.spark, name)
    rows.write.option("header", True).csv(path)
    return path


# --- scans --------------------------------------------------------------------------

@entry("S1_feature_page_scan", "select object_id, field, unit, period, oil_mbd, lon x, lat y from prod")
def _(t: Domain):
    return readers.features(t.pages)


PAGE_SIZE = 2000


def saved(t: Domain, name: str):
    """Stores rows in one pass and reads them back."""
    def save(rows: DataFrame) -> DataFrame:
        path = scratch_path(t.spark, name)
        rows.write.parquet(path)
        return t.spark.read.schema(rows.schema).parquet(path)
    return save


@entry("S1_landed_page_stream", "select object_id, field, unit, period, oil_mbd, lon x, lat y from prod")
def _(t: Domain):
    path = scratch_path(t.spark, "extract")
    readers.land_pages(adapters.landed_pages(t.prod, PAGE_SIZE, leftovers=True), path)
    return readers.fetched_features(t.spark, path, PAGE_SIZE, saved(t, "fetched"))


@entry("S1_repeated_features", f"""
select object_id, count(*) * case when object_id // {PAGE_SIZE} % 11 = 2 then 2 else 1 end copies from prod group by object_id
having count(*) > 1 or object_id // {PAGE_SIZE} % 11 = 2""")
def _(t: Domain):
    path = scratch_path(t.spark, "extract")
    pages = adapters.landed_pages(t.prod, PAGE_SIZE)
    readers.land_pages(pages.unionByName(pages.where(F.col("offset") % 11 == 2)), path)
    return readers.repeated_features(readers.features(readers.page_stream(t.spark, path, PAGE_SIZE, geometry=False), geometry=False))


LANDED = f"{schemas.PRODUCTION}, reported_on date, year int"


@entry("S3_months_of_a_landing", "select field, unit, object_id from prod where period between '199806' and '199901'")
def _(t: Domain):
    return readers.in_months(t.spark, t.landed, LANDED, "199806", "199901").select("field", "unit", "object_id")


@entry("P4_latest_month_of_a_landing", "select field, unit, object_id from prod where period = (select p from newest)")
def _(t: Domain):
    return readers.latest_landed(t.spark, t.landed, LANDED).select("field", "unit", "object_id")


@entry("S4_footer_statistics", """
select strftime(min(l_shipdate), '%Y-%m-%d') min_value, strftime(max(l_shipdate), '%Y-%m-%d') max_value, count(*) row_count from lineitem""")
def _(t: Domain):
    return plain(readers.footer_statistics(t.spark, t.landed, LANDED, "reported_on"))


@entry("S2_column_pruning", "select object_id, field, unit, period, oil_mbd from prod")
def _(t: Domain):
    return readers.features(t.pages, geometry=False)


@entry("S3_filter_pushdown", "select field, unit, object_id from prod where period = '199806'")
def _(t: Domain):
    return P.in_month(t.prod, "199806").select("field", "unit", "object_id")


@entry("S4_statistics_scan", "select min(period) min_value, max(period) max_value, count(*) row_count from prod where oil_mbd > 10")
def _(t: Domain):
    return readers.statistics(t.prod, "period", F.col("oil_mbd") > 10)


@entry("S7_unit_classification_scan", "select field, unit, classification, note from listed")
def _(t: Domain):
    return readers.read_classification(t.spark, landed_csv(t, t.classification, "classification"))


@entry("S8_alias_scan", "select production_name, equity_name from renamed")
def _(t: Domain):
    return readers.read_aliases(t.spark, landed_csv(t, t.aliases, "aliases"))


@entry("S9_override_scan", "select entity, cast(line_no as bigint) line_no, display_group, basis, status from overr1")
def _(t: Domain):
    return plain(readers.read_overrides(t.spark, landed_csv(t, t.overrides, "overrides")))


META_SQL = """select (select count(*) from prod where period = (select p from newest)) record_count,
 (select count(distinct field) from prod where period = (select p from newest)) field_count, count(*) history_record_count,
 count(distinct field) history_field_count, max(period) latest_period from prod"""


@entry("S10_previous_build_metadata", META_SQL)
def _(t: Domain):
    path = scratch_path(t.spark, "metadata")
    meta = checks.build_metadata(t.prod)
    meta.write.json(path)
    return readers.read_metadata(t.spark, path, meta.schema.simpleString()[7:-1].replace(":", " "))


@entry("S11_published_history_scan", f"select field, period, {EIGHT_SQL}, strftime(month_start, '%Y-%m-%d') month_start from hist")
def _(t: Domain):
    point = F.struct("period", *[F.col(s).cast("double").alias(s) for s in ALL8])
    # a field has at most one point per calendar month, which bounds the array
    written = t._stored("published_history", lambda: t.history.groupBy("field").agg(F.array_sort(F.collect_list(point)).alias("series")))
    return plain(readers.published_history(written))


@entry("S12_field_universe", f"""
select h.field, {slug('h.field')} slug, min(h.period) first_period, max(h.period) last_period, a.operator, a.region
from hist h join attrs a on a.field = h.field group by h.field, a.operator, a.region""")
def _(t: Domain):
    return readers.field_universe(t.history, t.attributes)


@entry("S13_latest_production", f"select field, {FOUR_SQL} from latest")
def _(t: Domain):
    return plain(t.latest.select("field", *EQUITY_STREAMS))


@entry("S14_subarea_holders_names", "select object_id, holder_text, holder_group, equity_pct from subarea")
def _(t: Domain):
    return t.subareas.select("object_id", "holder_text", "holder_group", "equity_pct")


@entry("S14_subarea_holders_detail", "select object_id, licence_reference, block_reference, subarea_name, len(rings) ring_count from subarea")
def _(t: Domain):
    return plain(t.subareas.select("object_id", "licence_reference", "block_reference", "subarea_name", F.size("rings").alias("ring_count")))


@entry("S15_episode_scan", "select object_id, history, licence_reference, start_ms::double start_ms, end_ms::double end_ms, operator_group, len(rings) ring_count from episode")
def _(t: Domain):
    return plain(t.episodes.select("object_id", "history", "licence_reference", F.col("start_ms").cast("double").alias("start_ms"), F.col("end_ms").cast("double").alias("end_ms"), "operator_group", F.size("rings").alias("ring_count")))


@entry("S16_polygon_scan", "select field_no, polygon_name, determination_status, len(rings) ring_count from poly")
def _(t: Domain):
    return plain(t.polygons.select("field_no", "polygon_name", "determination_status", F.size("rings").alias("ring_count")))


def history_documents(t: Domain) -> DataFrame:
    """Head, points and units of every field as document lines."""
    named = t.history.withColumn("slug", X.slugify(F.col("field")))
    heads = t.attributes.select(X.slugify(F.col("field")).alias("slug"), "field", "operator", "region", "location")
    points = named.select("slug", "period", *[F.col(s).cast("double").alias(s) for s in ALL8])
    units = t.spans.select(X.slugify(F.col("field")).alias("slug"), "unit", "unit_class", "unit_type", "first_period", "last_period")
    return sinks.documents([
        sinks.section(heads, "head", "slug", []),
        sinks.section(points, "series", "slug", ["period"]),
        sinks.section(units, "unit", "slug", ["first_period", "unit"]),
    ])


POINT = "struct<period: string, " + ", ".join(f"{s}: double" for s in ALL8) + ">"


@entry("S17_document_on_demand", f"select {slug('field')} slug, period, {EIGHT_SQL} from hist where field = 'FIELD 0000000002'")
def _(t: Domain):
    path = scratch_path(t.spark, "documents")
    sinks.write_documents(history_documents(t), path)
    lines = sinks.read_document(t.spark, path, "field-0000000002").where("section = 'series'")
    return lines.select("slug", F.from_json("body", POINT).alias("p")).select("slug", "p.*")


# --- sinks ---------------------------------------------------------------------------

@entry("K1_field_documents", f"""
select {slug('field')} slug, 'series' section, period as label, cast(total_mboed as double) total_mboed from hist
union all select {slug('field')}, 'head', field, null from attrs union all select {slug('field')}, 'unit', unit, null from spans""")
def _(t: Domain):
    path = scratch_path(t.spark, "history")
    sinks.write_documents(history_documents(t), path)
    lines = sinks.read_documents(t.spark, path)
    body = F.from_json("body", "field string, unit string, period string, total_mboed double")
    return lines.select("slug", "section", body.alias("b")).select(
        "slug", "section", F.coalesce("b.period", "b.unit", "b.field").alias("label"), "b.total_mboed")


@entry("K1_field_index", f"""
select {slug('h.field')} slug, h.field, a.operator, a.region, min(h.period) first_period, max(h.period) last_period
from hist h join attrs a on a.field = h.field group by h.field, a.operator, a.region""")
def _(t: Domain):
    path = scratch_path(t.spark, "index")
    index = readers.field_universe(t.history, t.attributes)
    shape = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in index.schema if f.name != "slug")
    sinks.write_documents(sinks.section(index, "index", "slug", []), path)
    return sinks.read_documents(t.spark, path).select("slug", F.from_json("body", f"struct<{shape}>").alias("b")).select("slug", "b.*")


@entry("K2_point_features", f"select slug, lon, lat, unit_count, cast(total_mboed as double) total_mboed, 'Point' shape from latest")
def _(t: Domain):
    features = sinks.point_features(t.latest)
    return plain(features.select(
        "properties.slug", F.get("geometry.coordinates", F.lit(0)).alias("lon"), F.get("geometry.coordinates", F.lit(1)).alias("lat"),
        "properties.unit_count", "properties.total_mboed", F.col("geometry.type").alias("shape")))


SHAPE_SQL = "case when len(rings) = 1 then 'Polygon' else 'MultiPolygon' end"


@entry("K3_polygon_features", f"select field_no, polygon_name, matched_slug, match_method, {SHAPE_SQL} shape, len(rings) parts from polyj")
def _(t: Domain):
    features = sinks.polygon_features(L.polygon_matches(t.polygons, t.polygon_matches).withColumn("parts", F.size("rings")))
    return plain(features.select("properties.field_no", "properties.polygon_name", "properties.matched_slug",
                                 "properties.match_method", F.col("geometry_type").alias("shape"), "properties.parts"))


@entry("K4_portfolio_features", f"select object_id, {slug('grp')} group_slug, operated, {SHAPE_SQL} shape from entry where len(rings) > 0")
def _(t: Domain):
    drawn = L.with_rings(t.subareas)
    rows = drawn.select("object_id", "rings", X.slugify(L.holder_or_unmapped(F.col("holder_group"))).alias("group_slug"),
                        X.is_operated(F.col("holder_group"), F.col("operator_group")).alias("operated"))
    return sinks.polygon_features(rows).select("properties.*", F.col("geometry_type").alias("shape"))


@entry("K5_episode_features", f"select episode_id, is_current_episode, start_date, end_date, operator_group, {SHAPE_SQL} shape from ep where len(rings) > 0")
def _(t: Domain):
    return sinks.polygon_features(L.episode_entries(L.with_rings(t.episodes), "rings")).select(
        "properties.episode_id", "properties.is_current_episode", "properties.start_date", "properties.end_date",
        "properties.operator_group", F.col("geometry_type").alias("shape"))


@entry("K6_operator_documents", f"select {slug('operator')} slug, period, {EIGHT_SQL} from opers")
def _(t: Domain):
    path = scratch_path(t.spark, "operators")
    points = t.operators.select(X.slugify(F.col("operator")).alias("slug"), "period", *[F.col(s).cast("double").alias(s) for s in ALL8])
    sinks.write_documents(sinks.section(points, "series", "slug", ["period"]), path)
    lines = sinks.read_documents(t.spark, path)
    return lines.select("slug", F.from_json("body", POINT).alias("p")).select("slug", "p.*")


@entry("K7_size_conditional_layout", """
select 'series' section, count(*) documents, count(*) read_back, cast(sum(length(to_json({'field': field, 'period': period}))) as bigint) bytes from hist
union all select 'last', count(*), count(*), cast(sum(length(to_json({'field': field, 'period': period}))) as bigint)
from (select field, max(period) period from hist group by field) l""")
def _(t: Domain):
    points = t.history.select("field", "period")
    out = []
    for name, rows in (("series", points), ("last", points.groupBy("field").agg(F.max("period").alias("period")))):
        path = scratch_path(t.spark, "sized")
        docs = sinks.section(rows.withColumn("slug", X.slugify(F.col("field"))), name, "slug", ["period"])
        sinks.write_documents(docs, path)
        lines = sinks.read_documents(t.spark, path)
        back = lines.agg(F.count("body").alias("read_back"), F.sum(F.octet_length("body")).alias("bytes"))
        out.append(one_row(rows.agg(F.count("*").alias("documents")), back).select(F.lit(name).alias("section"), "documents", "read_back", "bytes"))
    return out[0].unionByName(out[1])


@entry("A54_serialized_size", """
select count(*) documents, cast(sum(length(to_json({'operator': operator, 'period': period}))) as bigint) bytes from opers""")
def _(t: Domain):
    return sinks.combined_size(t.operators.select("operator", "period"))


@entry("K8_deterministic_output", "select operator, period, field_count from opers")
def _(t: Domain):
    path = scratch_path(t.spark, "ordered")
    rows = t.operators.select("operator", "period", "field_count")
    order = ["operator", "period"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.json(path)
    return t.spark.read.schema("operator string, period string, field_count bigint").json(path)


@entry("T10_stable_output_order", f"select {slug('field')} slug, period, cast(total_mboed as double) total_mboed from hist")
def _(t: Domain):
    return plain(P.compact_fields(t.history).select("slug", "period", "total_mboed")).orderBy("slug", "period")


@entry("K9_all_or_nothing_publish", f"select period, {d(*DERIVED)} from country")
def _(t: Domain):
    target = scratch_path(t.spark, "site")
    country = plain(t.country)
    sinks.publish(t.spark, target, "build-1", {"country": country}, {"country parts": checks.country_parts(t.country)})
    return t.spark.read.schema(country.schema).parquet(f"{sinks.current_build(t.spark, target)}/country")


@entry("K10_equity_documents", f"""
select 'company' kind, {slug('company')} slug, period, stream, cast(value as double) as value from series
union all select 'group', {slug('grp')}, period, stream, cast(value as double) from gser""")
def _(t: Domain):
    companies = plain(t.series).select(F.lit("company").alias("kind"), X.slugify(F.col("company")).alias("slug"), "period", "stream", "value")
    grouped = plain(t.group_series).select(F.lit("group").alias("kind"), X.slugify(F.col("grp")).alias("slug"), "period", "stream", "value")
    docs = sinks.documents([
        sinks.section(companies, "company", "slug", ["period", "stream"], text=False),
        sinks.section(grouped, "group", "slug", ["period", "stream"], text=False)])
    path = scratch_path(t.spark, "equity")
    sinks.write_documents(docs, path)
    lines = sinks.read_documents(t.spark, path)
    return lines.select("slug", F.from_json("body", "kind string, period string, stream string, value double").alias("b")).select("slug", "b.*")


@entry("K11_mapping_csv", "select entity, display_group, basis, status from mapping")
def _(t: Domain):
    path = scratch_path(t.spark, "mapping")
    sinks.write_csv(t.mapping.select("entity", "display_group", "basis", "status"), path, ["entity"])
    return readers.read_csv(t.spark, path, "entity string, display_group string, basis string, status string")


@entry("K12_chart_csv", f"select period, {d(*DERIVED)} from country")
def _(t: Domain):
    path = scratch_path(t.spark, "chart")
    sinks.write_csv(plain(t.country), path, ["period"])
    return readers.read_csv(t.spark, path, "period string, " + ", ".join(f"{s} double" for s in DERIVED_STREAMS))


ANOMALY_SQL = """select 'quarantined' kind, field, period from pub where category = 'quarantined'
union all select 'interval gap', field, period from pub where category in ('e1_sum_mismatch', 'genuine_interval_gap', 'no_equity_history')
union all select 'future only', field, period from pub where category = 'future_only'
union all select 'unmatched', field, null from matched where method is null
union all select 'below threshold', stream, period from streamstat where status = 'unavailable'"""


@entry("K13_anomaly_export", ANOMALY_SQL)
def _(t: Domain):
    def of(*categories: str) -> DataFrame:
        return t.published.where(F.col("category").isin(*categories)).select("field", "period", "category", "positive_sum")

    table = sinks.anomalies({
        "quarantined": of("quarantined"),
        "interval gap": of("e1_sum_mismatch", "genuine_interval_gap", "no_equity_history"),
        "future only": of("future_only"),
        "unmatched": M.unmatched_left(t.matches),
        "below threshold": t.native_status.where("status = 'unavailable'").select(F.col("stream").alias("field"), "period", "coverage_pct"),
    })
    return table.select("kind", F.from_json("payload", "field string, period string").alias("p")).select("kind", "p.*")
