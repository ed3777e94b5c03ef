"""Queries over licences, episodes and polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import licence as L, production as P
from .catalog_production import COMMODITY_SQL, d
from .domain import Domain
from .reference_sql import DERIVED, slug
from .registry import entry
from .shape import plain

ENTRY_COLUMNS = ("object_id, licence_number, licence_reference, block_reference, subarea_name, licence_status, "
                 "licence_start_date, licence_end_date, equity_pct, display_group, operator_group, operated")
EPISODE_COLUMNS = ("episode_id, is_current_episode, licence_number, licence_reference, block_reference, licence_status, "
                   "start_date, end_date, licensee_names, licensee_group, operator_names, operator_group, admin_org, admin_group")
EXTENT = """min(x[1]) lon_min, max(x[1]) lon_max, min(x[2]) lat_min, max(x[2]) lat_max from (select unnest(flatten(rings)) x from {0}) v"""


def extent_sql(source: str) -> str:
    return "select " + EXTENT.format(source)


@entry("P17_subarea_entries", f"select {ENTRY_COLUMNS.replace('object_id, ', '').replace('licence_number', 'licence_number::bigint licence_number')} from entry")
def _(t: Domain):
    return plain(t.subarea_entries)


@entry("X22_operated_flag", "select operated, count(*) n from entry group by operated")
def _(t: Domain):
    return t.subarea_entries.groupBy("operated").agg(F.count("*").alias("n"))


PORTFOLIO = """count(distinct case when licence_reference <> '' then licence_reference end) distinct_licence_count,
 count(distinct concat_ws('|', licence_reference, block_reference, subarea_name)) distinct_subarea_count,
 count(case when operated then 1 end) operated_count, count(case when not operated then 1 end) non_operated_count"""


@entry("A37_portfolio_by_group", f"select grp, {slug('grp')} slug, {PORTFOLIO} from entry group by grp")
def _(t: Domain):
    return plain(L.portfolio_by_group(t.subarea_entries))


PICK = "select * from entry where {0} = 'group-1' and not operated and licence_status = 'EXTANT'".format(slug("grp"))


@entry("P10_subarea_filter", f"select licence_reference, block_reference, subarea_name, operated from ({PICK}) p")
def _(t: Domain):
    picked = L.filter_subareas(t.subarea_entries, "group-1", False, "EXTANT")
    return picked.select("licence_reference", "block_reference", "subarea_name", "operated")


@entry("A38_portfolio_filter_summary", f"select {PORTFOLIO} from ({PICK}) p having count(*) > 0")
def _(t: Domain):
    return plain(L.portfolio_summary(L.filter_subareas(t.subarea_entries, "group-1", False, "EXTANT")))


@entry("A38_empty_filter_summary", f"select {PORTFOLIO} from (select * from entry where licence_status = 'NO SUCH STATUS') p having count(*) > 0")
def _(t: Domain):
    return plain(L.portfolio_summary(L.filter_subareas(t.subarea_entries, status="NO SUCH STATUS")))


@entry("P18_episode_entries", f"select {EPISODE_COLUMNS} from ep")
def _(t: Domain):
    return t.episode_entries


AS_OF = "1970-06-15"
ACTIVE = "start_date <= '{0}' and (end_date is null or '{0}' < end_date)".format(AS_OF)


@entry("J7_as_of_episodes", f"select episode_id, start_date, end_date from ep where {ACTIVE}")
def _(t: Domain):
    return L.filter_episodes(t.episode_entries, AS_OF).select("episode_id", "start_date", "end_date")


EP_PICK = f"select * from ep where {ACTIVE} and operator_group = 'GROUP 3' and licence_status = '5-LOW'"


@entry("P11_episode_filter", f"select episode_id, licence_reference, block_reference from ({EP_PICK}) p")
def _(t: Domain):
    picked = L.filter_episodes(t.episode_entries, AS_OF, "GROUP 3", "5-LOW")
    return picked.select("episode_id", "licence_reference", "block_reference")


@entry("P11_episode_filter_default_date", """
select episode_id from ep where start_date <= (select max(start_date) from ep) and (end_date is null or (select max(start_date) from ep) < end_date)""")
def _(t: Domain):
    return L.filter_episodes(t.episode_entries, L.latest_start(t.episode_entries)).select("episode_id")


EP_COUNTS = """count(distinct case when licence_reference <> '' then licence_reference end) distinct_licence_count,
 count(distinct case when block_reference <> '' then block_reference end) distinct_block_count, count(*) episode_count"""


@entry("A39_episode_filter_summary", f"select {EP_COUNTS} from ({EP_PICK}) p having count(*) > 0")
def _(t: Domain):
    return L.episode_summary(L.filter_episodes(t.episode_entries, AS_OF, "GROUP 3", "5-LOW"))


@entry("A40_episode_metadata", """
select count(*) record_count, min(start_date) earliest_start_date, max(start_date) latest_start_date, max(end_date) latest_end_date,
 count(case when end_date is null then 1 end) open_ended_count from ep""")
def _(t: Domain):
    return L.episode_metadata(t.episode_entries)


@entry("A40_episode_facets", """
select distinct 'operator_group' facet, operator_group as value from ep where operator_group <> ''
union all select distinct 'licence_status', licence_status from ep where licence_status <> ''""")
def _(t: Domain):
    return L.facet_values(t.episode_entries, ["operator_group", "licence_status"])


@entry("A41_ring_extent_filtered", extent_sql("(select s.rings from subarea s join entry e on e.object_id = s.object_id where {0} = 'group-1')".format(slug("e.grp"))))
def _(t: Domain):
    picked = t.subareas.where(X.slug_or_empty(L.holder_or_unmapped(F.col("holder_group"))) == "group-1")
    return L.ring_extent(picked)


@entry("X13_ring_shape", """
select o object_id, case when n = 1 then 'Polygon' else 'MultiPolygon' end shape, n as polygons from (select object_id o, len(rings) n from episode) t where n > 0""")
def _(t: Domain):
    return plain(L.with_rings(t.episodes).select(
        "object_id", X.geometry_type(F.col("rings")).alias("shape"), F.size(X.polygon_parts(F.col("rings"))).alias("polygons")))


@entry("J8_polygon_match", "select polygon_name, determination_status, matched_field, matched_slug, match_method from polyj")
def _(t: Domain):
    return L.polygon_matches(t.polygons, t.polygon_matches).drop("rings", "field_no")


@entry("J9_polygon_enrichment", f"""
select p.field_no, p.polygon_name, p.matched_slug, coalesce(l.operator, null) operator, {d(*DERIVED, prefix='l.')}
from polyj p left join latest l on l.slug = p.matched_slug""")
def _(t: Domain):
    shapes = L.polygon_matches(t.polygons, t.polygon_matches)
    return plain(L.enrich(shapes, t.latest).select("field_no", "polygon_name", "matched_slug", "operator", *DERIVED))


@entry("P12_operator_map_filter", """
select p.polygon_name, p.matched_slug, l.operator from polyj p left join latest l on l.slug = p.matched_slug
where p.matched_slug is null or l.operator = 'OPERATOR 3'""")
def _(t: Domain):
    shapes = L.enrich(L.polygon_matches(t.polygons, t.polygon_matches), t.latest)
    return L.operator_filter(shapes, "OPERATOR 3").select("polygon_name", "matched_slug", "operator")


@entry("P13_points_without_polygon", """
select slug, field from latest where slug not in (select matched_slug from polyj where matched_slug is not null)""")
def _(t: Domain):
    return L.points_without_shape(t.latest, L.polygon_matches(t.polygons, t.polygon_matches)).select("slug", "field")
