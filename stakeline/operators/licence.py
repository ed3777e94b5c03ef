"""Current subarea holdings and dated licence episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars as X
from .rows import one_row

UNMAPPED = "Unmapped"


def subarea_entries(subareas: DataFrame) -> DataFrame:
    """One published row per subarea holding, everything taken as recorded."""
    return subareas.select(
        "licence_number", "licence_reference", "block_reference", "subarea_name", "licence_status",
        X.epoch_date(F.col("start_ms")).alias("licence_start_date"),
        X.epoch_date(F.col("end_ms")).alias("licence_end_date"),
        "equity_pct",
        F.col("holder_group").alias("display_group"),
        "operator_group",
        X.is_operated(F.col("holder_group"), F.col("operator_group")).alias("operated"),
    )


def holder_or_unmapped(group: Column) -> Column:
    return F.coalesce(F.when(group != "", group), F.lit(UNMAPPED))


def portfolio_counts(entries: DataFrame, *keys: Column) -> DataFrame:
    """Distinct licences and subareas, operated and other rows.

    Exact distinct counts by grouping twice, so that a group holding most of the
    rows is reduced on the map side.
    """
    names = [f"k{i}" for i in range(len(keys))]
    keyed = entries.select(*[k.alias(n) for k, n in zip(keys, names)], "licence_reference", "block_reference",
                           "subarea_name", "operated")
    areas = keyed.groupBy(*names, "licence_reference", "block_reference", "subarea_name").agg(
        F.count_if("operated").alias("operated"), F.count("*").alias("rows")
    )
    licences = areas.groupBy(*names, "licence_reference").agg(
        F.count("*").alias("subareas"), F.sum("operated").alias("operated"), F.sum("rows").alias("rows")
    )
    totals = licences.groupBy(*names).agg(
        F.count_if(F.col("licence_reference") != "").alias("distinct_licence_count"),
        F.sum("subareas").alias("distinct_subarea_count"),
        F.sum("operated").alias("operated_count"),
        (F.sum("rows") - F.sum("operated")).alias("non_operated_count"),
    )
    return totals


def portfolio_by_group(entries: DataFrame) -> DataFrame:
    counts = portfolio_counts(entries, holder_or_unmapped(F.col("display_group")))
    return counts.withColumnRenamed("k0", "grp").withColumn("slug", X.slugify(F.col("grp")))


def filter_subareas(entries: DataFrame, group_slug: str | None = None, operated: bool | None = None,
                    status: str | None = None, licence: str | None = None) -> DataFrame:
    """Every condition is optional and narrows further."""
    if group_slug is not None:
        entries = entries.where(X.slug_or_empty(holder_or_unmapped(F.col("display_group"))) == group_slug)
    if operated is not None:
        entries = entries.where(F.col("operated") == operated)
    if status is not None:
        entries = entries.where(F.col("licence_status") == status)
    if licence is not None:
        entries = entries.where(F.col("licence_reference") == licence)
    return entries


def portfolio_summary(entries: DataFrame) -> DataFrame:
    """The counts of a filtered set; no row at all when nothing matched."""
    return portfolio_counts(entries).where(F.col("distinct_subarea_count") > 0)


def episode_entries(episodes: DataFrame, *more: str) -> DataFrame:
    """One published row per episode; there is no ownership percentage in the source and none here.

    ``more`` names further source columns to carry, such as the rings.
    """
    return episodes.select(
        F.col("object_id").alias("episode_id"),
        F.coalesce(F.col("history") == "N", F.lit(False)).alias("is_current_episode"),
        "licence_number", "licence_reference", "block_reference", "licence_status",
        X.epoch_date(F.col("start_ms")).alias("start_date"),
        X.epoch_date(F.col("end_ms")).alias("end_date"),
        "licensee_names", "licensee_group", "operator_names", "operator_group", "admin_org", "admin_group", *more,
    )


def filter_episodes(entries: DataFrame, day: str | Column | None = None, group: str | None = None,
                    status: str | None = None, licence: str | None = None) -> DataFrame:
    """Episodes containing ``day`` (overlapping ones are all kept) and matching the other conditions."""
    if day is not None:
        when = F.lit(day) if isinstance(day, str) else day
        entries = entries.where(X.contains(F.col("start_date"), F.col("end_date"), when))
    if group is not None:
        entries = entries.where(F.col("operator_group") == group)
    if status is not None:
        entries = entries.where(F.col("licence_status") == status)
    if licence is not None:
        entries = entries.where(F.col("licence_reference") == licence)
    return entries


def latest_start(entries: DataFrame) -> Column:
    return entries.select(F.max("start_date")).scalar()


def episode_summary(entries: DataFrame) -> DataFrame:
    """Distinct licences and blocks and the number of episodes; no row when nothing matched."""
    def filled(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name))

    pairs = entries.groupBy("licence_reference", "block_reference").agg(F.count("*").alias("n"))
    total = pairs.groupBy("licence_reference").agg(F.sum("n").alias("n")).agg(
        F.count(filled("licence_reference")).alias("distinct_licence_count"), F.sum("n").alias("episode_count")
    )
    blocks = pairs.select(filled("block_reference").alias("b")).distinct().agg(
        F.count("b").alias("distinct_block_count")
    )
    return one_row(total, blocks).where(F.col("episode_count") > 0)


def episode_metadata(entries: DataFrame) -> DataFrame:
    return entries.agg(
        F.count("*").alias("record_count"),
        F.min("start_date").alias("earliest_start_date"),
        F.max("start_date").alias("latest_start_date"),
        F.max("end_date").alias("latest_end_date"),
        F.count_if(F.col("end_date").isNull()).alias("open_ended_count"),
    )


def facet_values(entries: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-blank values of several columns, one row per value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns]))
    return entries.select(pairs.alias("f")).select("f.*").where(F.col("value") != "").distinct()


def extent(points: DataFrame) -> DataFrame:
    return points.agg(
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
    )


def ring_extent(shapes: DataFrame) -> DataFrame:
    """Bounding box of all ring vertices.

    Each shape is reduced to its own box by higher-order functions before the
    aggregate, so vertices are never exploded into rows.
    """
    vertices = F.flatten("rings")
    lon = F.transform(vertices, lambda v: F.get(v, F.lit(0)))
    lat = F.transform(vertices, lambda v: F.get(v, F.lit(1)))
    boxes = shapes.select(
        F.array_min(lon).alias("a"), F.array_max(lon).alias("b"), F.array_min(lat).alias("c"), F.array_max(lat).alias("d")
    )
    return boxes.agg(
        F.min("a").alias("lon_min"), F.max("b").alias("lon_max"), F.min("c").alias("lat_min"), F.max("d").alias("lat_max")
    )


def with_rings(shapes: DataFrame) -> DataFrame:
    """Rows without rings cannot be drawn and are left out of a feature collection."""
    return shapes.where(F.coalesce(F.size("rings"), F.lit(0)) > 0)


def polygon_matches(polygons: DataFrame, matches: DataFrame) -> DataFrame:
    """Every polygon with the production field it matched, or none.

    Two production names can share one polygon name. The exact one wins; among
    normalised ones the last in name order, as in the published collection.
    """
    usable = matches.where(F.col("method").isin("exact", "normalized"))
    chosen = usable.groupBy(F.col("equity_field").alias("polygon_name")).agg(
        F.max(F.struct(F.col("method") == "exact", "field", "method")).alias("m")
    )
    return polygons.join(chosen, "polygon_name", "left").select(
        *polygons.columns,
        F.col("m.field").alias("matched_field"),
        F.when(F.col("m").isNotNull(), X.slugify(F.col("m.field"))).alias("matched_slug"),
        F.col("m.method").alias("match_method"),
    )


def enrich(shapes: DataFrame, latest: DataFrame) -> DataFrame:
    """Matched shapes with their field's properties, which win over the shape's own on a shared name."""
    clash = [c for c in shapes.columns if c in latest.columns]
    props = latest.select(F.col("slug").alias("_key"), *[F.col(c) for c in latest.columns if c != "slug"])
    # no slug contains '#': unmatched shapes spread by name instead of meeting under one null key
    own_key = F.coalesce("matched_slug", F.concat(F.lit("#"), F.col("polygon_name")))
    joined = shapes.withColumn("_key", own_key).withColumnsRenamed({c: f"{c}__own" for c in clash}).join(
        props, "_key", "left"
    )
    found = F.col("field").isNotNull()
    return joined.select(
        *[c for c in shapes.columns if c not in clash],
        *[F.when(found, F.col(c)).otherwise(F.col(f"{c}__own")).alias(c) for c in clash],
        *[c for c in latest.columns if c not in clash and c != "slug"],
    )


def operator_filter(shapes: DataFrame, operator: str | None) -> DataFrame:
    """The operator's shapes; unmatched shapes always stay."""
    if operator is None:
        return shapes
    return shapes.where(F.col("matched_slug").isNull() | (F.col("operator") == operator))


def points_without_shape(latest: DataFrame, shapes: DataFrame) -> DataFrame:
    drawn = shapes.where(F.col("matched_slug").isNotNull()).select(F.col("matched_slug").alias("slug"))
    return latest.join(drawn, "slug", "left_anti")
