"""Unit reports rolled up to field, operator and country series.

``prod`` has one or more rows per (field, unit, period):
``field, unit, operator, region, location, unit_type, period, <5 streams>,
gas_pipeline, lon, lat, object_id, reported_at``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as X
from ..functions.volumes import (
    DERIVED_STREAMS,
    NATIVE_STREAMS,
    PUBLISHED,
    TOTAL,
    EQUITY_STREAMS,
    derived,
    exact_sum,
    published_sum,
    round3,
)
from .rows import one_row

CURRENT = ("region", "location", "operator")
# full-precision columns: liquids, and gas in its own unit
FULL = ("liquids_full", "gas_full")


def classify(prod: DataFrame, classification: DataFrame) -> DataFrame:
    """Adds ``unit_class``; a unit nobody listed is a production unit.

    The list holds exceptions only. No broadcast hint: Spark broadcasts it when
    its measured size is below the session threshold and otherwise sorts and
    merges, splitting a hot (field, unit) on the report side.
    """
    listed = classification.select("field", "unit", F.col("classification").alias("unit_class"))
    return prod.join(listed, ["field", "unit"], "left").withColumn(
        "unit_class", F.coalesce("unit_class", F.lit("production"))
    )


def production_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("unit_class") == "production")


def field_history(classified: DataFrame) -> DataFrame:
    """(field, period): exact sums, their published roundings and full-precision equivalents."""
    sums = (
        production_rows(classified)
        .groupBy("field", "period")
        .agg(*[exact_sum(F.col(s)).alias(s) for s in NATIVE_STREAMS])
    )
    liquids, gas = F.col("oil_mbd") + F.col("condensate_mbd"), F.col("dry_gas_mmscfd") + F.col("assoc_gas_mmscfd")
    return sums.select(
        "field",
        "period",
        X.month_start(F.col("period")).alias("month_start"),
        *[round3(F.col(s)).alias(s) for s in NATIVE_STREAMS],
        *[round3(c).alias(n) for n, c in derived(liquids, gas).items()],
        liquids.cast(TOTAL).alias("liquids_full"),
        gas.cast(TOTAL).alias("gas_full"),
    )


def equity_volumes(classified: DataFrame) -> DataFrame:
    """(field, period): the published streams that ownership counts, as in ``field_history`` and without its other sums."""
    return production_rows(classified).groupBy("field", "period").agg(
        *[published_sum(F.col(s)).alias(s) for s in EQUITY_STREAMS]
    ).select("field", "period", X.month_start(F.col("period")).alias("month_start"), *EQUITY_STREAMS)


def reported_months(classified: DataFrame) -> DataFrame:
    """(field, period): the months of ``field_history`` without any sums."""
    return production_rows(classified).select("field", "period").distinct().withColumn(
        "month_start", X.month_start(F.col("period")))


def month_number(period: Column) -> Column:
    return period.cast("int")


def month_text(number: Column) -> Column:
    return F.lpad(number.cast("string"), 6, "0")


def current_attributes(classified: DataFrame) -> DataFrame:
    """Region, location and operator of the field's most recent production month.

    Raw reports are hashed by the attributes they carry with a number as the only
    aggregate (month first, then the earliest row in source order), so nothing is
    sorted; the few combinations of a field are compared after that.
    """
    newest = month_number(F.col("period")).cast("decimal(6,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)") - F.col("object_id")
    combinations = production_rows(classified).groupBy("field", *CURRENT).agg(F.max(newest.cast("decimal(38,0)")).alias("newest"))
    return combinations.groupBy("field").agg(F.max(F.struct("newest", *CURRENT)).alias("last")).select(
        "field", *[F.col(f"last.{c}").alias(c) for c in CURRENT])


def unit_spans(classified: DataFrame) -> DataFrame:
    """First and last month of every unit, with the type of its first row in source order.

    Hashed by unit and type with numbers only; a unit's few types meet in the second step.
    """
    month = month_number(F.col("period"))
    types = classified.groupBy("field", "unit_class", "unit", "unit_type").agg(
        F.min(month).alias("first"), F.max(month).alias("last"), F.min("object_id").alias("object_id"))
    return types.groupBy("field", "unit_class", "unit").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.min(F.struct("object_id", "unit_type")).alias("first_row"),
    ).select("field", "unit_class", "unit", month_text(F.col("first")).alias("first_period"),
             month_text(F.col("last")).alias("last_period"), F.col("first_row.unit_type").alias("unit_type"))


def latest_period(prod: DataFrame) -> Column:
    return prod.select(F.max("period")).scalar()


def in_month(prod: DataFrame, period: str) -> DataFrame:
    """The reports of one YYYYMM month, as a range of the stored date, which a scan can skip by."""
    first = datetime(int(period[:4]), int(period[4:]), 1)
    after = datetime(first.year + first.month // 12, first.month % 12 + 1, 1)
    at = F.col("reported_at")
    return prod.where((at >= F.lit(str(first)).cast("timestamp_ntz")) & (at < F.lit(str(after)).cast("timestamp_ntz")))


def latest_rows(prod: DataFrame) -> DataFrame:
    """The reports of the last month there is, from the first day of the month of the newest date."""
    newest = prod.select(F.max("reported_at").alias("m")).select(
        F.expr("make_timestamp_ntz(year(m), month(m), 1, 0, 0, 0)")).scalar()
    return prod.where(F.col("reported_at") >= newest)


def field_latest(latest_classified: DataFrame) -> DataFrame:
    """One row per producing field at one period.

    Units are reduced first and fields second, so a field's unit count is an
    exact distinct count without ever gathering its rows in one place.
    """
    is_prod = F.col("unit_class") == "production"
    has_point = is_prod & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    attrs = F.struct("unit", "object_id", *CURRENT)
    degrees = "decimal(12,9)"
    units = latest_classified.groupBy("field", "unit_class", "unit", "period").agg(
        *[exact_sum(F.col(s)).alias(s) for s in NATIVE_STREAMS],
        F.sum(F.when(has_point, F.col("lon").cast(degrees))).alias("lon_sum"),
        F.sum(F.when(has_point, F.col("lat").cast(degrees))).alias("lat_sum"),
        F.count_if(has_point).alias("points"),
        F.min(attrs).alias("first_row"),
    )
    fields = units.groupBy("field").agg(
        F.max("period").alias("period"),
        F.count_if(is_prod).alias("unit_count"),
        F.count_if(~is_prod).alias("storage_unit_count"),
        *[F.sum(F.when(is_prod, F.col(s))).cast(TOTAL).alias(s) for s in NATIVE_STREAMS],
        F.sum("lon_sum").alias("lon_sum"),
        F.sum("lat_sum").alias("lat_sum"),
        F.sum("points").alias("points"),
        F.min(F.when(is_prod, F.col("first_row"))).alias("first_row"),
    )
    equivalents = derived(
        F.col("oil_mbd") + F.col("condensate_mbd"), F.col("dry_gas_mmscfd") + F.col("assoc_gas_mmscfd")
    )
    points = F.when(F.col("points") > 0, F.col("points"))
    return fields.where(F.col("unit_count") > 0).select(
        "field",
        X.slugify(F.col("field")).alias("slug"),
        "period",
        *[F.col(f"first_row.{c}").alias(c) for c in CURRENT],
        "unit_count",
        "storage_unit_count",
        F.round(F.col("lon_sum").cast("decimal(28,9)") / points, 3).cast(PUBLISHED).alias("lon"),
        F.round(F.col("lat_sum").cast("decimal(28,9)") / points, 3).cast(PUBLISHED).alias("lat"),
        *[round3(F.col(s)).alias(s) for s in NATIVE_STREAMS],
        *[round3(c).alias(n) for n, c in equivalents.items()],
    )


def exclusion_counters(classified: DataFrame) -> DataFrame:
    """Row, field and unit counts with and without storage, as one row."""
    is_prod = F.col("unit_class") == "production"
    units = classified.groupBy("field", "unit_class", "unit").agg(F.count("*").alias("n"))
    fields = units.groupBy("field").agg(
        F.sum(F.when(is_prod, F.col("n")).otherwise(0)).alias("production_rows"),
        F.sum(F.when(~is_prod, F.col("n")).otherwise(0)).alias("storage_rows"),
        F.count_if(is_prod).alias("production_units"),
        F.count_if(~is_prod).alias("storage_units"),
    )
    return fields.agg(
        F.count("*").alias("raw_field_count"),
        F.count_if(F.col("production_units") > 0).alias("production_field_count"),
        F.count_if(F.col("production_units") == 0).alias("storage_only_field_count"),
        F.sum("production_units").alias("production_unit_count"),
        F.sum("storage_units").alias("storage_unit_count"),
        F.sum("production_rows").alias("production_row_count"),
        F.sum("storage_rows").alias("storage_row_count"),
    )


def operator_history(history: DataFrame, attributes: DataFrame) -> DataFrame:
    """Every month of a field counts for the operator that holds it today.

    Native streams add up values that were already rounded per field; the
    derived streams add full precision and are rounded once.
    """
    owner = attributes.select(
        "field",
        F.when(F.coalesce("operator", F.lit("")) != "", F.col("operator"))
        .otherwise(F.raise_error(F.concat(F.lit("field without operator: "), "field")).cast("string"))
        .alias("operator"),
    )
    return (
        history.join(owner, "field")
        .groupBy("operator", "period")
        .agg(
            F.count("*").alias("field_count"),
            *[F.sum(s).cast(PUBLISHED).alias(s) for s in NATIVE_STREAMS],
            *[F.sum(s).cast(TOTAL).alias(s) for s in FULL],
        )
        .select(
            "operator", "period", "field_count", *NATIVE_STREAMS,
            *[round3(c).alias(n) for n, c in derived(F.col("liquids_full"), F.col("gas_full")).items()],
            *FULL,
        )
    )


def country_history(history: DataFrame) -> DataFrame:
    """One row per month: full-precision equivalents added up and rounded once."""
    sums = history.groupBy("period").agg(*[F.sum(s).cast(TOTAL).alias(s) for s in FULL])
    equivalents = derived(F.col("liquids_full"), F.col("gas_full"))
    return sums.select("period", *[round3(c).alias(n) for n, c in equivalents.items()])


def in_range(series: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive month range, either side optional."""
    if start is not None:
        series = series.where(F.col("period") >= start)
    if end is not None:
        series = series.where(F.col("period") <= end)
    return series


def annual_average(series: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean of the known months of each year; a year with none of them is null."""
    return series.groupBy(*keys, F.substring("period", 1, 4).alias("year")).agg(
        *[round3(F.sum(v).cast(TOTAL) / F.nullif(F.count(v), F.lit(0))).alias(v) for v in values]
    )


def annual_oil_gas(history: DataFrame) -> DataFrame:
    """Field-year means; a month counts for a component when either of its streams is known."""
    oil, cond = F.col("oil_mbd"), F.col("condensate_mbd")
    assoc, dry = F.col("assoc_gas_mmscfd"), F.col("dry_gas_mmscfd")
    zero = F.lit(0)
    oil_month = F.when(oil.isNotNull() | cond.isNotNull(), F.coalesce(oil, zero) + F.coalesce(cond, zero))
    gas_month = F.when(assoc.isNotNull() | dry.isNotNull(), F.coalesce(assoc, zero) + F.coalesce(dry, zero))
    sums = history.groupBy("field", F.substring("period", 1, 4).alias("year")).agg(
        F.sum(oil_month).cast(TOTAL).alias("oil"),
        F.count(oil_month).alias("oil_months"),
        F.sum(gas_month).cast(TOTAL).alias("gas"),
        F.count(gas_month).alias("gas_months"),
    )
    oil_n = F.nullif(F.col("oil_months"), F.lit(0))
    gas_n = F.nullif(F.col("gas_months"), F.lit(0))
    return sums.select(
        "field",
        "year",
        round3(F.col("oil") / oil_n).alias("oil_mboed"),
        round3(F.col("gas") / (gas_n * 6)).alias("gas_mboed"),
    )


def peak_year(country: DataFrame) -> DataFrame:
    """The complete year (twelve known months) with the highest mean; the earlier one on a tie."""
    years = country.groupBy(F.substring("period", 1, 4).alias("year")).agg(
        F.count("total_mboed").alias("months"), F.avg("total_mboed").alias("average")
    )
    return years.where("months >= 12").orderBy(F.desc("average"), "year").limit(1).select("year", "average")


def year_ago(country: DataFrame) -> DataFrame:
    """Each month with the same month a year before, found by date and not by row distance."""
    before = country.select(
        F.add_months(X.month_start(F.col("period")), 12).alias("month_start"),
        F.col("total_mboed").alias("before_mboed"),
    )
    return country.withColumn("month_start", X.month_start(F.col("period"))).join(before, "month_start", "left")


def headline(country: DataFrame) -> DataFrame:
    """Latest month, component shares, change on the year before, distance from the peak year.

    ``country`` has one row per calendar month.
    """
    latest = year_ago(country).orderBy(F.desc("period")).limit(1)
    peak = peak_year(country).select(F.col("year").alias("peak_year"), F.col("average").alias("peak_average"))
    newest = one_row(latest, peak)
    total = F.nullif(F.col("total_mboed").cast("double"), F.lit(0.0))
    now, before = F.col("total_mboed").cast("double"), F.col("before_mboed").cast("double")
    return newest.select(
        "period",
        F.col("total_mboed"), F.col("liquids_mboed"), F.col("natural_gas_mboed"),
        F.round(F.col("liquids_mboed").cast("double") / total * 100, 6).alias("liquids_share_pct"),
        F.round(F.col("natural_gas_mboed").cast("double") / total * 100, 6).alias("gas_share_pct"),
        F.round(X.change_pct(now, before), 6).alias("change_pct"),
        X.change_badge(now, before).alias("badge"),
        "peak_year",
        F.round(now / F.col("peak_average").cast("double") * 100, 6).alias("pct_of_peak"),
    )


def operator_index(operators: DataFrame, attributes: DataFrame) -> DataFrame:
    """Span, field count and latest point of each operator; only the newest month's values."""
    newest = F.max(F.struct("period", *NATIVE_STREAMS, *DERIVED_STREAMS)).alias("newest")
    spans = operators.groupBy("operator").agg(F.min("period").alias("first_period"), newest)
    counts = attributes.groupBy("operator").agg(F.count("*").alias("field_count"))
    return spans.join(counts, "operator").select(
        "operator",
        X.slugify(F.col("operator")).alias("slug"),
        "field_count",
        "first_period",
        F.col("newest.period").alias("last_period"),
        *[F.col(f"newest.{s}").alias(s) for s in (*NATIVE_STREAMS, *DERIVED_STREAMS)],
    )


def attribute_notes(latest_classified: DataFrame) -> DataFrame:
    """Attributes that differ between the production units of one field in one month.

    Two levels of grouping instead of collecting values: distinct values first, then how many.
    """
    values = production_rows(latest_classified).select(
        "field", "period",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("attribute"), F.coalesce(F.col(c), F.lit("<null>")).alias("value"))
            for c in CURRENT
        ])).alias("a"),
    ).select("field", "period", "a.attribute", "a.value").distinct()
    return (
        values.groupBy("field", "period", "attribute")
        .agg(F.count("*").alias("distinct_values"), F.min("value").alias("first_value"),
             F.max("value").alias("last_value"))
        .where("distinct_values > 1")
    )


def grain_profile(prod: DataFrame) -> DataFrame:
    """Per (field, unit): months, rows and distinct types."""
    by_type = prod.groupBy("field", "unit", "unit_type").agg(
        F.count("*").alias("rows"), F.min("period").alias("lo"), F.max("period").alias("hi")
    )
    return by_type.groupBy("field", "unit").agg(
        F.min("lo").alias("first_period"), F.max("hi").alias("last_period"),
        F.sum("rows").alias("row_count"), F.count("*").alias("type_count"),
    )


def grain_summary(prod: DataFrame) -> DataFrame:
    fields = prod.groupBy("field", "unit").count().groupBy("field").agg(F.count("*").alias("units"))
    return fields.agg(
        F.count("*").alias("field_count"),
        F.sum("units").alias("field_unit_count"),
        F.count_if(F.col("units") > 1).alias("multi_unit_field_count"),
    )


def storage_like(prod: DataFrame, classification: DataFrame) -> DataFrame:
    """Distinct units that sound like storage or injection and are in no list."""
    name = F.upper("unit")
    suspicious = prod.where(name.contains("STORAGE") | name.contains("INJECTION")).select("field", "unit").distinct()
    return suspicious.join(classification.select("field", "unit"), ["field", "unit"], "left_anti")


def handover_chain(spans: DataFrame) -> DataFrame:
    """Production units of each field in the order they first appear."""
    w = Window.partitionBy("field").orderBy("first_period", "unit")
    return spans.where(F.col("unit_class") == "production").select(
        "field", F.row_number().over(w).alias("position"), "unit", "first_period", "last_period"
    )


def last_known(series: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's most recent point with a value; keys that never had one are absent."""
    newest = F.max(F.when(F.col(value).isNotNull(), F.struct("period", value))).alias("newest")
    return (
        series.groupBy(key).agg(newest).where(F.col("newest").isNotNull())
        .select(key, F.col("newest.period").alias("last_period"), F.col(f"newest.{value}").alias(value))
    )


def partial_year(series: DataFrame) -> DataFrame:
    """Months seen in the newest year when that year has not reached December; otherwise no row."""
    years = series.select("period").distinct().groupBy(F.substring("period", 1, 4).alias("year")).agg(
        F.max("period").alias("last_period"), F.count("*").alias("months")
    )
    newest = years.orderBy(F.desc("year")).limit(1)
    return newest.where(F.substring("last_period", 5, 2) < "12").select("year", "months")


# fixed values: source column -> published stream
SOURCE_COLUMNS = {
    "OILPRODMBD": "oil_mbd",
    "AGASPROMMS": "assoc_gas_mmscfd",
    "DGASPROMMS": "dry_gas_mmscfd",
    "GCONDMBD": "condensate_mbd",
    "WATPRODMBD": "water_mbd",
}


def rename_values(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(SOURCE_COLUMNS)


def panel_fallback(shapes: DataFrame, latest: DataFrame, attributes: DataFrame) -> DataFrame:
    """What a clicked shape shows: the latest record, else the history entry, else only its slug."""
    now = latest.select(F.col("field").alias("matched_field"), F.col("operator").alias("o1"),
                        F.col("region").alias("r1"), "location", F.lit(True).alias("in_latest"))
    ever = attributes.select(F.col("field").alias("matched_field"), F.col("operator").alias("o2"),
                             F.col("region").alias("r2"), F.lit(True).alias("in_history"))
    return shapes.join(now, "matched_field", "left").join(ever, "matched_field", "left").select(
        "polygon_name", "matched_slug",
        F.coalesce("o1", "o2").alias("operator"), F.coalesce("r1", "r2").alias("region"), "location",
        F.when(F.col("in_latest"), "latest").when(F.col("in_history"), "history").otherwise("slug").alias("source"),
    )


def compact_fields(history: DataFrame) -> DataFrame:
    """Field series for top-N views: the values already published, never recomputed."""
    return history.select("field", X.slugify(F.col("field")).alias("slug"), "period", *DERIVED_STREAMS)
