"""The domain's source tables, derived from the TPC-H-like test tables.

Every table is a projection or a calendar-bounded aggregation of whole input
tables. Planted irregularities (odd spellings, gaps, overlaps, zero-length
rows, blank names) are cases over key values; no row is filtered away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

FIELD = "concat('FIELD ', lpad(cast({0} as string), 10, '0'))"
COMPANY = "concat('Customer#', lpad(cast({0} as string), 9, '0'))"
BOX = (
    "array(array({0}, {1}), array({0} + 0.5D, {1}), array({0} + 0.5D, {1} + 0.5D), array({0}, {1} + 0.5D), array({0}, {1}))"
)


# fixed values: columns of the test tables the adapters read
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_mktsegment string",
    "nation": "n_nationkey int",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table under its known schema, so that planning reads no file footer."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _rings(key: str) -> str:
    """No ring, one ring or two rings, by key."""
    lon, lat = f"(-14.0D + ({key} % 180) / 10.0D)", f"(48.0D + ({key} % 140) / 10.0D)"
    one, two = BOX.format(lon, lat), BOX.format(f"({lon} + 1.0D)", lat)
    return (
        f"case when {key} % 29 = 3 then cast(array() as array<array<array<double>>>) "
        f"when {key} % 5 = 0 then array({one}, {two}) else array({one}) end as rings"
    )


def unit_production(lineitem: DataFrame, *carried: str) -> DataFrame:
    return lineitem.selectExpr(
        f"{FIELD.format('l_suppkey')} as field",
        "concat('UNIT ', cast(l_partkey % 7 as string), case l_partkey % 7 when 6 then ' STORAGE' "
        "when 5 then ' INJECTION' else '' end) as unit",
        "concat('OPERATOR ', cast((l_suppkey + year(l_shipdate)) % 13 as string)) as operator",
        "case when l_linenumber = 7 then 'UNALLOCATED' else concat('AREA ', cast(l_suppkey % 5 as string)) end as region",
        "case when l_suppkey % 9 = 0 then 'ONSHORE' else 'OFFSHORE' end as location",
        "concat('TYPE ', cast(l_linenumber % 3 as string)) as unit_type",
        "cast(year(l_shipdate) * 100 + month(l_shipdate) as string) as period",
        "case when l_returnflag = 'A' then l_quantity end as oil_mbd",
        "case when l_returnflag = 'A' then l_extendedprice / 1000 end as assoc_gas_mmscfd",
        "case when l_returnflag = 'R' then l_extendedprice / 1000 end as dry_gas_mmscfd",
        "case when l_returnflag = 'R' then l_quantity * abs(l_discount) end as condensate_mbd",
        "case when l_returnflag = 'N' then l_quantity end as water_mbd",
        "l_extendedprice * (l_discount - 0.001D) as gas_pipeline",
        "-14.0D + (l_partkey % 195) / 10.0D as lon",
        "48.0D + (l_orderkey % 150) / 10.0D as lat",
        "l_orderkey * 10 + l_linenumber as object_id",
        "l_shipdate as reported_at",
        *carried,
    )


def unit_classification(supplier: DataFrame) -> DataFrame:
    """Two listed units per field; an injection unit of a field in debt is not listed."""
    listed = supplier.selectExpr(
        f"{FIELD.format('s_suppkey')} as field",
        "explode(case when s_acctbal < 0 then array('UNIT 6 STORAGE') "
        "else array('UNIT 6 STORAGE', 'UNIT 5 INJECTION') end) as unit",
        "s_nationkey",
    )
    return listed.selectExpr(
        "field", "unit",
        "case when unit = 'UNIT 6 STORAGE' and s_nationkey <> 13 then 'storage' else 'production' end as classification",
        "'listed by name' as note",
    )


def ownership_spans(orders: DataFrame) -> DataFrame:
    """Every order changes the ownership of its field on its date, until the next date with orders.

    Orders of one field and date share the interest (``n`` of them). Only the distinct dates of
    a field pass the window, so it holds as many rows as the calendar has days at most.
    """
    changes = orders.selectExpr(
        "o_custkey div 15 as fk", "o_custkey as ck", "cast(o_orderdate as date) as d", "o_orderkey as ok")
    w = Window.partitionBy("fk").orderBy("d")
    dates = changes.groupBy("fk", "d").agg(F.count("*").alias("n")).select(
        "*", F.lead("d").over(w).alias("nd"), F.lag("d").over(w).alias("pd"))
    return changes.join(dates, ["fk", "d"])


def stakes(orders: DataFrame) -> DataFrame:
    rows = ownership_spans(orders).selectExpr(
        "*",
        "case when fk % 100 = 49 then concat('RETIRED FIELD ', cast(fk as string))"
        " when fk % 7 = 3 then concat(case when fk % 10 = 6 and ck % 2 = 0 then 'Field   ' else 'field   ' end, lpad(cast(fk as string), 10, '0'))"
        f" when fk % 11 = 5 then concat('OLD FIELD ', cast(fk as string)) else {FIELD.format('fk')} end as field_name",
        "case when fk % 100 = 37 then make_date(2090, 1, 4) when pd is null and fk % 17 = 4 then make_date(1950, 1, 1) "
        "else d end as s",
        "case when fk % 100 = 37 then null when ok % 123 = 0 and nd is not null then date_add(nd, 60) "
        "when ok % 159 = 0 and nd is not null then date_add(d, 15) else nd end as e",
    ).selectExpr(
        "*",
        "explode(concat("
        "array(named_struct('i', 0, 'pct', case when ck % 2 = 1 then 62.5D else 60.0D end - case when ok % 291 = 0 then 5.0D else 0.0D end, 'point', false),"
        " named_struct('i', 1, 'pct', case when ck % 2 = 1 then 37.5D else 40.0D end, 'point', false)),"
        "case when fk % 4 = 0 then array(named_struct('i', 2, 'pct', 0.0D, 'point', false)) else array() end,"
        "case when ok % 29 = 0 and fk % 100 <> 37 then array(named_struct('i', 0, 'pct', 60.0D, 'point', true)) else array() end"
        ")) as k",
    ).selectExpr(
        "fk", "ck", "ok", "field_name", "k.i as i", "round(k.pct / n, 4) as pct",
        "case when k.point then d else s end as s", "case when k.point then d else e end as e",
    )
    return rows.selectExpr(
        "field_name",
        "case when fk % 9 = 0 then 'ONSHORE' else 'OFFSHORE' end as on_offshore",
        "case when fk % 6 = 0 then 'CEASED' else 'PRODUCING' end as status",
        f"{COMPANY.format('15 * (fk div 10) + (ck - 15 * fk + i) % 15')} as company_name",
        "pct as interest_pct",
        "case when (i = 0 and fk % 8 <> 0) or (i = 2 and fk % 8 = 0) then 'Y' else 'N' end as operator_flag",
        "s as start_date", "e as end_date",
        "case when ok % 61 = 0 then 'Unknown' when e is null or ok % 43 = 0 then 'Current' "
        "else concat('Previous-', cast(year(s) - case when ok % 31 = 0 then 1 else 0 end as string), ' to ', cast(year(e) as string)) end as period_label",
    )


def field_traits(supplier: DataFrame) -> DataFrame:
    """How the ownership source spells each field."""
    return supplier.selectExpr(
        "s_suppkey as fk",
        "case when s_suppkey % 100 = 49 then 'retired' when s_suppkey % 7 = 3 then 'spelling' "
        "when s_suppkey % 11 = 5 then 'renamed' else 'same' end as trait",
    )


def aliases(supplier: DataFrame) -> DataFrame:
    return field_traits(supplier).where("trait = 'renamed'").selectExpr(
        f"{FIELD.format('fk')} as production_name", "concat('OLD FIELD ', cast(fk as string)) as equity_name"
    )


def subareas(customer: DataFrame) -> DataFrame:
    keyed = customer.selectExpr("c_custkey as c", "c_custkey div 10 as e", "c_mktsegment", "c_custkey % 10 as r").selectExpr(
        "*", "case when e % 5 = 2 or c % 4 = 3 then 50.0D else 60.0D end as p"
    )
    return keyed.selectExpr(
        "c as object_id",
        "cast(c div 6 as int) as licence_number",
        "concat('P', lpad(cast(c div 6 as string), 6, '0')) as licence_reference",
        "concat(cast(c div 30 as string), '/', cast(c % 30 as string)) as block_reference",
        "case when c % 3 = 0 then 'ALL' else concat('PART ', cast(c % 3 as string)) end as subarea_name",
        "case when c_mktsegment = 'BUILDING' then 'RELINQUISHED' else 'EXTANT' end as licence_status",
        "((c * 97) % 20000 - 3000) * 86400000 as start_ms",
        "case when c % 3 = 0 then null else ((c * 97) % 20000 + 1000) * 86400000 end as end_ms",
        f"case when c % 19 = 2 then 'N/A' else concat({COMPANY.format('e')}, ' (', cast(cast(p as int) as string), '%), ',"
        f" {COMPANY.format('e + 1')}, ' (', cast(cast(100 - p as int) as string), '%)') end as holder_text",
        "case when c % 23 = 5 then '' when e % 9 = 4 and r = 7 then 'GROUP OTHER' "
        "else concat('GROUP ', cast(e % 40 as string)) end as holder_group",
        "p as equity_pct",
        "concat('GROUP ', cast((e + c % 2) % 40 as string)) as operator_group",
        _rings("c"),
    )


def group_overrides(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        "cast(n_nationkey as int) as line_no",
        f"case when n_nationkey % 6 = 5 then ' ' else {COMPANY.format('(n_nationkey div 2) * 4')} end as entity",
        "concat('REVIEWED ', cast(n_nationkey % 5 as string)) as display_group",
        "'reviewed manual mapping' as basis",
        "case when n_nationkey % 7 = 3 then 'excluded' else 'approved' end as status",
    )


def episodes(orders: DataFrame) -> DataFrame:
    keyed = orders.selectExpr(
        "o_orderkey as o", "o_custkey as c", "o_orderstatus", "o_orderpriority",
        "cast(datediff(cast(o_orderdate as date), date '1970-01-01') - 11000 as bigint) as day",
    )
    return keyed.selectExpr(
        "o as object_id",
        "case when o_orderstatus = 'O' then 'N' else 'Y' end as history",
        "cast(c div 4 as double) as licence_number",
        "concat('P', lpad(cast(c div 4 as string), 6, '0')) as licence_reference",
        "concat(cast(c div 20 as string), '/', cast(c % 20 as string)) as block_reference",
        "o_orderpriority as licence_status",
        "case when o % 499 = 3 then null else day * 86400000 end as start_ms",
        "case when o_orderstatus = 'O' then null when o % 211 = 7 then (day - 1) * 86400000 "
        "else (day + o % 2000) * 86400000 end as end_ms",
        f"case when o % 307 = 11 then '  ' else {COMPANY.format('c')} end as licensee_names",
        "concat('GROUP ', cast(c % 25 as string)) as licensee_group",
        f"{COMPANY.format('c div 3')} as operator_names",
        "case when c % 31 = 0 then '' else concat('GROUP ', cast((c div 3) % 25 as string)) end as operator_group",
        f"{COMPANY.format('c div 2')} as admin_org",
        "concat('GROUP ', cast((c div 2) % 25 as string)) as admin_group",
        _rings("o"),
    )


def polygons(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "cast(s_suppkey as string) as field_no",
        "case when s_suppkey % 8 = 5 then concat('Field  ', lpad(cast(s_suppkey as string), 10, '0')) "
        "when s_suppkey % 8 = 6 then concat('LOST POLYGON ', cast(s_suppkey as string)) "
        f"else {FIELD.format('s_suppkey')} end as polygon_name",
        "case when s_nationkey < 12 then 'DETERMINED' else 'PROVISIONAL' end as determination_status",
        _rings("s_suppkey"),
    )


def landed_production(lineitem: DataFrame) -> DataFrame:
    """The reports with their day and year as stored columns, for landing by year: in narrow ranges of their date.

    The source rows are spread and sorted; the wide reports are made of them after that.
    """
    dated = lineitem.withColumn("year", F.year("l_shipdate"))
    spread = dated.repartitionByRange("year", "l_shipdate").sortWithinPartitions("year", "l_shipdate")
    return unit_production(spread, "year").withColumn("reported_on", F.col("reported_at").cast("date"))


def landed_pages(prod: DataFrame, rows_per_page: int = 2000, leftovers: bool = False) -> DataFrame:
    """Pages as an extract writes them, by offset, with their counts ``n``: full pages with the flag, then a short one without it.

    ``leftovers`` adds pages of an older, longer extract behind the last one.
    """
    pages = feature_pages(prod, rows_per_page, F.count("*").alias("n")).withColumnRenamed("page", "offset")
    end = feature_pages(prod, rows_per_page).agg(F.max("page")).scalar()
    pages = pages.withColumn("exceededTransferLimit", F.col("offset") < end)
    if leftovers:
        old = pages.where(F.col("offset") % 5 == 0).withColumn("offset", F.col("offset") + end + 1)
        pages = pages.unionByName(old.withColumn("exceededTransferLimit", F.lit(True)))
    return pages.select("offset", "exceededTransferLimit", "features", "n")


def feature_pages(prod: DataFrame, rows_per_page: int = 2000, *counts: Column) -> DataFrame:
    """Source rows packed into pages of a landed feature service answer, a bounded number per page."""
    attributes = F.struct("object_id", "field", "unit", "period", "oil_mbd")
    geometry = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))
    keyed = prod.select(
        F.floor(F.col("object_id") / rows_per_page).alias("page"), F.struct(
            attributes.alias("attributes"), geometry.alias("geometry")
        ).alias("feature"),
    )
    return keyed.groupBy("page").agg(
        F.collect_list("feature").alias("features"), F.lit(True).alias("exceededTransferLimit"), *counts
    )
