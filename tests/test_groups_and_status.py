from helpers import one, rows
from pyspark.sql import functions as F

from stakeline.operators import attribution as A, checks as K, coverage as C, groups as G

FOUR = ("oil_mbd", "dry_gas_mmscfd", "assoc_gas_mmscfd", "condensate_mbd")


def resolved(spark, data):
    """(field, period, category, oil, dry)"""
    frame = spark.createDataFrame([(f, p, c, float(o), float(g), 0.0, 0.0) for f, p, c, o, g in data],
                                  "field string, period string, category string, " + ", ".join(f"{s} double" for s in FOUR))
    return frame.select("field", "period", "category", *[F.col(s).cast("decimal(18,3)").alias(s) for s in FOUR])


def months_of(spark, data):
    return C.monthly(C.by_category(resolved(spark, data)))


def coverage_months(spark, values):
    return spark.createDataFrame([("oil_mbd", p, v) for p, v in values], "stream string, period string, coverage_pct double")


def test_coverage_is_weighted_and_names_the_largest_cause(spark):
    months = months_of(spark, [("A", "202001", "resolved", 90, 0), ("B", "202001", "unmatched", 6, 0), ("C", "202001", "quarantined", 4, 0)])
    oil = months.where("stream = 'oil_mbd'").first()
    assert (oil["coverage_pct"], oil["dominant_category"]) == (90.0, "unmatched")
    status = {r["stream"]: r for r in C.native_status(months).collect()}
    assert (status["oil_mbd"]["status"], status["oil_mbd"]["dominant_category"]) == ("unavailable", "unmatched")
    # no gas at all: unavailable as a stream, not applicable as a component
    assert status["dry_gas_mmscfd"]["status"] == "unavailable"
    derived = one(C.derived_status(months))
    assert (derived["liquids_status"], derived["gas_status"], derived["total_status"]) == ("unavailable", "not_applicable", "unavailable")


def test_stability_recovers_then_drops_again(spark):
    months = coverage_months(spark, [("202001", 90.0), ("202002", 99.0), ("202003", 80.0), ("202004", 99.0), ("202005", None)])
    got = {r["threshold"]: r["stable_from"] for r in C.stability_points(months, (50.0, 95.0, 99.5)).collect()}
    assert got == {50.0: "202001", 95.0: "202004", 99.5: None}


def test_longest_run_ignores_months_without_coverage(spark):
    months = coverage_months(spark, [("202001", 90.0), ("202002", None), ("202003", 80.0), ("202004", 99.0), ("202005", 10.0)])
    assert rows(C.longest_run_below(months, ["stream"])) == [("oil_mbd", 2)]


def test_null_zero_and_absent(spark):
    months = months_of(spark, [("F", "202001", "resolved", 10, 6), ("G", "202001", "resolved", 5, 0),
                               ("F", "202002", "resolved", 10, 0), ("U", "202002", "unmatched", 90, 0)])
    facts = spark.createDataFrame(
        [("A", "F", "202001", 10.0, 6.0), ("A", "F", "202002", 10.0, 0.0), ("A", "G", "202001", 5.0, 0.0)],
        "company string, field string, period string, oil_mbd double, dry_gas_mmscfd double").select(
        "company", "field", "period", F.col("oil_mbd").cast("decimal(38,12)").alias("oil_mbd"),
        F.col("dry_gas_mmscfd").cast("decimal(38,12)").alias("dry_gas_mmscfd"),
        F.lit(0).cast("decimal(38,12)").alias("assoc_gas_mmscfd"), F.lit(0).cast("decimal(38,12)").alias("condensate_mbd"))
    series = A.owner_series(A.owner_months(facts), C.month_statuses(months))
    got = {(r["period"], r["stream"]): (None if r["value"] is None else float(r["value"]), r["status"]) for r in series.collect()}
    assert got["202001", "total_mboed"] == (16.0, "complete")
    assert got["202002", "liquids_mboed"] == (None, "unavailable")
    assert got["202002", "natural_gas_mboed"] == (0.0, "not_applicable")
    assert got["202002", "total_mboed"][0] is None
    grid = A.owner_field_series(facts, C.derived_status(months))
    filled = {(r["field"], r["period"]): r["total_mboed"] for r in grid.collect()}
    # G was not held in 202002: the month is unavailable for everybody, so null; gas is a known zero
    assert filled["G", "202002"] is None and len(filled) == 4
    assert float(filled["F", "202001"]) == 11.0


def test_grid_of_one_owner_with_most_fields_is_spread(spark):
    facts = spark.range(3000).selectExpr(
        "case when id % 10 < 9 then 'BIG' else concat('S', id) end as company", "concat('F', id) as field",
        "cast(202001 + id % 12 as string) as period", *[f"cast(1 as decimal(38,12)) as {s}" for s in A.EQUITY_STREAMS])
    months = spark.range(12).selectExpr("cast(202001 + id as string) as period", "'complete' as liquids_status",
                                        "'complete' as gas_status", "'complete' as total_status")
    grid = A.owner_field_series(facts, months)
    counts = dict(grid.groupBy("company").count().collect())
    assert counts["BIG"] == 2700 * 11 or counts["BIG"] == 2700 * 12
    part = F.pmod(F.xxhash64("field"), F.lit(256))
    sizes = [r["count"] for r in grid.where("company = 'BIG'").groupBy(part).count().collect()]
    assert len(sizes) > 200 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def points(spark, data):
    return spark.createDataFrame(data, "company string, period string, stream string, value double, status string").withColumn(
        "value", F.col("value").cast("decimal(18,3)"))


def test_group_with_missing_members(spark):
    series = points(spark, [
        ("A", "202001", "oil_mbd", 1.0, "complete"), ("B", "202001", "oil_mbd", 2.0, "complete"),
        ("A", "202002", "oil_mbd", 1.0, "complete"), ("B", "202002", "oil_mbd", None, "unavailable"),
        ("A", "202003", "oil_mbd", 1.0, "complete"), ("A", "202004", "oil_mbd", None, "unavailable"),
        ("A", "202005", "oil_mbd", 1.0, "warning"), ("B", "202005", "oil_mbd", 2.0, "complete")])
    members = spark.createDataFrame([("A", "G"), ("B", "G")], "entity string, grp string")
    grouped = G.group_series(series, members)
    got = {r["period"]: (None if r["value"] is None else float(r["value"]), r["status"]) for r in grouped.collect()}
    assert got == {"202001": (3.0, "complete"), "202002": (1.0, "partial"), "202003": (1.0, "partial"),
                   "202004": (None, "unavailable"), "202005": (3.0, "warning")}
    assert K.beyond(K.group_conservation(series, grouped)).count() == 0
    assert K.beyond(K.group_conservation(series, grouped.where("period <> '202001'"))).count() == 1


def test_mapping_precedence(spark):
    evidence = spark.createDataFrame([("A", "G1", 3), ("B", "G1", 1), ("B", "G2", 1), ("D", "G9", 1)], "entity string, grp string, rows bigint")
    overrides = spark.createDataFrame(
        [(1, "D", "OLD", "reviewed manual mapping", "approved"), (2, "D", "NEW", "reviewed manual mapping", "approved"),
         (3, " ", "X", "b", "approved")], "line_no int, entity string, display_group string, basis string, status string")
    entities = spark.createDataFrame([(e,) for e in "ABCD"], "entity string")
    mapping = G.build_mapping(entities, evidence, overrides)
    assert rows(mapping, "entity", "display_group", "status", "evidence") == [
        ("A", "G1", "approved", "evidence"), ("B", "B", "unresolved", "conflict"), ("C", "C", "unresolved", "none"),
        ("D", "NEW", "approved", "override")]
    assert rows(G.collapsed_entities(entities, mapping)) == [
        ("A", "G1"), ("B", G.UNRESOLVED), ("C", G.UNRESOLVED), ("D", "NEW")]


def test_breakdown_check(spark):
    groups = spark.createDataFrame([("G", "1", 3.0), ("G", "2", None), ("G", "3", 1.0)], "grp string, period string, total_mboed double")
    parts = spark.createDataFrame([("G", "1", 1.5), ("G", "1", 1.5), ("G", "2", 1.0), ("G", "3", 2.0)], "grp string, period string, total_mboed double")
    bad = K.parts_offenders(K.parts_against_group(groups, parts, F.lit(0.01)))
    assert [r[0] for r in rows(bad, "period")] == ["2", "3"]


def test_side_by_side_sums_give_the_same_group_series(spark):
    statuses = spark.createDataFrame([("202001", "complete"), ("202002", "unavailable"), ("202003", "warning")], "period string, s string")
    statuses = statuses.select("period", *[F.col("s").alias(f"{x}_status") for x in (*A.EQUITY_STREAMS, "liquids", "gas", "total")],
                               *[F.lit(99.0).alias(f"{x}_coverage_pct") for x in A.EQUITY_STREAMS],
                               *[F.lit(99.0).alias(f"{x}_pct") for x in ("liquids", "gas", "total")])
    volumes = spark.createDataFrame([("A", "202001", 1), ("B", "202001", 2), ("A", "202002", 3), ("C", "202003", 5)], "company string, period string, v int")
    volumes = volumes.select("company", "period", *[F.col("v").cast("decimal(38,12)").alias(s) for s in A.EQUITY_STREAMS])
    members = spark.createDataFrame([("A", "G"), ("B", "G"), ("C", "H")], "entity string, grp string")
    wide = A.owner_wide(volumes, statuses)
    slow = G.group_series(A.owner_series(volumes, statuses), members)
    fast = G.month_series(G.group_months(wide, members), members)
    assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, slow.select(fast.columns).collect()), key=repr)
    assert G.energy_months(G.group_months(wide, members)).count() == 3


def test_grid_is_laid_out_after_the_last_exchange_of_its_rows(spark):
    facts = spark.createDataFrame([("A", "F", "202001"), ("A", "G", "202002"), ("B", "F", "202002")], "company string, field string, period string").select(
        "company", "field", "period", *[F.lit(6).cast("decimal(38,12)").alias(s) for s in A.EQUITY_STREAMS])
    months = spark.createDataFrame([(p, "complete", "complete", "complete") for p in ("202001", "202002", "202003")],
                                   "period string, liquids_status string, gas_status string, total_status string")
    grid = A.owner_field_series(facts, months)
    got = {(r["company"], r["field"], r["period"]): float(r["total_mboed"]) for r in grid.collect()}
    assert got == {("A", "F", "202001"): 14.0, ("A", "F", "202002"): 0.0, ("A", "G", "202001"): 0.0, ("A", "G", "202002"): 14.0,
                   ("B", "F", "202002"): 14.0}
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and "Join LeftOuter" not in plan  # the owner's months and the statuses; facts never meet the grid


def test_group_months_are_hashed_and_not_sorted(spark):
    point = F.struct(F.lit(1).cast("decimal(18,3)").alias("value"), F.lit("warning").alias("status"), F.lit(97.0).alias("coverage_pct"))
    wide = spark.createDataFrame([("A", "202001"), ("B", "202001")], "company string, period string").select(
        "company", "period", *[point.alias(s) for s in A.STREAMS])
    months = G.group_months(wide, spark.createDataFrame([("A", "G"), ("B", "G")], "entity string, grp string"))
    assert "SortAggregate" not in months._jdf.queryExecution().executedPlan().toString()
    assert [r["total_mboed_status"] for r in months.collect()] == ["warning"]
    members = spark.createDataFrame([("A", "G")], "entity string, grp string")
    blank = wide.withColumn("oil_mbd", F.struct(F.col("oil_mbd.value").alias("value"), F.lit(None).cast("string").alias("status"), F.lit(0.0).alias("coverage_pct")))
    assert [r["oil_mbd_status"] for r in G.group_months(blank, members).collect()] == [None]
