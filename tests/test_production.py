from helpers import classification, one, production, rows
from pyspark.sql import functions as F

from stakeline.functions import volumes
from stakeline.operators import production as P, ranking as R


def histories(spark, data, listed=()):
    classified = P.classify(production(spark, data), classification(spark, listed))
    return classified, P.field_history(classified)


def test_plain_field(spark):
    classified, history = histories(spark, [dict(
        oil_mbd=39.687384, assoc_gas_mmscfd=12.7663725, dry_gas_mmscfd=0.0, condensate_mbd=0.0, water_mbd=267.973708666667)])
    got = one(history)
    assert [float(got[k]) for k in ("oil_mbd", "natural_gas_mboed", "total_mboed", "water_mbd")] == [39.687, 2.128, 41.815, 267.974]


def test_storage_unit_is_left_out_everywhere(spark):
    data = [dict(unit="ROUGH", dry_gas_mmscfd=25.439, lon=1.0), dict(unit="ROUGH STORAGE", dry_gas_mmscfd=999.0, lon=50.0)]
    classified, history = histories(spark, data, [("ALPHA", "ROUGH STORAGE", "storage")])
    latest = one(P.field_latest(classified))
    assert (latest["unit_count"], latest["storage_unit_count"]) == (1, 1)
    assert [float(latest[k]) for k in ("oil_mbd", "dry_gas_mmscfd", "natural_gas_mboed", "lon")] == [0.0, 25.439, 4.24, 1.0]
    assert float(one(history)["dry_gas_mmscfd"]) == 25.439
    counters = one(P.exclusion_counters(classified))
    assert (counters["production_row_count"], counters["storage_row_count"]) == (1, 1)


def test_storage_only_field_is_dropped_but_counted(spark):
    classified, history = histories(spark, [dict(unit="S")], [("ALPHA", "S", "storage")])
    assert history.count() == 0 and P.field_latest(classified).count() == 0
    assert one(P.exclusion_counters(classified))["storage_only_field_count"] == 1


def test_rename_is_one_series_with_two_spans(spark):
    classified, history = histories(spark, [
        dict(unit="SEAN", period="202401", oil_mbd=1.0), dict(unit="NORTH SEAN", period="202402", oil_mbd=2.0)])
    assert [r[0] for r in rows(history, "period")] == ["202401", "202402"]
    assert rows(P.handover_chain(P.unit_spans(classified)), "position", "unit") == [(1, "SEAN"), (2, "NORTH SEAN")]


def test_current_operator_is_the_last_production_months_first_row(spark):
    classified, history = histories(spark, [
        dict(period="202401", operator="OLD", oil_mbd=1.0), dict(period="202402", operator="NEW", oil_mbd=2.0, object_id=5),
        dict(period="202402", operator="OTHER", oil_mbd=2.0, object_id=9)])
    assert one(P.current_attributes(classified))["operator"] == "NEW"
    rolled = P.operator_history(history, P.current_attributes(classified))
    assert [(o, p, float(v)) for o, p, v in rows(rolled, "operator", "period", "oil_mbd")] == [("NEW", "202401", 1.0), ("NEW", "202402", 4.0)]


def test_missing_operator_stops(spark):
    classified, history = histories(spark, [dict(operator=None, oil_mbd=1.0)])
    try:
        P.operator_history(history, P.current_attributes(classified)).collect()
    except Exception as error:
        assert "without operator" in str(error)
    else:
        raise AssertionError("no error")


def test_sum_of_sixths_on_a_rounding_boundary(spark):
    # eight fields whose gas adds up to exactly 1920.645: a sixth is 320.1075 and rounds up
    data = [dict(field=f"F{i}", unit=f"F{i}", dry_gas_mmscfd=v) for i, v in enumerate([240.08, 240.08, 240.08, 240.08, 240.08, 240.08, 240.08, 240.085])]
    classified, history = histories(spark, data)
    assert float(one(P.country_history(history))["natural_gas_mboed"]) == 320.108


def test_annual_average_skips_unknown_months_and_peak_needs_twelve(spark):
    data = [(f"2024{m:02d}", 10.0 + m) for m in range(1, 13)] + [("202501", 999.0), ("202502", None)]
    series = spark.createDataFrame(data, "period string, total_mboed double").selectExpr(
        "period", "cast(total_mboed as decimal(18,3)) total_mboed")
    means = {r["year"]: float(r["total_mboed"]) for r in P.annual_average(series, [], ["total_mboed"]).collect()}
    assert means == {"2024": 16.5, "2025": 999.0}
    assert one(P.peak_year(series))["year"] == "2024"
    assert rows(P.partial_year(series)) == [("2025", 2)]


def test_year_ago_is_by_date(spark):
    series = spark.createDataFrame([("202401", 1.0), ("202501", 2.0), ("202503", 3.0)], "period string, total_mboed double")
    assert rows(P.year_ago(series), "period", "before_mboed") == [("202401", None), ("202501", 1.0), ("202503", None)]


def test_rank_uses_last_known_value_and_drops_unknown(spark):
    series = spark.createDataFrame(
        [("a", "202401", 5.0), ("a", "202402", None), ("b", "202402", 3.0), ("c", "202402", None), ("d", "202402", 1.0)],
        "k string, period string, v double").selectExpr("k", "period", "cast(v as decimal(18,3)) v")
    got = {(r["label"], r["period"]): r["v"] for r in R.top_n_direct(series, "k", "v", 2, "rest").collect()}
    assert {k: None if v is None else float(v) for k, v in got.items()} == {
        ("a", "202401"): 5.0, ("a", "202402"): None, ("b", "202402"): 3.0, ("rest", "202402"): 1.0}


def test_storage_tripwire(spark):
    prod = production(spark, [dict(unit="X Storage"), dict(unit="Y INJECTION"), dict(unit="Z")])
    assert rows(P.storage_like(prod, classification(spark, [("ALPHA", "Y INJECTION", "production")]))) == [("ALPHA", "X Storage")]


def test_attribute_notes(spark):
    classified, _ = histories(spark, [dict(unit="A", region="N"), dict(unit="B", region="S"), dict(unit="C", region=None)])
    assert rows(P.attribute_notes(classified), "attribute", "distinct_values", "first_value") == [("region", 3, "<null>")]


def test_published_sum_rounds_as_the_exact_sum(spark):
    groups = [[0.0005], [-0.0005], [0.0015, -0.001], [-0.0015], [1.0005, -2.001], [0.00049999], [-0.00050001], [None], [None, 2.0], [-0.25, 0.2495],
              [1e9 + 0.0005], [-1e9 - 0.0005], [0.1] * 10, [-3.7] * 7, [1e-9] * 500, [-0.0004995, -0.0000005], [0.9999999996], [-1.0], [0.0]]
    frame = spark.createDataFrame([(i, v) for i, g in enumerate(groups) for v in g], "k int, v double")
    both = frame.groupBy("k").agg(volumes.round3(volumes.exact_sum(F.col("v"))).alias("a"), volumes.published_sum(F.col("v")).alias("b"))
    assert both.schema["a"].dataType == both.schema["b"].dataType
    assert [(r["k"], r["a"]) for r in both.collect()] == [(r["k"], r["b"]) for r in both.collect()] and both.count() == len(groups)
