import pytest
from pyspark.sql import functions as F

from stakeline.functions import scalars as X
from stakeline.functions.volumes import exact_sum, round3


def values(spark, column, items, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("v"))).collect()]


def test_slugify(spark):
    assert values(spark, X.slugify, ["  Brent A [pt of BRENT] ", "O'Neil & Co."]) == ["brent-a-pt-of-brent", "o-neil-co"]
    with pytest.raises(Exception, match="no slug"):
        values(spark, X.slugify, ["***"])


def test_normalize_name_folds_variants_only(spark):
    got = values(spark, X.normalize_name, ["  alpha \t  beta ", "ALPHA–BETA", "O’NEIL", "VIKING A [pt of VIKING]", "A B"])
    assert got == ["ALPHA BETA", "ALPHA-BETA", "O'NEIL", "VIKING A [PT OF VIKING]", "A B"]


def test_period_input(spark):
    items = ["202401", "2024-01", "2024/01", "2024 01", "2024", "202413", "x", " 2024-12 "]
    assert values(spark, lambda c: X.normalize_period_input(c, "start"), items) == [
        "202401", "202401", "202401", "202401", "202401", None, None, "202412"]
    assert values(spark, lambda c: X.normalize_period_input(c, "end"), ["2024"]) == ["202412"]


def test_period_formatting(spark):
    assert values(spark, X.period_long, ["202606", "bad"]) == ["June 2026", "bad"]
    assert values(spark, X.period_short, ["202606"]) == ["Jun 2026"]


def test_epoch_before_1970(spark):
    assert values(spark, X.epoch_date, [-86400000, 0, None], "bigint") == ["1969-12-31", "1970-01-01", None]
    assert values(spark, X.epoch_iso, [0], "bigint") == ["1970-01-01T00:00:00Z"]


def test_holder_split_and_tie(spark):
    got = values(spark, X.split_holders, ["NAME (85%), NAME2 (15.5%)", "junk, B (2%)", None, "C (1.2.3%)"])
    assert [[tuple(h) for h in g] for g in got] == [[("NAME", 85.0), ("NAME2", 15.5)], [("B", 2.0)], [], []]
    frame = spark.createDataFrame([("A (50%), B (50%)", 50.0), ("A (60%), B (40%)", 40.0), ("A (60%)", None)], "t string, p double")
    assert [r[0] for r in frame.select(X.row_holder(F.col("t"), F.col("p"))).collect()] == [None, "B", None]


def test_statuses(spark):
    frame = spark.createDataFrame(
        [(99.5, 100.0), (99.4, 100.0), (95.0, 100.0), (94.9, 100.0), (0.0, 0.0)], "r double, t double")
    got = frame.select(X.component_status(F.col("r"), F.col("t")), X.stream_status(F.col("r"), F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        ("complete", "complete"), ("warning", "warning"), ("warning", "warning"), ("unavailable", "unavailable"),
        ("not_applicable", "unavailable")]


@pytest.mark.parametrize("a,b,expected", [
    ("complete", "complete", "complete"), ("complete", "warning", "warning"), ("unavailable", "complete", "unavailable"),
    ("not_applicable", "warning", "warning"), ("not_applicable", "not_applicable", "not_applicable"),
    ("not_applicable", "unavailable", "unavailable")])
def test_total_gate(spark, a, b, expected):
    assert spark.range(1).select(X.total_gate(F.lit(a), F.lit(b))).first()[0] == expected


def test_owner_value_null_zero_or_sum(spark):
    got = values(spark, lambda s: X.owner_value(s, F.lit(2.5)).cast("double"), ["unavailable", "not_applicable", "warning"])
    assert got == [None, 0.0, 2.5]


def test_rounding_is_decimal_half_up(spark):
    frame = spark.createDataFrame([(0.0005,), (-0.0005,), (0.0025,), (-0.0001,)], "v double")
    got = [float(r[0]) for r in frame.select(round3(F.col("v").cast("decimal(28,12)"))).collect()]
    assert got == [0.001, -0.001, 0.003, 0.0]


def test_exact_sum_ignores_order_and_nulls(spark):
    items = [0.1] * 10 + [None, 1e6, 39.687384, 0.000000001]
    frame = spark.createDataFrame([(v,) for v in items], "v double")
    assert str(frame.agg(exact_sum(F.col("v"))).first()[0]) == "1000040.687384001000"
    assert frame.where("v > 1e9").agg(exact_sum(F.col("v"))).first()[0] == 0


def test_tolerance(spark):
    col = spark.range(1).select(X.rounding_tolerance(F.lit(134294), F.lit(20000))).first()[0]
    assert col == pytest.approx(X.rounding_tolerance_value(134294, 20000)) and col < 3.0


def test_change_badge(spark):
    frame = spark.createDataFrame([(110.0, 100.0), (90.0, 100.0), (100.0, 100.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in frame.select(X.change_badge(F.col("a"), F.col("b"))).collect()] == ["up", "down", "flat", None, None]
