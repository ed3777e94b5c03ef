"""Coverage: how much of each month's production has a resolved owner.

Everything here starts from a (period, category) frame, whose size is bounded
by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as X
from ..functions.volumes import EQUITY_STREAMS, TOTAL

# fixed values: start months to assess and stability thresholds, in percent
STABILITY_THRESHOLDS = (95.0, 99.0, 99.5)

LIQUID_PAIR = ("oil_mbd", "condensate_mbd")
GAS_PAIR = ("dry_gas_mmscfd", "assoc_gas_mmscfd")


def by_category(resolved: DataFrame) -> DataFrame:
    """(period, stream, category) -> volume and number of field-months.

    The four streams are summed side by side and unpivoted after the shuffle.
    """
    wide = resolved.groupBy("period", "category").agg(
        F.count("*").alias("entries"), *[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS]
    )
    return wide.unpivot(["period", "category", "entries"], list(EQUITY_STREAMS), "stream", "volume")


def monthly(categories: DataFrame) -> DataFrame:
    """(period, stream) -> total, resolved, coverage percent and dominant excluded category.

    Coverage is null without volume. Of the excluded categories the one with
    most volume dominates, the smaller name on a tie.
    """
    resolved = F.col("category") == "resolved"
    largest = F.min(F.when(~resolved, F.struct((-F.col("volume")).alias("v"), "category")))
    sums = categories.groupBy("period", "stream").agg(
        F.sum("volume").cast(TOTAL).alias("total"),
        F.sum(F.when(resolved, F.col("volume")).otherwise(0)).cast(TOTAL).alias("resolved"),
        largest.alias("largest"),
    )
    return sums.select(
        "period", "stream", "total", "resolved",
        X.coverage_pct(F.col("resolved"), F.col("total")).alias("coverage_pct"),
        F.col("largest.category").alias("dominant_category"),
    )


def excluded(categories: DataFrame) -> DataFrame:
    return categories.where(F.col("category") != "resolved")


def coverage_levels(months: DataFrame) -> DataFrame:
    """Month, year and whole-history coverage in one frame, production-weighted at every level."""
    levels = months.select(
        "stream", "total", "resolved",
        F.explode(F.array(
            F.struct(F.lit("month").alias("level"), F.col("period").alias("label")),
            F.struct(F.lit("year").alias("level"), F.substring("period", 1, 4).alias("label")),
            F.struct(F.lit("all").alias("level"), F.lit("all").alias("label")),
        )).alias("l"),
    ).select("stream", "total", "resolved", "l.level", "l.label")
    sums = levels.groupBy("level", "label", "stream").agg(
        F.sum("total").cast(TOTAL).alias("total"), F.sum("resolved").cast(TOTAL).alias("resolved")
    )
    return sums.withColumn("coverage_pct", X.coverage_pct(F.col("resolved"), F.col("total")))


def excluded_totals(categories: DataFrame) -> DataFrame:
    return excluded(categories).groupBy("category", "stream").agg(
        F.round(F.sum("volume").cast(TOTAL), 4).alias("volume")
    )


def bucket_counts() -> list[Column]:
    pct = F.col("coverage_pct")
    return [
        F.count_if(pct >= X.FULL_COVERAGE).alias("at_100"),
        F.count_if((pct >= X.WARN_COVERAGE) & (pct < X.FULL_COVERAGE)).alias("from_99_5_to_100"),
        F.count_if((pct >= X.PUBLISH_COVERAGE) & (pct < X.WARN_COVERAGE)).alias("from_95_to_99_5"),
        F.count_if(pct < X.PUBLISH_COVERAGE).alias("below_95"),
    ]


def buckets(months: DataFrame) -> DataFrame:
    return months.where(F.col("coverage_pct").isNotNull()).groupBy("stream").agg(*bucket_counts())


def lowest_months(months: DataFrame, k: int = 10) -> DataFrame:
    w = Window.partitionBy("stream").orderBy("coverage_pct", "period")
    return (
        months.where(F.col("coverage_pct").isNotNull())
        .withColumn("position", F.row_number().over(w))
        .where(F.col("position") <= k)
    )


def from_starts(months: DataFrame, starts: list[str]) -> DataFrame:
    """Each month once per candidate start it falls under."""
    hits = F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: F.col("period") >= s)
    return months.withColumn("start_period", F.explode(hits))


def longest_run_below(months: DataFrame, keys: list[str], threshold: float = X.PUBLISH_COVERAGE) -> DataFrame:
    """Longest run of consecutive observed months under the threshold (0 when there is none)."""
    observed = months.where(F.col("coverage_pct").isNotNull())
    below = F.col("coverage_pct") < threshold
    w = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = observed.withColumn("run", F.sum(F.when(below, 0).otherwise(1)).over(w))
    lengths = runs.groupBy(*keys, "run").agg(F.count_if(below).alias("length"))
    return lengths.groupBy(*keys).agg(F.max("length").alias("longest_run_below"))


def window_statistics(months: DataFrame, starts: list[str]) -> DataFrame:
    """Candidate publication windows: overall, lowest and median coverage, buckets, longest run."""
    spread = from_starts(months, starts)
    overall = spread.groupBy("start_period", "stream").agg(
        F.sum("total").cast(TOTAL).alias("total"),
        F.sum("resolved").cast(TOTAL).alias("resolved"),
        F.min("coverage_pct").alias("lowest_pct"),
        F.median(F.round(F.col("coverage_pct") * 1000).cast("bigint")).alias("median_thousandths"),
        F.count("coverage_pct").alias("month_count"),
        *bucket_counts(),
    ).where("month_count > 0")
    runs = longest_run_below(spread, ["start_period", "stream"])
    return overall.join(runs, ["start_period", "stream"]).select(
        "start_period", "stream",
        X.coverage_pct(F.col("resolved"), F.col("total")).alias("overall_pct"),
        "lowest_pct", (F.floor(F.col("median_thousandths") + 0.5) / 1000).alias("median_pct"),
        "at_100", "from_99_5_to_100", "from_95_to_99_5", "below_95",
        "longest_run_below", "month_count",
    )


def stability_points(months: DataFrame, thresholds: tuple[float, ...] = STABILITY_THRESHOLDS) -> DataFrame:
    """First month after the last violation; null when the newest month still violates."""
    observed = months.where(F.col("coverage_pct").isNotNull()).withColumn(
        "threshold", F.explode(F.array(*[F.lit(t) for t in thresholds]))
    )
    violating = F.when(F.col("coverage_pct") < F.col("threshold"), F.col("period"))
    last_bad = Window.partitionBy("stream", "threshold")
    marked = observed.withColumn("last_violation", F.max(violating).over(last_bad))
    return marked.groupBy("stream", "threshold").agg(
        F.min(F.when(
            F.col("last_violation").isNull() | (F.col("period") > F.col("last_violation")), F.col("period")
        )).alias("stable_from")
    )


def breach_causes(months: DataFrame, threshold: float) -> DataFrame:
    """For the months under a threshold: how often each excluded category is the largest."""
    cause = F.coalesce("dominant_category", F.lit("unexplained")).alias("cause")
    return months.where(F.col("coverage_pct") < threshold).groupBy("stream", cause).agg(F.count("*").alias("months"))


def native_status(months: DataFrame) -> DataFrame:
    """(period, stream): status and coverage; the dominant excluded category where unavailable."""
    low = F.col("coverage_pct") < X.PUBLISH_COVERAGE
    return months.select(
        "period", "stream",
        X.stream_status(F.col("resolved"), F.col("total")).alias("status"), "coverage_pct",
        F.when(low, F.coalesce("dominant_category", F.lit("unknown"))).alias("dominant_category"),
    )


def _component_sums() -> list[Column]:
    def pair(column: str, streams: tuple[str, str], name: str) -> Column:
        part = F.when(F.col("stream").isin(*streams), F.col(column)).otherwise(0)
        return F.sum(part).cast(TOTAL).alias(name)

    return [
        pair("resolved", LIQUID_PAIR, "liquids_included"), pair("total", LIQUID_PAIR, "liquids_total"),
        pair("resolved", GAS_PAIR, "gas_included"), pair("total", GAS_PAIR, "gas_total"),
    ]


def components(months: DataFrame) -> DataFrame:
    """Per month: included and total volume of liquids and gas, summed and never averaged."""
    return months.groupBy("period").agg(*_component_sums())


def _rated(component_sums: DataFrame, *carried: str) -> DataFrame:
    c = component_sums.select(
        "*",
        X.component_status(F.col("liquids_included"), F.col("liquids_total")).alias("liquids_status"),
        X.coverage_pct(F.col("liquids_included"), F.col("liquids_total")).alias("liquids_pct"),
        X.component_status(F.col("gas_included"), F.col("gas_total")).alias("gas_status"),
        X.coverage_pct(F.col("gas_included"), F.col("gas_total")).alias("gas_pct"),
    )
    included = F.col("liquids_included") * 6 + F.col("gas_included")
    total = F.col("liquids_total") * 6 + F.col("gas_total")
    return c.select(
        "period", "liquids_status", "liquids_pct", "gas_status", "gas_pct",
        X.total_gate(F.col("liquids_status"), F.col("gas_status")).alias("total_status"),
        X.coverage_pct(included, total).alias("total_pct"), *carried,
    )


def derived_status(months: DataFrame) -> DataFrame:
    """One row per month: status and coverage of liquids, gas and their gated total."""
    return _rated(components(months))


def month_statuses(months: DataFrame) -> DataFrame:
    """Native and derived statuses of a month in one row, from one grouping."""
    status = X.stream_status(F.col("resolved"), F.col("total"))
    native = {
        f"{s}_{name}": F.max(F.when(F.col("stream") == s, value))
        for s in EQUITY_STREAMS for name, value in (("status", status), ("coverage_pct", F.col("coverage_pct")))
    }
    grouped = months.groupBy("period").agg(*_component_sums(), *[c.alias(n) for n, c in native.items()])
    return _rated(grouped, *native)
