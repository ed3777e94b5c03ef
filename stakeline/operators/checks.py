"""Data checks. Each returns the offending rows; a build stops when any frame is not empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, EQUITY_STREAMS, GAS_MMSCF_PER_MBOE, NATIVE_STREAMS, TOTAL
from .production import FULL
from .rows import one_row

# fixed values: allowed differences
REPARTITION_TOLERANCE = 0.01
EXACT_TOLERANCE = 1e-4
FORMULA_TOLERANCE = 0.01
GROUP_TOLERANCE = 1e-6
# fixed values: geographic bounds in degrees
LON_BOUNDS = (-14.0, 5.0)
LAT_BOUNDS = (48.0, 63.0)
# fixed values: words no column name of a percentage-free table may contain
PERCENT_WORDS = ("equity", "pct", "percent", "share")


class CheckFailed(RuntimeError):
    """A check found offenders; nothing may be published."""


def require_empty(offenders: DataFrame, what: str, shown: int = 20) -> None:
    """Raises with a few offenders; reads at most ``shown`` + 1 rows to the driver."""
    rows = offenders.limit(shown + 1).collect()
    if rows:
        more = "" if len(rows) <= shown else " and more"
        raise CheckFailed(f"{what}: " + "; ".join(str(r.asDict()) for r in rows[:shown]) + more)


def contract_differences(schema: StructType, contract: str) -> list[tuple[str, str, str | None]]:
    """(column, expected type, actual type) for contract columns that are missing or have another type."""
    actual = {f.name: f.dataType.simpleString() for f in schema.fields}
    return [
        (f.name, f.dataType.simpleString(), actual.get(f.name))
        for f in StructType.fromDDL(contract).fields if actual.get(f.name) != f.dataType.simpleString()
    ]


def require_contract(frame: DataFrame, contract: str, what: str) -> DataFrame:
    """The frame itself, or an error naming every column that breaks the contract."""
    wrong = contract_differences(frame.schema, contract)
    if wrong:
        raise CheckFailed(f"{what}: " + "; ".join(f"{n} is {a or 'missing'}, expected {e}" for n, e, a in wrong))
    return frame


def negatives(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per negative value.

    The negative columns of a row are filtered in place and only those are
    exploded, so a clean table produces no intermediate rows.
    """
    found = F.filter(
        F.array(*[F.struct(F.lit(v).alias("column_name"), F.col(v).cast("double").alias("value")) for v in values]),
        lambda p: p["value"] < 0,
    )
    return rows.select(*keys, F.explode(found).alias("p")).select(*keys, "p.*")


def count_difference(left: DataFrame, expected: Column) -> DataFrame:
    counted = left.agg(F.count("*").alias("counted")).withColumn("expected", expected)
    return counted.where(F.col("counted") != F.col("expected"))


def column_totals(frame: DataFrame, values: dict[str, str], name: str) -> DataFrame:
    """(stream, <name>): whole-table sums, unpivoted after they are one row; plus the row count."""
    sums = frame.agg(F.count("*").alias("n"), *[F.sum(c).cast(TOTAL).alias(s) for s, c in values.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("stream"), F.col(s).alias(name)) for s in values]))
    return sums.select(F.col("n").alias(f"{name}_rows"), pairs.alias("p")).select("p.*", f"{name}_rows")


def conservation(left: DataFrame, right: DataFrame, values: dict[str, str]) -> DataFrame:
    """Both whole-table sums per stream, with their gap. ``values`` maps stream -> column."""
    zero = F.lit(0).cast(TOTAL)
    pair = column_totals(left, values, "left_total").join(column_totals(right, values, "right_total"), "stream")
    return pair.withColumn(
        "gap", F.abs(F.coalesce("left_total", zero) - F.coalesce("right_total", zero)).cast("double")
    )


def native_conservation(history: DataFrame, operators: DataFrame) -> DataFrame:
    return conservation(history, operators, {s: s for s in NATIVE_STREAMS}).withColumn(
        "tolerance", F.lit(REPARTITION_TOLERANCE)
    )


def exact_conservation(history: DataFrame, operators: DataFrame) -> DataFrame:
    """Before any rounding: liquids and undivided gas, which every derived stream is made of."""
    return conservation(history, operators, {s: s for s in FULL}).withColumn("tolerance", F.lit(EXACT_TOLERANCE))


def rounded_conservation(history: DataFrame, operators: DataFrame) -> DataFrame:
    gaps = conservation(history, operators, {s: s for s in DERIVED_STREAMS})
    return gaps.withColumn(
        "tolerance", X.rounding_tolerance(F.col("left_total_rows"), F.col("right_total_rows"))
    )


def beyond(gaps: DataFrame) -> DataFrame:
    return gaps.where(F.col("gap") > F.col("tolerance"))


def formula_offenders(rows: DataFrame, keys: list[str], tolerance: float = FORMULA_TOLERANCE) -> DataFrame:
    """Published equivalents that cannot be recomputed from the published streams."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    liq = known("oil_mbd") + known("condensate_mbd")
    gas = (known("dry_gas_mmscfd") + known("assoc_gas_mmscfd")) / float(GAS_MMSCF_PER_MBOE)
    expected = {"liquids_mboed": liq, "natural_gas_mboed": gas, "total_mboed": liq + gas}
    missing = F.lit(False)
    for s in expected:
        missing = missing | F.col(s).isNull()
    wrong = F.lit(False)
    for s, value in expected.items():
        wrong = wrong | (F.abs(F.col(s).cast("double") - value) > tolerance)
    reason = F.when(missing, "missing").when(wrong, "formula")
    return rows.select(*keys, reason.alias("reason")).where(F.col("reason").isNotNull())


def out_of_bounds(points: DataFrame) -> DataFrame:
    inside = F.col("lon").between(*LON_BOUNDS) & F.col("lat").between(*LAT_BOUNDS)
    return points.where(~inside)


def interval_offenders(stakes: DataFrame) -> DataFrame:
    """Rows of the interval table that break a rule, with the first rule broken."""
    pct = F.col("interest_pct")
    reason = (
        F.when(F.coalesce("field_name", F.lit("")) == "", "field name missing")
        .when(F.coalesce("company_name", F.lit("")) == "", "company name missing")
        .when(pct.isNull(), "percentage missing")
        .when((pct < 0) | (pct > 100) | F.isnan(pct), "percentage out of range")
        .when(F.col("start_date").isNull(), "start missing")
        .when(F.col("end_date") < F.col("start_date"), "end before start")
    )
    return stakes.withColumn("reason", reason).where(F.col("reason").isNotNull())


def interest_sums(resolved: DataFrame) -> DataFrame:
    """Field-months whose interests add up, fall short or exceed."""
    mismatch = F.col("category") == "e1_sum_mismatch"
    return resolved.agg(
        F.count_if(F.col("category") == "resolved").alias("passing"),
        F.count_if(mismatch & (F.col("positive_sum") < 100)).alias("below_100"),
        F.count_if(mismatch & (F.col("positive_sum") >= 100)).alias("above_100"),
    )


def quarantine_summary(resolved: DataFrame) -> DataFrame:
    held = resolved.where(F.col("category") == "quarantined")
    by_field = held.groupBy("field").agg(
        F.count("*").alias("n"), F.min("period").alias("lo"), F.max("period").alias("hi"),
        *[F.sum(s).alias(s) for s in EQUITY_STREAMS],
    )
    return by_field.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("field_months"), F.count("*").alias("field_count"),
        F.min("lo").alias("first_period"), F.max("hi").alias("last_period"),
        *[F.round(F.coalesce(F.sum(s), F.lit(0)), 4).alias(s) for s in EQUITY_STREAMS],
    )


def quarantined_but_attributed(resolved: DataFrame, attributed: DataFrame) -> DataFrame:
    """Attributed rows of any field that is quarantined in some month of the window."""
    held = resolved.where(F.col("category") == "quarantined").select("field").distinct()
    return attributed.join(held, "field", "left_semi")


def uncategorised(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("category").isNull())


def date_order(stakes: DataFrame) -> DataFrame:
    """Rows, rows that end before they start, and zero-length rows (allowed, counted)."""
    return stakes.agg(
        F.count("*").alias("rows_checked"),
        F.count_if(F.col("start_date") > F.col("end_date")).alias("start_after_end"),
        F.count_if(F.col("start_date") == F.col("end_date")).alias("zero_length"),
    )


def attribution_conservation(resolved: DataFrame, attributed: DataFrame) -> DataFrame:
    """(period, stream): resolved volume against attributed volume, within half a percent."""
    def by_period(frame: DataFrame, name: str) -> DataFrame:
        sums = frame.groupBy("period").agg(*[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS])
        return sums.unpivot(["period"], list(EQUITY_STREAMS), "stream", name)

    expected = by_period(resolved.where(F.col("category") == "resolved"), "expected")
    actual = by_period(attributed, "actual")
    zero = F.lit(0).cast(TOTAL)
    gap = F.abs(F.col("expected") - F.coalesce("actual", zero)).cast("double")
    allowed = F.greatest(F.lit(0.001), F.col("expected").cast("double") * X.SUM_TOLERANCE / 100.0)
    return expected.join(actual, ["period", "stream"], "left").select(
        "period", "stream", "expected", F.coalesce("actual", zero).alias("actual"),
        gap.alias("gap"), allowed.alias("tolerance"),
    )


def group_conservation(entity_series: DataFrame, group_series: DataFrame) -> DataFrame:
    """Per stream: entities against groups over the whole history."""
    def totals(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy("stream").agg(F.coalesce(F.sum("value"), F.lit(0)).cast(TOTAL).alias(name))

    pair = totals(entity_series, "left_total").join(totals(group_series, "right_total"), "stream", "full_outer")
    zero = F.lit(0).cast(TOTAL)
    return pair.select(
        "stream", "left_total", "right_total",
        F.abs(F.coalesce("left_total", zero) - F.coalesce("right_total", zero)).cast("double").alias("gap"),
        F.lit(GROUP_TOLERANCE).alias("tolerance"),
    )


def parts_against_group(groups: DataFrame, parts: DataFrame, tolerance: Column) -> DataFrame:
    """(grp, period): the group's own total against its fields' totals; null must meet null."""
    added = parts.groupBy("grp", "period").agg(
        F.sum("total_mboed").cast(TOTAL).alias("parts_total"), F.count("total_mboed").alias("parts_known")
    )
    known = F.coalesce("parts_known", F.lit(0)) > 0
    gap = F.abs(
        F.col("total_mboed") - F.coalesce("parts_total", F.lit(0).cast(TOTAL))
    ).cast("double")
    return groups.join(added, ["grp", "period"], "left").select(
        "grp", "period", "total_mboed", "parts_total", gap.alias("gap"),
        (F.col("total_mboed").isNull() & known).alias("null_against_value"),
        tolerance.alias("tolerance"),
    )


def parts_offenders(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("null_against_value") | (F.col("gap") > F.col("tolerance")))


def fields_against_country(history: DataFrame, country: DataFrame) -> DataFrame:
    """Per month: sum of published field totals against the published country total."""
    fields = history.groupBy("period").agg(
        F.sum("total_mboed").cast(TOTAL).alias("fields_total"), F.count("*").alias("field_rows")
    )
    rows = history.agg(F.count("*")).scalar()
    months = country.agg(F.count("*")).scalar()
    whole = country.select("period", F.col("total_mboed").alias("country_total"))
    return fields.join(whole, "period", "left").select(
        "period", "fields_total", "country_total",
        F.abs(F.col("fields_total") - F.col("country_total")).cast("double").alias("gap"),
        X.rounding_tolerance(rows, months).alias("tolerance"),
    )


def country_offenders(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("country_total").isNull() | (F.col("gap") > F.col("tolerance")))


def country_parts(country: DataFrame, tolerance: float = FORMULA_TOLERANCE) -> DataFrame:
    parts = F.coalesce("liquids_mboed", F.lit(0)) + F.coalesce("natural_gas_mboed", F.lit(0))
    gap = F.abs(F.col("total_mboed") - parts).cast("double")
    return country.withColumn("gap", gap).where(F.col("total_mboed").isNull() | (gap > tolerance))


def missing_rings(shapes: DataFrame) -> DataFrame:
    return shapes.where(F.coalesce(F.size("rings"), F.lit(0)) <= 0)


def missing_centroid(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("lon").isNull() | F.col("lat").isNull())


def episode_date_offenders(entries: DataFrame) -> DataFrame:
    reason = F.when(F.col("start_date").isNull(), "start missing").when(
        F.col("end_date") < F.col("start_date"), "end before start"
    )
    return entries.withColumn("reason", reason).where(F.col("reason").isNotNull())


def unnamed_licensees(entries: DataFrame) -> DataFrame:
    return entries.where(F.trim(F.coalesce("licensee_names", F.lit(""))) == "")


def percentage_columns(columns: list[str]) -> list[str]:
    """Output columns whose name suggests an ownership percentage."""
    return [c for c in columns if any(word in c.lower() for word in PERCENT_WORDS)]


def percentage_keys(entries: DataFrame) -> DataFrame:
    """Over every published feature: property names that suggest an ownership percentage."""
    keys = F.json_object_keys(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    hits = F.filter(keys, lambda k: F.lower(k).rlike("|".join(PERCENT_WORDS)))
    return entries.select(F.size(hits).alias("hits")).agg(
        F.lit("ownership").alias("words"), F.count("*").alias("features"),
        F.coalesce(F.sum(F.col("hits").cast("bigint")), F.lit(0)).alias("offending"),
    )


def build_metadata(prod: DataFrame, stakes: DataFrame | None = None) -> DataFrame:
    """The counts a build is compared by, as one row."""
    newest = prod.select(F.max("period")).scalar()
    fields = prod.withColumn("newest", F.col("period") == newest).groupBy("field").agg(
        F.count("*").alias("n"), F.count_if("newest").alias("now"), F.max("period").alias("hi")
    )
    meta = fields.agg(
        F.sum("now").alias("record_count"),
        F.count_if(F.col("now") > 0).alias("field_count"),
        F.sum("n").alias("history_record_count"),
        F.count("*").alias("history_field_count"),
        F.max("hi").alias("latest_period"),
    )
    return meta if stakes is None else one_row(meta, stakes.agg(F.count("*").alias("interval_count")))


# fixed values: check name, column, direction and allowed change in percent
BUILD_LIMITS = (
    ("record count", "record_count", "either", 20.0),
    ("field count", "field_count", "drop", 10.0),
    ("history record count", "history_record_count", "either", 20.0),
    ("history field count", "history_field_count", "drop", 10.0),
    ("interval count", "interval_count", "either", 10.0),
)


def build_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """One row per comparison of two one-row metadata frames; skipped when there is no previous build."""
    shared = [limit for limit in BUILD_LIMITS if limit[1] in current.columns and limit[1] in previous.columns]
    old = previous.select(*[F.col(c).alias(f"old_{c}") for c in previous.columns])
    both = one_row(old, current, missing_ok=True)

    def verdict(name: str, column: str, direction: str | None, limit: float) -> Column:
        before, now = F.col(f"old_{column}").cast("double"), F.col(column).cast("double")
        usable = F.when(before != 0, before)
        if direction is None:
            change, failed, skipped = F.lit(None).cast("double"), now < before, before.isNull()
        else:
            gap = usable - now if direction == "drop" else F.abs(now - usable)
            change = gap / usable * 100
            failed, skipped = change > limit, change.isNull()
        outcome = F.when(skipped, "skipped").when(failed, "failed").otherwise("passed")
        return F.struct(
            F.lit(name).alias("check"), before.alias("before"), now.alias("now"),
            F.round(change, 6).alias("change_pct"), outcome.alias("outcome"),
        )

    checks = [verdict(*limit) for limit in shared]
    checks.append(verdict("latest period", "latest_period", None, 0.0))
    return both.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def title_changed(previous: DataFrame, current: DataFrame) -> DataFrame:
    """The current source title where it is not the previous one."""
    before = previous.select("source_title").scalar()
    return current.withColumn("previous_title", before).where(
        ~F.col("source_title").eqNullSafe(F.col("previous_title"))
    )


def table_changes(before: DataFrame, after: DataFrame, keys: list[str], ignore: tuple[str, ...] = ("built_at",)) -> DataFrame:
    """Rows new, gone or changed between two builds of a table, whatever the ignored columns hold."""
    values = [c for c in after.columns if c not in keys and c not in ignore]
    old = before.select(*keys, F.struct(*values).alias("old"), F.lit(True).alias("in_old"))
    new = after.select(*keys, F.struct(*values).alias("new"), F.lit(True).alias("in_new"))
    kind = (
        F.when(F.col("in_old").isNull(), "new").when(F.col("in_new").isNull(), "gone")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return old.join(new, keys, "full_outer").select(*keys, kind.alias("change")).where(F.col("change").isNotNull())


RANGES = 1024


def key_range(keys: list[str]) -> Column:
    """One of ``RANGES`` ranges of hashed keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(RANGES))


def range_digests(rows: DataFrame, keys: list[str], ignore: tuple[str, ...] = ("built_at",)) -> DataFrame:
    """``range, rows, digest``: a digest of each range of keys that does not depend on the order of rows; kept with a build.

    At most ``RANGES`` rows. Null values are hashed by a mark, because a hash of several columns passes over nulls.
    """
    values = [F.col(c) for c in sorted(rows.columns) if c not in ignore]
    own = F.xxhash64(*[x for v in values for x in (v, v.isNull())])
    other = F.xxhash64(F.lit("other"), *[x for v in values for x in (v, v.isNull())])
    return rows.groupBy(key_range(keys).alias("range")).agg(
        F.count("*").alias("rows"), F.bit_xor(own).alias("digest"), F.sum(F.pmod(other, F.lit(1 << 31))).alias("sum"))


def changes_by_digest(before: DataFrame, after: DataFrame, before_digests: DataFrame, after_digests: DataFrame, keys: list[str],
                      ignore: tuple[str, ...] = ("built_at",)) -> DataFrame:
    """``table_changes`` of the ranges whose digests differ; equal builds are told apart by their digests alone."""
    marked = lambda digests: digests.select("range", F.struct("rows", "digest", "sum").alias("d"))
    both = marked(before_digests).withColumnRenamed("d", "was").join(marked(after_digests).withColumnRenamed("d", "now"), "range", "full")
    ranges = [r["range"] for r in both.where(~F.col("was").eqNullSafe(F.col("now"))).select("range").collect()]  # RANGES at most
    differing = key_range(keys).isin(ranges) if ranges else F.lit(False)
    return table_changes(before.where(differing), after.where(differing), keys, ignore)


def titled(meta: DataFrame, title: Column | str) -> DataFrame:
    """A build's metadata with the title that its source carried."""
    return meta.withColumn("source_title", title if isinstance(title, Column) else F.lit(title))


def title_change(previous: DataFrame, current: DataFrame) -> DataFrame:
    """``previous_title, source_title, outcome`` of a build against the metadata of the one before.

    ``first run`` where there is no metadata, ``no title`` where the source has none now, else ``unchanged`` or ``changed``.
    """
    was = previous.agg(F.count("*").alias("builds"), F.max("source_title").alias("previous_title"))
    outcome = (
        F.when(F.col("source_title").isNull(), "no title").when(F.col("builds") == 0, "first run")
        .when(F.col("previous_title").eqNullSafe(F.col("source_title")), "unchanged").otherwise("changed"))
    return one_row(was, current.select("source_title")).select("previous_title", "source_title", outcome.alias("outcome"))


def schema_fingerprint(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """sha256 over the sorted (name, type) pairs of a frame's schema."""
    pairs = spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in frame.schema.fields], "name string, type string"
    )
    text = F.to_json(F.array_sort(F.collect_list(F.struct("name", "type"))))
    return pairs.agg(F.sha2(text, 256).alias("fingerprint"), F.count("*").alias("columns"))
