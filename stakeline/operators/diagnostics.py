"""Profiles of the interval table itself, without production."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as X
from .intervals import micro_percent, percent_of
from .rows import one_row

POLICIES = ("A", "B", "C")


def zero_length(stakes: DataFrame) -> DataFrame:
    return stakes.where(F.col("start_date") == F.col("end_date"))


def lasting(stakes: DataFrame) -> DataFrame:
    return stakes.where(F.col("end_date").isNull() | (F.col("start_date") != F.col("end_date")))


def zero_length_neighbours(stakes: DataFrame) -> DataFrame:
    """Each zero-length row with the interval of the same pair that ends, or starts, on its date.

    Neighbours are reduced to one per (field, company, date) before the join;
    several on one date resolve to the earliest start, then the smallest percent.
    """
    rest = lasting(stakes)
    ending = rest.where(F.col("end_date").isNotNull()).groupBy(
        "field_name", "company_name", F.col("end_date").alias("start_date")
    ).agg(F.min(F.struct("start_date", "interest_pct")).alias("before"))
    starting = rest.groupBy("field_name", "company_name", "start_date").agg(F.min("interest_pct").alias("after_pct"))
    keys = ["field_name", "company_name", "start_date"]
    return (
        zero_length(stakes)
        .join(ending, keys, "left").join(starting, keys, "left")
        .withColumn("before_pct", F.col("before.interest_pct")).drop("before")
        .withColumn("category", X.zero_length_category(F.col("interest_pct"), F.col("before_pct"), F.col("after_pct")))
    )


def zero_length_profile(stakes: DataFrame) -> DataFrame:
    """Counts of zero-length rows by facet and value."""
    rows = zero_length_neighbours(stakes)
    pct = F.col("interest_pct")
    facets = {
        "category": F.col("category"),
        "year": F.date_format("start_date", "yyyy"),
        "date": F.date_format("start_date", "yyyy-MM-dd"),
        "interest": F.when(pct == 0, "zero").when(pct == 100, "hundred").otherwise("partial"),
        "operator_flag": F.col("operator_flag"),
        "status": F.col("status"),
        "on_offshore": F.col("on_offshore"),
    }
    return facet_counts(rows, facets)


def facet_counts(rows: DataFrame, facets: dict[str, Column]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("facet"), c.alias("value")) for n, c in facets.items()]))
    return rows.select(pairs.alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("rows"))


def most_common(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, smaller value first on equal counts."""
    return rows.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column).limit(k)


def policy_bounds() -> Column:
    """The row's start and end under each containment policy.

    A takes the dates, B leaves zero-length rows out, C follows the label's
    years where they disagree with the dates.
    """
    start, end = F.col("start_date"), F.col("end_date")
    first, last = X.label_years(F.col("period_label"))
    agrees = first.eqNullSafe(F.year(start)) & last.eqNullSafe(F.year(end))
    differs = first.isNotNull() & ~agrees
    c_start = F.when(differs, F.make_date(first, F.lit(1), F.lit(1))).otherwise(start)
    c_end = F.when(differs, F.make_date(last, F.lit(12), F.lit(31))).otherwise(end)
    return F.array(
        F.struct(F.lit("A").alias("policy"), start.alias("s"), end.alias("e"), F.lit(True).alias("used")),
        F.struct(F.lit("B").alias("policy"), start.alias("s"), end.alias("e"),
                 (end.isNull() | (start != end)).alias("used")),
        F.struct(F.lit("C").alias("policy"), c_start.alias("s"), c_end.alias("e"), F.lit(True).alias("used")),
    )


def next_start(day: Column) -> Column:
    """The first month start on or after a date."""
    return F.when(F.dayofmonth(day) == 1, day).otherwise(X.next_month(day))


def policy_events(stakes: DataFrame, parts: int | None = None) -> DataFrame:
    """(policy, field, company, month) with the changes in rows, percent and zero-length rows there.

    An interval is active from the first month start on or after its start up to the one on or after its end,
    so it is two changes, or none where the two are one. Rows are dealt by pair before they are taken apart, over
    ``parts`` partitions where given: the groups of a task and its sweep by company need no other exchange.
    """
    begin, over = next_start(F.col("p.s")), next_start(F.col("p.e"))
    pair = ["field_name", "company_name"]
    dealt = stakes.select(*pair, "interest_pct", "start_date", "end_date", "period_label").repartition(
        *([parts] if parts else []), *pair)
    rows = dealt.select(
        "field_name", "company_name", micro_percent(F.col("interest_pct")).alias("pct"),
        F.coalesce(F.col("start_date") == F.col("end_date"), F.lit(False)).cast("bigint").alias("points"),
        F.explode(policy_bounds()).alias("p"),
    ).where("p.used").select(
        "field_name", "company_name", "p.policy", "pct", "points", begin.alias("begin"), over.alias("over"),
    ).where(F.col("over").isNull() | (F.col("begin") < F.col("over")))
    change = F.explode(F.array_compact(F.array(
        F.struct(F.col("begin").alias("month"), F.lit(1).alias("sign")),
        F.when(F.col("over").isNotNull(), F.struct(F.col("over").alias("month"), F.lit(-1).alias("sign"))),
    ))).alias("c")
    return rows.select("policy", "field_name", "company_name", "pct", "points", change).groupBy(
        "policy", "field_name", "company_name", F.col("c.month").alias("month")
    ).agg(
        F.sum("c.sign").alias("rows"), F.sum(F.col("c.sign") * F.col("pct")).alias("pct"),
        F.sum(F.col("c.sign") * F.col("points")).alias("points"),
    )


def policy_steps(stakes: DataFrame, latest_month: str, parts: int | None = None) -> DataFrame:
    """(policy, field) as a step function: the active sum and flags from ``month`` up to ``until``.

    Steps cover the months from each field's first one to the latest. Two sweeps make them: along a company's own
    changes, which shows where it holds several rows at a time, then along those of all companies of the field. A
    sweep runs over distinct months, a number that the calendar bounds, and no interval is laid out.
    """
    last = F.lit(latest_month).cast("date")
    company = Window.partitionBy("policy", "field_name", "company_name").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    held = F.sum("rows").over(company)
    by_company = policy_events(stakes, parts).select(
        "policy", "field_name", "month", "rows", "pct", "points",
        ((held > 1).cast("bigint") - (held - F.col("rows") > 1).cast("bigint")).alias("several"),
    )
    firsts = stakes.groupBy("field_name").agg(X.month_floor(F.min("start_date")).alias("first_month")).where(
        F.col("first_month") <= last)
    none = F.lit(0).cast("bigint")
    opened = firsts.select(
        F.explode(F.array(*[F.lit(p) for p in POLICIES])).alias("policy"), "field_name", F.col("first_month").alias("month"),
        none.alias("rows"), none.alias("pct"), none.alias("points"), none.alias("several"), "first_month")
    changes = by_company.withColumn("first_month", F.lit(None).cast("date")).unionByName(opened).groupBy(
        "policy", "field_name", "month"
    ).agg(*[F.sum(c).alias(c) for c in ("rows", "pct", "points", "several")], F.max("first_month").alias("first_month"))
    field = Window.partitionBy("policy", "field_name").orderBy("month")
    upto = field.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy("policy", "field_name").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    run = {c: F.sum(c).over(upto) for c in ("rows", "pct", "points", "several")}
    steps = changes.select(
        "policy", "field_name", F.greatest("month", F.max("first_month").over(every)).alias("month"),
        F.least(F.coalesce(F.lead("month").over(field), X.next_month(last)), X.next_month(last)).alias("until"),
        F.max("first_month").over(every).alias("first_month"), *[c.alias(n) for n, c in run.items()],
    ).where(F.col("first_month").isNotNull() & (F.col("month") < F.col("until")))
    active = F.col("rows") > 0
    return steps.select(
        "policy", "field_name", "month", "until", F.col("rows").alias("active_rows"),
        F.when(active, percent_of(F.col("pct"))).alias("sum_pct"),
        (active & (F.col("several") > 0)).alias("repeats"), (active & (F.col("points") > 0)).alias("zero_length_active"),
    )


def policy_grid(steps: DataFrame) -> DataFrame:
    """(policy, field, month): the steps read at every month."""
    months = F.explode(F.sequence("month", F.add_months("until", -1), F.expr("interval 1 month"))).alias("month_start")
    return steps.select("policy", "field_name", months, "active_rows", "sum_pct", "repeats", "zero_length_active")


def policy_comparison(steps: DataFrame) -> DataFrame:
    """Field-months by policy and outcome: a step counts its months."""
    months = F.months_between("until", "month").cast("bigint")
    active = F.col("active_rows") > 0
    off = F.abs(F.col("sum_pct") - 100) > X.SUM_TOLERANCE
    over = F.col("sum_pct") > 100 + X.SUM_TOLERANCE
    count = lambda hit: F.sum(F.when(hit, months).otherwise(0))
    return steps.groupBy("policy").agg(
        F.sum(months).alias("field_months"),
        count(~active).alias("none_active"),
        count(active & ~off).alias("sum_ok"),
        count(active & off & over).alias("sum_over"),
        count(active & off & ~over).alias("sum_under"),
        count(active & F.col("repeats")).alias("repeated_company_months"),
        count(active & F.col("zero_length_active")).alias("zero_length_active_months"),
    )


def worst_sums(steps: DataFrame, policy: str = "A", k: int = 15) -> DataFrame:
    """Largest distances from 100 percent; by field and month on equal distance.

    The first ``k`` months lie in the first ``k`` steps, since the steps of a field don't overlap.
    """
    off = F.round("sum_pct", 2)
    order = [F.desc(F.abs(F.col("sum_pct") - 100)), "field_name"]
    first = (
        steps.where((F.col("policy") == policy) & (F.abs(F.col("sum_pct") - 100) > X.SUM_TOLERANCE))
        .select("policy", "field_name", "month", "until", off.alias("sum_pct"), "active_rows", "repeats", "zero_length_active")
        .orderBy(*order, "month").limit(k)
    )
    return policy_grid(first).select("field_name", "month_start", "sum_pct", "active_rows").orderBy(*order, "month_start").limit(k)


def future_only_fields(stakes: DataFrame, latest_month: str) -> DataFrame:
    firsts = stakes.groupBy("field_name").agg(X.month_floor(F.min("start_date")).alias("first_month"))
    return firsts.where(F.col("first_month") > F.lit(latest_month).cast("date"))


def label_disagrees() -> Column:
    """Whether a label contradicts the dates of its row."""
    label = F.coalesce("period_label", F.lit(""))
    kind = X.label_kind(label)
    first, last = X.label_years(label)
    wrong_current = (kind == "current") & F.col("end_date").isNotNull()
    return wrong_current | ((kind == "previous") & ~(
        first.eqNullSafe(F.year("start_date")) & last.eqNullSafe(F.year("end_date"))
    ))


def label_audit(stakes: DataFrame) -> DataFrame:
    """Label forms, and labels that disagree with the dates."""
    kind = X.label_kind(F.coalesce("period_label", F.lit("")))
    return stakes.agg(
        F.count("*").alias("total_rows"),
        F.count_if(kind == "current").alias("current_form"),
        F.count_if(kind == "previous").alias("previous_form"),
        F.count_if(kind == "other").alias("other_form"),
        F.count_if(label_disagrees()).alias("mismatches"),
    )


def operator_zero_rows(stakes: DataFrame) -> DataFrame:
    return stakes.where((F.col("interest_pct") == 0) & (F.col("operator_flag") == "Y"))


def zero_interest_probe(stakes: DataFrame) -> DataFrame:
    """Zero-interest operator rows by (field, company, start, end), judged by the positive interests of their fields.

    ``n`` equal rows; ``covered_by_other``: another company's positive interest overlaps them; ``positive_elsewhere``:
    their own company holds one in the field at some time. Only fields that have such rows are looked at: their positive
    rows are counted by date, for each company and for the field as a whole, and one pass of running totals answers
    both. Overlaps are counted as begun before my end minus over by my start; a zero-length row counts for a
    lasting one that strictly contains its date.
    """
    far = F.lit("9999-12-31").cast("date")
    probes = operator_zero_rows(stakes).groupBy(
        "field_name", "company_name", "start_date", F.coalesce("end_date", far).alias("probe_end")).agg(F.count("*").alias("n"))
    fields = operator_zero_rows(stakes).select("field_name").distinct()
    positive = stakes.where(F.col("interest_pct") > 0).join(fields, "field_name", "left_semi")
    point = F.coalesce(F.col("start_date") == F.col("end_date"), F.lit(False))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    event = lambda d, begun, points, over: F.struct(
        d.alias("d"), begun.alias("begun"), points.alias("points"), over.alias("over"))
    dated = positive.select("field_name", "company_name", F.explode(F.array_compact(F.array(
        event(F.col("start_date"), F.when(point, zero).otherwise(one), F.when(point, one).otherwise(zero), zero),
        F.when(~point & F.col("end_date").isNotNull(), event(F.col("end_date"), zero, zero, one)),
    ))).alias("e")).groupBy("field_name", "company_name", "e.d").agg(*[F.sum(f"e.{c}").alias(c) for c in ("begun", "points", "over")])
    # an owner is a company, or the field as a whole
    owners = F.explode(F.array(F.concat(F.lit("="), F.col("company_name")), F.lit(""))).alias("owner")
    asked = probes.select("field_name", owners, F.col("start_date"), F.col("probe_end")).select(
        "field_name", "owner", F.explode(F.array("start_date", "probe_end")).alias("d"))
    events = dated.select("field_name", owners, "d", "begun", "points", "over").unionByName(
        asked.select("field_name", "owner", "d", zero.alias("begun"), zero.alias("points"), zero.alias("over"))
    ).groupBy("field_name", "owner", "d").agg(*[F.sum(c).alias(c) for c in ("begun", "points", "over")])
    upto = Window.partitionBy("field_name", "owner").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy("field_name", "owner").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = events.select(
        "field_name", "owner", "d", (F.sum("begun").over(upto) - F.col("begun")).alias("begun_before"), F.sum("over").over(upto).alias("over_by"),
        (F.sum("points").over(upto) - F.col("points")).alias("points_before"), F.sum("points").over(upto).alias("points_by"),
        F.sum(F.col("begun") + F.col("points")).over(every).alias("ever"))
    keys = ["field_name", "company_name", "start_date", "probe_end"]
    lookups = probes.select(*keys, "n", owners).select(*keys, "n", "owner", F.explode(F.array(
        F.struct(F.col("start_date").alias("d"), F.lit(False).alias("ends")),
        F.struct(F.col("probe_end").alias("d"), F.lit(True).alias("ends")))).alias("q")).select(*keys, "n", "owner", "q.d", "q.ends")
    found = lookups.join(totals, ["field_name", "owner", "d"])
    whole = F.col("owner") == ""
    at = lambda own, ends, c: F.max(F.when((whole != F.lit(own)) & (F.col("ends") == ends), F.col(c)))
    overlaps = lambda own: at(own, True, "begun_before") - at(own, False, "over_by") + F.greatest(
        at(own, True, "points_before") - at(own, False, "points_by"), F.lit(0))
    return found.groupBy(*keys, "n").agg(
        (overlaps(False) > overlaps(True)).alias("covered_by_other"),
        (F.max(F.when(~whole, F.col("ever"))) > 0).alias("positive_elsewhere"))


def covered_by_others(stakes: DataFrame) -> DataFrame:
    """Zero-interest operator rows, flagged when another company's positive interest overlaps them."""
    flags = zero_interest_probe(stakes).drop("n", "positive_elsewhere")
    rows = operator_zero_rows(stakes).withColumn("probe_end", F.coalesce("end_date", F.lit("9999-12-31").cast("date")))
    return rows.join(flags, ["field_name", "company_name", "start_date", "probe_end"]).select(*stakes.columns, "covered_by_other")


def positive_elsewhere(stakes: DataFrame) -> DataFrame:
    """Zero-interest operator rows whose company holds a positive interest in the field at some time."""
    positive = stakes.where(F.col("interest_pct") > 0).select("field_name", "company_name")
    return operator_zero_rows(stakes).join(positive, ["field_name", "company_name"], "left_semi")


def zero_interest_profile(stakes: DataFrame) -> DataFrame:
    zero = F.col("interest_pct") == 0
    flagged = zero & (F.col("operator_flag") == "Y")
    is_open = F.col("end_date").isNull()
    counts = stakes.agg(
        F.count_if(zero).alias("zero_rows"),
        F.count_if(flagged).alias("operator_rows"),
        F.count_if(zero & is_open).alias("zero_open"),
        F.count_if(zero & ~is_open).alias("zero_closed"),
        F.count_if(flagged & is_open).alias("operator_open"),
        F.count_if(flagged & ~is_open).alias("operator_closed"),
    )
    counted = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.col("n"))), F.lit(0)).alias(flag)
    judged = zero_interest_probe(stakes).agg(counted("covered_by_other"), counted("positive_elsewhere"))
    return one_row(counts, judged).withColumn("not_covered", F.col("operator_rows") - F.col("covered_by_other"))


def future_dated(stakes: DataFrame, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    return stakes.where(F.col("start_date") >= F.make_date(F.year(day) + 1, F.lit(1), F.lit(1)))


def open_peers(stakes: DataFrame, as_of: str) -> DataFrame:
    """Per field: all rows, and rows open and already started at the date."""
    day = F.lit(as_of).cast("date")
    return stakes.groupBy("field_name").agg(
        F.count("*").alias("field_rows"),
        F.count_if(F.col("end_date").isNull() & (F.col("start_date") <= day)).alias("open_started"),
    )


def future_profile(stakes: DataFrame, as_of: str) -> DataFrame:
    """Rows that begin in a later year, with counts of the field's other rows.

    Counts stand in for lists of peers, which would pair every row of a field
    with every other.
    """
    return future_dated(stakes, as_of).join(open_peers(stakes, as_of), "field_name").select(
        *stakes.columns,
        (F.col("field_rows") - 1).alias("peer_rows"),
        F.col("open_started").alias("open_peers"),
        (F.col("open_started") > 0).alias("overlaps_open"),
    )


def open_ended_by_field(stakes: DataFrame, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    is_open = F.col("end_date").isNull()
    current = is_open & (F.col("start_date") <= day)
    by_company = stakes.groupBy("field_name", "company_name").agg(
        F.count_if(is_open).alias("open_rows"),
        F.count_if(is_open & (F.col("interest_pct") > 0)).alias("open_positive"),
        F.count_if(current).alias("current_rows"),
        F.sum(F.when(current, micro_percent(F.col("interest_pct")))).alias("current_pct"),
    )
    return by_company.groupBy("field_name").agg(
        F.sum("open_rows").alias("open_rows"),
        F.sum("open_positive").alias("open_positive"),
        (F.max("open_rows") > 1).alias("company_repeats"),
        F.sum("current_rows").alias("current_rows"),
        percent_of(F.sum("current_pct")).alias("current_pct"),
    )


def open_ended_profile(stakes: DataFrame, as_of: str) -> DataFrame:
    active = F.col("current_rows") > 0
    off = F.abs(F.col("current_pct") - 100) > X.SUM_TOLERANCE
    return open_ended_by_field(stakes, as_of).agg(
        F.sum("open_rows").alias("open_rows"),
        F.count_if(F.col("open_rows") > 0).alias("fields_with_open"),
        F.count_if(F.col("open_positive") > 1).alias("fields_with_several_open_positive"),
        F.count_if("company_repeats").alias("fields_with_repeated_company"),
        F.count_if(active & ~off).alias("current_sum_ok"),
        F.count_if(active & off).alias("current_sum_off"),
        F.count_if(~active).alias("no_current_row"),
    )


def interval_schema_report(stakes: DataFrame) -> DataFrame:
    """Rows, distinct names, date ranges and flag counts, as one row."""
    pairs = stakes.groupBy("field_name", "company_name").agg(
        F.count("*").alias("n"),
        F.min("start_date").alias("s0"), F.max("start_date").alias("s1"),
        F.min("end_date").alias("e0"), F.max("end_date").alias("e1"),
        F.count_if(F.col("end_date").isNull()).alias("open"),
        F.count_if(F.year("start_date") < X.SENTINEL_YEAR).alias("sentinel"),
        F.count_if(F.col("interest_pct") == 0).alias("zero"),
    )
    fields = pairs.select("field_name").distinct().agg(F.count("*").alias("field_count"))
    companies = pairs.select("company_name").distinct().agg(F.count("*").alias("company_count"))
    totals = pairs.agg(
        F.sum("n").alias("row_count"),
        F.date_format(F.min("s0"), "yyyy-MM-dd").alias("start_min"),
        F.date_format(F.max("s1"), "yyyy-MM-dd").alias("start_max"),
        F.date_format(F.min("e0"), "yyyy-MM-dd").alias("end_min"),
        F.date_format(F.max("e1"), "yyyy-MM-dd").alias("end_max"),
        F.sum("open").alias("open_rows"), F.sum("sentinel").alias("sentinel_rows"), F.sum("zero").alias("zero_rows"),
    )
    return one_row(totals, fields, companies)


def recency_order(stakes: DataFrame) -> DataFrame:
    """Position of each row within its field: current rows by start, then closed rows by end, newest first;
    zero-length rows are numbered apart.

    Positions come from counting newer dates, so only distinct dates are ordered per field.
    """
    kind = F.when(F.coalesce(F.col("start_date") == F.col("end_date"), F.lit(False)), "event").otherwise("interval")
    is_open = F.col("end_date").isNull()
    ordered = stakes.withColumn("kind", kind).withColumn("is_open", is_open).withColumn(
        "sort_date", F.when(is_open | (F.col("kind") == "event"), F.col("start_date")).otherwise(F.col("end_date"))
    )
    keys = ordered.groupBy("field_name", "kind", "is_open", "sort_date").agg(F.count("*").alias("n"))
    w = Window.partitionBy("field_name", "kind").orderBy(F.desc("is_open"), F.desc("sort_date")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = keys.select("field_name", "kind", "is_open", "sort_date",
                        (F.coalesce(F.sum("n").over(w), F.lit(0)) + 1).alias("position"))
    return ordered.join(ranks, ["field_name", "kind", "is_open", "sort_date"]).select(
        *stakes.columns, "kind", "position"
    )
