import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from helpers import day, history, one, rows, stakes
from pyspark.sql import functions as F

from stakeline.operators import checks as K, diagnostics as D, intervals as I, matching as M
from stakeline.plans.store import stored_in_buckets

TODAY = "2026-09-01"


def names(spark, items, column):
    return spark.createDataFrame([(i,) for i in items], f"{column} string")


def match(spark, left, right, aliases=()):
    return M.match_names(names(spark, left, "field"), names(spark, right, "equity_field"),
                         spark.createDataFrame(list(aliases), "production_name string, equity_name string"))


def resolved(spark, months, intervals):
    hist, st = history(spark, months), stakes(spark, intervals)
    matches = hist.select("field").distinct().select("field", F.col("field").alias("equity_field"), F.lit("exact").alias("method"))
    first, last = I.window_of(hist)
    return I.resolve(hist, matches, st, TODAY, first, last), st, (first, last)


def category(spark, month, intervals, *, others=()):
    frame, _, _ = resolved(spark, [("F", month), *others], intervals)
    return frame.where(F.col("period") == month).first()["category"]


def test_cascade(spark):
    got = match(spark, ["A", "B–C", "D", "E"], ["A", "B-C", "OLD D", "Z"], [("D", "OLD D")])
    assert rows(got) == [("A", "A", "exact"), ("B–C", "B-C", "normalized"), ("D", "OLD D", "alias"), ("E", None, None)]
    assert rows(M.unmatched_right(got, names(spark, ["A", "B-C", "OLD D", "Z"], "equity_field"))) == [("Z",)]


def test_ambiguous_key_is_refused_and_nothing_is_fuzzy(spark):
    assert rows(match(spark, ["A B"], ["a  b", "a b", "A BB"])) == [("A B", None, None)]


def test_two_left_names_may_share_one_right_name(spark):
    assert rows(match(spark, ["a  b", "A  B"], ["A B"])) == [("A  B", "A B", "normalized"), ("a  b", "A B", "normalized")]


@pytest.mark.parametrize("aliases,text", [([("A", "X"), ("A", "Y")], "more than one alias"), ([("A", "GONE")], "does not exist")])
def test_bad_aliases_stop(spark, aliases, text):
    with pytest.raises(Exception, match=text):
        match(spark, ["A"], ["X", "Y"], aliases).collect()


@pytest.mark.parametrize("month,intervals,expected", [
    ("202003", [("F", "A", 100, "2020-03-15", None)], "month_start_boundary"),
    ("202004", [("F", "A", 100, "2020-03-15", None)], "resolved"),
    ("202003", [("F", "A", 100, "2020-01-01", "2020-03-20")], "resolved"),
    ("202004", [("F", "A", 100, "2020-01-01", "2020-03-20")], "genuine_interval_gap"),
    ("202003", [("F", "A", 100, "2020-01-01", "2020-03-01"), ("F", "A", 100, "2020-03-01", None)], "resolved"),
    ("202003", [("F", "A", 100, "2020-01-01", None), ("F", "A", 100, "2020-02-01", None)], "quarantined"),
    ("202003", [("F", "A", 60, "2020-01-01", None), ("F", "B", 60, "2020-01-01", None)], "quarantined"),
    ("202003", [("F", "A", 100, "2020-01-01", None), ("F", "B", 0, "2020-01-01", None), ("F", "B", 0, "2020-02-01", None)], "quarantined"),
    ("202003", [("F", "A", 90, "2020-01-01", None)], "e1_sum_mismatch"),
    ("202003", [("F", "A", 99.5, "2020-01-01", None)], "resolved"),
    ("202003", [("F", "A", 100.5, "2020-01-01", None)], "resolved"),
    ("202003", [("F", "A", 0, "2020-01-01", None)], "e1_sum_mismatch"),
    ("202003", [("F", "A", 100, "2020-02-01", "2020-02-01"), ("F", "A", 100, "2021-01-01", None)], "genuine_interval_gap"),
    ("202003", [("F", "A", 100, "2021-01-01", None)], "pre_equity_history"),
    ("202003", [("F", "A", 100, "2050-01-04", None)], "future_only"),
    ("202003", [("OTHER", "A", 100, "2020-01-01", None)], "no_equity_history"),
])
def test_categories(spark, month, intervals, expected):
    assert category(spark, month, intervals, others=[("F", "201912"), ("F", "202106")]) == expected


def test_unmatched(spark):
    hist = history(spark, [("F", "202003")])
    frame = I.resolve(hist, match(spark, ["F"], ["G"]), stakes(spark, [("G", "A", 100, "2020-01-01", None)]), TODAY, *I.window_of(hist))
    assert frame.first()["category"] == "unmatched"


def test_attribution_and_conservation(spark):
    frame, st, window = resolved(spark, [("F", "202003", 10.0), ("G", "202003", 5.0)], [
        ("F", "A", 60, "2020-01-01", None), ("F", "B", 40, "2020-01-01", None), ("F", "C", 0, "2020-01-01", None, "Y"),
        ("G", "A", 50, "2020-01-01", None)])
    att = I.attribute(frame, I.month_layout(st, *window))
    assert [(c, float(v)) for c, v in rows(att, "company", "oil_mbd")] == [("A", 6.0), ("B", 4.0)]
    assert K.beyond(K.attribution_conservation(frame, att)).count() == 0
    assert K.beyond(K.attribution_conservation(frame, att.where("company = 'A'"))).count() == 1
    assert {k: v for k, v in one(K.interest_sums(frame)).items()} == {"passing": 1, "below_100": 1, "above_100": 0}


def brute(months, intervals):
    """Month sheets: walking day by day, an interval is entered on the sheet of each month it is in force on the first of."""
    sheets, begun = defaultdict(list), defaultdict(list)
    for f, company, share, start, end, *_ in intervals:
        at, stop = day(start), day(end) if end else date(2031, 1, 1)
        begun[f].append(at)
        while at < stop:
            if at.day == 1:
                sheets[f, f"{at:%Y%m}"].append((company, share))
            at += timedelta(days=1)

    def empty_sheet(f, period):
        opening = min(f"{b:%Y%m}" for b in begun[f])
        if period < opening:
            return "future_only" if opening > "202609" else "pre_equity_history"
        started = [b.day for b in begun[f] if f"{b:%Y%m}" == period]
        return "month_start_boundary" if max(started, default=1) > 1 else "genuine_interval_gap"

    def judged(f, period):
        sheet = sheets[f, period]
        if not sheet:
            return empty_sheet(f, period) if begun[f] else "no_equity_history"
        off = sum(share for _, share in sheet) - 100
        if off > 0.5 or len(dict(sheet)) != len(sheet):
            return "quarantined"
        return "resolved" if off >= -0.5 else "e1_sum_mismatch"
    return {key: judged(*key) for key in months}


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_resolution_equals_brute_force(spark, partitions):
    rng = random.Random(7)

    def some_day():
        return f"{rng.randint(2018, 2021)}-{rng.randint(1, 12):02d}-{rng.choice([1, 1, 15, 28]):02d}"

    months = [(f"F{i}", f"{y}{m:02d}") for i in range(8) for y in (2018, 2019, 2020, 2021) for m in range(1, 13) if rng.random() < 0.8]
    intervals = []
    for i in range(7):
        for _ in range(rng.randint(1, 12)):
            start = some_day()
            end = rng.choice([None, max(start, some_day()), start])
            intervals.append((f"F{i}", f"C{rng.randint(0, 3)}", rng.choice([0, 25, 50, 100]), start, end))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame, _, _ = resolved(spark, months, intervals)
        got = {(r["field"], r["period"]): r["category"] for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(months, intervals)
    assert len(set(got.values())) >= 6


def test_stored_layout_is_read_without_an_exchange(spark):
    intervals = [(f"F{i % 9}", f"C{i % 4}", 25, f"20{10 + i % 9}-0{1 + i % 9}-1{i % 3}", None if i % 3 else f"20{14 + i % 9}-01-01") for i in range(80)]
    months = [(f"F{i}", f"20{y}0{m}") for i in range(9) for y in (12, 15, 18) for m in (1, 4)]
    hist, st = history(spark, months), stakes(spark, intervals)
    window = I.window_of(hist)
    layout = stored_in_buckets(spark, ("test", "layout"), "layout", lambda: I.month_layout(st, *window), ["equity_field", "month_start"])
    plain = I.month_layout(st, *window)
    facts = I.month_facts(layout)
    assert "Exchange" not in facts._jdf.queryExecution().executedPlan().toString()
    assert rows(facts) == rows(I.month_facts(plain))
    matches = hist.select("field").distinct().select("field", F.col("field").alias("equity_field"), F.lit("exact").alias("method"))
    found = I.resolve(hist, matches, st, TODAY, *window, layout=layout)
    assert rows(found) == rows(I.resolve(hist, matches, st, TODAY, *window))
    wide = found.withColumn("category", F.lit("resolved")).hint("merge")
    joined = I.attribute(wide, layout)
    assert rows(joined) == rows(I.attribute(wide, plain)) and joined.count() > 0
    above = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    scan = above[:above.index("layout_")].splitlines()
    depth = scan[-1].index("FileScan")
    for line in reversed(scan[:-1]):  # from the stored side up to the join that it meets
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            assert "Exchange" not in line
            if "Join" in line:
                break


def test_overlap_counting_equals_pairs(spark):
    rng = random.Random(3)
    data = []
    for _ in range(120):
        s = date(2020, rng.randint(1, 12), rng.randint(1, 28))
        e = rng.choice([None, s, date(2021, rng.randint(1, 12), 1)])
        data.append((f"F{rng.randint(0, 2)}", f"C{rng.randint(0, 2)}", rng.choice([0, 0, 30]), s.isoformat(), None if e is None else e.isoformat(), "Y"))
    got = rows(D.covered_by_others(stakes(spark, data)).where("covered_by_other"), "field_name", "company_name", "start_date", "end_date")
    far = date(9999, 12, 31)
    want = sorted(
        ((f, c, day(s), day(e)) for f, c, p, s, e, _ in data if p == 0 and any(
            f2 == f and c2 != c and p2 > 0 and day(s2) < (day(e) or far) and day(s) < (day(e2) or far)
            for f2, c2, p2, s2, e2, _ in data)), key=repr)
    assert got == want and want


def test_zero_length_categories(spark):
    data = [
        ("F", "A", 50, "2020-01-01", "2020-06-01"), ("F", "A", 50, "2020-06-01", "2020-06-01"), ("F", "A", 50, "2020-06-01", None),
        ("F", "B", 10, "2020-06-01", "2020-06-01"), ("F", "B", 20, "2020-06-01", None),
        ("F", "C", 10, "2020-01-01", "2020-06-01"), ("F", "C", 10, "2020-06-01", "2020-06-01"),
        ("F", "D", 10, "2020-06-01", "2020-06-01")]
    got = rows(D.zero_length_neighbours(stakes(spark, data)), "company_name", "category")
    assert got == [("A", "boundary_duplicate"), ("B", "boundary_transition"), ("C", "termination_marker"), ("D", "standalone_snapshot")]


def test_policies_a_and_b_agree(spark):
    steps = D.policy_steps(stakes(spark, [("F", "A", 100, "2020-01-01", "2020-03-01"), ("F", "A", 100, "2020-02-01", "2020-02-01")]), "2020-04-01")
    got = {r["policy"]: r.asDict() for r in D.policy_comparison(steps).collect()}
    for p in "AB":
        assert (got[p]["field_months"], got[p]["sum_ok"], got[p]["none_active"]) == (4, 2, 2)


def test_sweep_equals_every_interval_at_every_month(spark):
    rng = random.Random(8)
    last, data = date(2021, 3, 1), []
    for _ in range(160):
        s = date(rng.randint(2018, 2021), rng.randint(1, 12), rng.choice([1, 1, 9, 28]))
        e = rng.choice([None, s, s + timedelta(days=rng.randint(1, 700))])
        label = rng.choice(["Current", "?", f"Previous-{s.year - 1} to {s.year + 1}", f"Previous-{s.year} to {s.year}"])
        data.append((f"F{rng.randint(0, 3)}", f"C{rng.randint(0, 3)}", rng.choice([0, 25, 50, 100]), s.isoformat(), e and e.isoformat(), "N", label))
    used = []
    for f, c, p, s, e, _, label in data:
        s, e = day(s), day(e) if e else None
        used.append(("A", f, c, p, s, e, s == e))
        if s != e:
            used.append(("B", f, c, p, s, e, False))
        if label.startswith("Previous"):
            first, until = int(label[9:13]), int(label[17:21])
            if (first, until) != (s.year, e and e.year):
                used.append(("C", f, c, p, date(first, 1, 1), date(until, 12, 31), s == e))
                continue
        used.append(("C", f, c, p, s, e, s == e))
    want = []
    for policy in "ABC":
        for f in sorted({r[0] for r in data}):
            month = min(day(r[3]) for r in data if r[0] == f).replace(day=1)
            while month <= last:
                held = [r for r in used if r[:2] == (policy, f) and r[4] <= month and (r[5] is None or month < r[5])]
                want.append((policy, f, month, len(held), sum(r[3] for r in held) if held else None,
                             len({r[2] for r in held}) < len(held), any(r[6] for r in held)))
                month = date(month.year + month.month // 12, month.month % 12 + 1, 1)
    steps = D.policy_steps(stakes(spark, data), last.isoformat())
    got = [(r["policy"], r["field_name"], r["month_start"], r["active_rows"], r["sum_pct"] and float(r["sum_pct"]) if r["sum_pct"] is None or r["sum_pct"] else 0.0,
            r["repeats"], r["zero_length_active"]) for r in D.policy_grid(steps).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(r[6] for r in want) and any(r[5] for r in want)
    counted = {r["policy"]: r for r in D.policy_comparison(steps).collect()}
    for policy in "ABC":
        assert counted[policy]["field_months"] == sum(r[0] == policy for r in want)
        assert counted[policy]["none_active"] == sum(r[0] == policy and r[3] == 0 for r in want)
    worst = sorted((-abs(r[4] - 100), r[1], r[2]) for r in want if r[0] == "A" and r[3] and abs(r[4] - 100) > 0.5)[:15]
    assert [(r["field_name"], r["month_start"]) for r in D.worst_sums(steps).collect()] == [(f, m) for _, f, m in worst]
    plan = D.policy_comparison(steps)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def test_rows_of_zero_interest_in_counts(spark):
    data = [("F", "A", 0, "2020-01-01", "2020-06-01", "Y"), ("F", "A", 0, "2020-01-01", "2020-06-01", "Y"), ("F", "A", 0, "2021-01-01", None, "Y"),
            ("F", "A", 30, "2019-01-01", "2020-03-01", "N"), ("F", "B", 30, "2020-05-31", "2020-12-01", "N"), ("G", "A", 0, "2020-01-01", None, "Y"),
            ("H", "B", 100, "2020-01-01", None, "N")]
    got = one(D.zero_interest_profile(stakes(spark, data)))
    assert (got["operator_rows"], got["covered_by_other"], got["positive_elsewhere"], got["not_covered"]) == (4, 2, 3, 2)
    none = one(D.zero_interest_profile(stakes(spark, data[-1:])))
    assert (none["operator_rows"], none["covered_by_other"], none["positive_elsewhere"]) == (0, 0, 0)


def test_label_audit(spark):
    data = [("F", "A", 1, "2020-01-01", None), ("F", "A", 1, "2020-01-01", "2021-01-01", "N", "Previous-2019 to 2021"),
            ("F", "A", 1, "2020-01-01", "2021-01-01", "N", "Current"), ("F", "A", 1, "2020-01-01", None, "N", "?")]
    got = one(D.label_audit(stakes(spark, data)))
    assert (got["current_form"], got["previous_form"], got["other_form"], got["mismatches"]) == (2, 1, 1, 2)


def test_interval_rules(spark):
    data = [("F", "A", 101, "2020-01-01", None), ("", "A", 1, "2020-01-01", None), ("F", "A", 1, "2020-02-01", "2020-01-01"), ("F", "A", 0, "2020-01-01", None)]
    assert [r[0] for r in rows(K.interval_offenders(stakes(spark, data)), "reason")] == ["end before start", "field name missing", "percentage out of range"]


def test_starts_within_a_month_are_one_row_of_the_layout(spark):
    frame, st, window = resolved(spark, [("F", "202001"), ("F", "202002"), ("F", "202003")], [
        ("F", c, 50, s, "2020-02-20") for c in ("A", "B", "C") for s in ("2020-02-05", "2020-02-10")])
    layout = I.month_layout(st, *window)
    assert rows(layout.where("not active"), "equity_field", "month_start", "company_name") == [("F", date(2020, 2, 1), None)]
    assert rows(I.month_facts(layout), "active_rows", "repeated_companies", "mid_month_start") == [(0, 0, True)]
    assert [r[0] for r in rows(frame, "category")] == ["genuine_interval_gap", "month_start_boundary", "pre_equity_history"]


def test_policy_rows_are_dealt_by_pair_before_they_are_taken_apart(spark):
    data = [(f"F{i % 5}", f"C{i % 3}", 50, f"20{10 + i % 7}-0{1 + i % 9}-1{i % 3}", f"20{18 + i % 3}-0{1 + i % 9}-01") for i in range(40)]
    few, many = D.policy_steps(stakes(spark, data), "2020-12-01"), D.policy_steps(stakes(spark, data), "2020-12-01", 23)
    assert rows(few) == rows(many) != []
    plan = D.policy_events(stakes(spark, data), 23)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(field_name" in plan and ", 23)" in plan
