"""Scalar and conditional functions of the ownership model."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# fixed values: characters folded when two sources spell a name differently
DASHES = "‐‑‒–—−"
APOSTROPHES = "‘’ʼ"

# fixed values: coverage thresholds and tolerances, in percent
PUBLISH_COVERAGE = 95.0
WARN_COVERAGE = 99.5
FULL_COVERAGE = 100.0
SUM_TOLERANCE = 0.5
SENTINEL_YEAR = 1960


# --- names -----------------------------------------------------------------

def slug_or_empty(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "-"), F.lit("-"))


def slugify(name: Column) -> Column:
    """Identifier form of a name; a name with nothing usable in it is an error."""
    slug = slug_or_empty(name)
    complaint = F.concat(F.lit("no slug can be made from name: "), F.coalesce(name, F.lit("<null>")))
    return F.when(slug != "", slug).otherwise(F.raise_error(complaint).cast("string"))


def normalize_name(name: Column) -> Column:
    """Case, white space and character variants only; never drops a distinguishing mark."""
    stripped = F.regexp_replace(name, r"(?U)^\s+|\s+$", "")
    spaced = F.regexp_replace(F.upper(stripped), r"(?U)\s+", " ")
    return F.translate(spaced, DASHES + APOSTROPHES, "-" * len(DASHES) + "'" * len(APOSTROPHES))


# --- periods and dates -----------------------------------------------------

def month_start(period: Column) -> Column:
    year, month = F.substring(period, 1, 4).cast("int"), F.substring(period, 5, 2).cast("int")
    return F.make_date(year, month, F.lit(1))


def month_floor(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def next_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "MM"), 1)


DAY_MS = 86_400_000


def epoch_day(ms: Column) -> Column:
    """UTC date of epoch milliseconds, whatever the session's time zone; negative before 1970."""
    return F.date_from_unix_date(F.floor(ms / DAY_MS).cast("int"))


def epoch_date(ms: Column) -> Column:
    return F.date_format(epoch_day(ms), "yyyy-MM-dd")


def epoch_iso(ms: Column) -> Column:
    second = F.floor(F.pmod(ms, F.lit(DAY_MS)) / 1000).cast("int")
    clock = F.format_string(
        "%02d:%02d:%02d", F.floor(second / 3600).cast("int"), F.floor(second % 3600 / 60).cast("int"), second % 60
    )
    return F.when(ms.isNotNull(), F.concat(epoch_date(ms), F.lit("T"), clock, F.lit("Z")))


def normalize_period_input(raw: Column, edge: str) -> Column:
    """YYYYMM, YYYY-MM, YYYY/MM or 'YYYY MM'; a bare year opens or closes the range."""
    if edge not in ("start", "end"):
        raise ValueError("edge must be 'start' or 'end'")
    text = F.trim(raw)
    digits = F.translate(text, "-/ ", "")
    size, whole = F.length(text), F.length(digits)
    numeric = F.translate(digits, "0123456789", "") == ""
    # one separator at most, behind the year
    placed = (size == whole) | ((size == whole + 1) & F.substring(text, 5, 1).isin("-", "/", " "))
    month = F.substring(digits, 5, 2).between("01", "12")
    return (
        F.when(numeric & placed & (whole == 6) & month, digits)
        .when(numeric & (size == 4) & (whole == 4), F.concat(text, F.lit("01" if edge == "start" else "12")))
    )


def period_long(period: Column) -> Column:
    return F.when(~period.rlike(r"^\d{6}$"), period).otherwise(
        F.date_format(month_start(F.when(period.rlike(r"^\d{6}$"), period)), "MMMM yyyy")
    )


def period_short(period: Column) -> Column:
    return F.when(~period.rlike(r"^\d{6}$"), period).otherwise(
        F.date_format(month_start(F.when(period.rlike(r"^\d{6}$"), period)), "MMM yyyy")
    )


def preset_start(latest_period: Column, years: int) -> Column:
    """January of the first of the last ``years`` calendar years."""
    first_year = F.substring(latest_period, 1, 4).cast("int") - F.lit(years - 1)
    return F.concat(first_year.cast("string"), F.lit("01"))


# --- intervals -------------------------------------------------------------

def contains(start: Column, end: Column, day: Column) -> Column:
    """Half-open: the start belongs to the interval, the end does not; null end is open."""
    return (start <= day) & (end.isNull() | (day < end))


def overlaps(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return (end_b.isNull() | (start_a < end_b)) & (end_a.isNull() | (start_b < end_a))


def label_kind(label: Column) -> Column:
    return (
        F.when(label == "Current", "current")
        .when(label.rlike(r"^Previous-\d{4} to \d{4}$"), "previous")
        .otherwise("other")
    )


def label_years(label: Column) -> tuple[Column, Column]:
    pattern = r"^Previous-(\d{4}) to (\d{4})$"
    is_previous = label.rlike(pattern)
    first = F.when(is_previous, F.regexp_extract(label, pattern, 1).cast("int"))
    last = F.when(is_previous, F.regexp_extract(label, pattern, 2).cast("int"))
    return first, last


# --- holders ---------------------------------------------------------------

def split_holders(text: Column) -> Column:
    """'NAME (85%), NAME2 (15%)' -> array of (name, pct); parts of another shape are skipped."""
    def parsed(piece: Column) -> Column:
        whole = F.rtrim(piece)
        bracket = F.substring_index(whole, "(", -1)
        number = F.rtrim(F.left(bracket, F.length(bracket) - 2))
        shaped = whole.contains("(") & bracket.endswith("%)") & (F.translate(number, "0123456789.", "") == "")
        name = F.trim(F.left(whole, F.length(whole) - F.length(bracket) - 1))
        return F.struct(name.alias("name"), F.when(shaped, number.try_cast("double")).alias("pct"))

    pieces = F.split(F.coalesce(text, F.lit("")), ",")
    return F.filter(F.transform(pieces, parsed), lambda h: h["pct"].isNotNull())


def row_holder(text: Column, pct: Column, tolerance: float = 1e-6) -> Column:
    """The one listed holder whose percentage is the row's own; a tie gives no name."""
    hits = F.filter(split_holders(text), lambda h: F.abs(h["pct"] - pct) <= tolerance)
    return F.when(pct.isNotNull() & (F.size(hits) == 1), F.get(hits, F.lit(0))["name"])


# --- statuses --------------------------------------------------------------

def coverage_pct(resolved: Column, total: Column) -> Column:
    share = F.lit(100.0) * resolved.cast("double") / F.when(total > 0, total.cast("double"))
    return F.round(share, 3)


def component_status(included: Column, total: Column) -> Column:
    pct = coverage_pct(included, total)
    return (
        F.when(total <= 0, "not_applicable")
        .when(pct < PUBLISH_COVERAGE, "unavailable")
        .when(pct >= WARN_COVERAGE, "complete")
        .otherwise("warning")
    )


def stream_status(resolved: Column, total: Column) -> Column:
    """As for a component, except that a month without volume is unavailable."""
    pct = coverage_pct(resolved, total)
    return (
        F.when((total <= 0) | (pct < PUBLISH_COVERAGE), "unavailable")
        .when(pct >= WARN_COVERAGE, "complete")
        .otherwise("warning")
    )


def total_gate(liquids_status: Column, gas_status: Column) -> Column:
    def either(value: str) -> Column:
        return (liquids_status == value) | (gas_status == value)

    neither_applies = (liquids_status == "not_applicable") & (gas_status == "not_applicable")
    return (
        F.when(neither_applies, "not_applicable")
        .when(either("unavailable"), "unavailable")
        .when(either("warning"), "warning")
        .otherwise("complete")
    )


def owner_value(status: Column, volume: Column) -> Column:
    """Unavailable is unknown (null); not applicable is a known zero."""
    zero = F.lit(0).cast("decimal(38,12)")
    return (
        F.when(status == "unavailable", F.lit(None))
        .when(status == "not_applicable", zero)
        .otherwise(F.coalesce(volume.cast("decimal(38,12)"), zero))
    )


def group_status(present: Column, members: Column, complete: Column, warning: Column) -> Column:
    """``present``/``complete``/``warning`` count members with a value and those statuses."""
    return (
        F.when(present == 0, "unavailable")
        .when(present < members, "partial")
        .when(complete == members, "complete")
        .when(warning > 0, "warning")
        .otherwise("complete")
    )


def zero_length_category(own: Column, before: Column, after: Column) -> Column:
    """Percentages of the row, of the interval ending here and of the one starting here."""
    transition = F.lit("boundary_transition")
    return (
        F.when(
            before.isNotNull() & after.isNotNull(),
            F.when((own == before) & (before == after), "boundary_duplicate").otherwise(transition),
        )
        .when(after.isNotNull(), F.when(own == after, "boundary_duplicate").otherwise(transition))
        .when(before.isNotNull(), "termination_marker")
        .otherwise("standalone_snapshot")
    )


def dominant_commodity(liquids: Column, total: Column) -> Column:
    amount = F.coalesce(total, F.lit(0.0))
    share = F.coalesce(liquids, F.lit(0.0)) / F.when(amount > 0, amount)
    return F.when(amount <= 0, "none").when(share >= 0.5, "oil").otherwise("gas")


def is_operated(holder: Column, operator: Column) -> Column:
    return F.coalesce((holder != "") & (holder == operator), F.lit(False))


def change_badge(now: Column, before: Column) -> Column:
    pct = change_pct(now, before)
    return F.when(pct > 0.05, "up").when(pct < -0.05, "down").when(pct.isNotNull(), "flat")


def change_pct(now: Column, before: Column) -> Column:
    usable = F.when(before != 0, before)
    return (now - usable) / usable * 100


# --- geometry --------------------------------------------------------------

def geometry_type(rings: Column) -> Column:
    return F.when(F.size(rings) == 1, "Polygon").otherwise("MultiPolygon")


def polygon_parts(rings: Column) -> Column:
    """Polygons, each a list of rings: one ring is one polygon, several are one polygon each."""
    return F.transform(rings, lambda ring: F.array(ring))


# --- tolerances ------------------------------------------------------------

def rounding_tolerance(left_rows: Column, right_rows: Column, decimals: int = 3) -> Column:
    """Eight standard deviations of the gap between two independently rounded sums."""
    half_step = 0.5 * 10.0 ** -decimals
    return F.lit(8.0 * half_step) * F.sqrt((left_rows + right_rows) / F.lit(3.0))


def rounding_tolerance_value(left_rows: int, right_rows: int, decimals: int = 3) -> float:
    return 8.0 * 0.5 * 10.0 ** -decimals * math.sqrt((left_rows + right_rows) / 3)
