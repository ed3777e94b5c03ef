"""Owner series with a status for every value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars as X
from ..functions.volumes import DERIVED_STREAMS, EQUITY_STREAMS, SCF_PER_BOE, TOTAL, round3
from .rows import one_row

STREAMS = (*EQUITY_STREAMS, *DERIVED_STREAMS)


def per_month(frame: DataFrame) -> DataFrame:
    """Marks a one-row-per-month frame for broadcast.

    Its key is a YYYYMM text with a month of 01 to 12, so it has at most
    120,000 rows of a few dozen bytes however large the data is.
    """
    return F.broadcast(frame)


def owner_facts(attributed: DataFrame) -> DataFrame:
    """(company, field, period) sums, the grain every owner figure is built from."""
    return attributed.groupBy("company", "field", "period").agg(
        *[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS]
    )


def owner_months(attributed: DataFrame, key: Column | str = "company", name: str = "company") -> DataFrame:
    """(owner, period) sums; ``key`` may be any expression over an attributed row."""
    owner = F.col(key) if isinstance(key, str) else key
    return attributed.groupBy(owner.alias(name), "period").agg(
        *[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS]
    )


def _derived_values() -> dict[str, Column]:
    liq = X.owner_value(F.col("liquids_status"), F.col("oil_mbd") + F.col("condensate_mbd"))
    gas = X.owner_value(
        F.col("gas_status"), (F.col("dry_gas_mmscfd") + F.col("assoc_gas_mmscfd")).cast(TOTAL) / 6
    )
    return {"liquids_mboed": liq, "natural_gas_mboed": gas, "total_mboed": liq + gas}


def owner_wide(owner_volumes: DataFrame, statuses: DataFrame, name: str = "company") -> DataFrame:
    """(owner, period) with one struct of value, status and coverage per stream, side by side.

    Statuses belong to the month, not to the owner: an unavailable value is null
    for everybody, a component nobody produced is a known zero.
    """
    joined = owner_volumes.join(per_month(statuses), "period")
    short = {"liquids_mboed": "liquids", "natural_gas_mboed": "gas", "total_mboed": "total"}
    native = [
        F.struct(
            F.when(F.col(f"{s}_status") != "unavailable", round3(F.col(s))).alias("value"),
            F.col(f"{s}_status").alias("status"), F.col(f"{s}_coverage_pct").alias("coverage_pct"),
        ).alias(s)
        for s in EQUITY_STREAMS
    ]
    energy = [
        F.struct(
            round3(c).alias("value"), F.col(f"{short[s]}_status").alias("status"),
            F.col(f"{short[s]}_pct").alias("coverage_pct"),
        ).alias(s)
        for s, c in _derived_values().items()
    ]
    return joined.select(name, "period", *native, *energy)


def owner_series(owner_volumes: DataFrame, statuses: DataFrame, name: str = "company") -> DataFrame:
    """(owner, period, stream) -> value, status, coverage: the rows of ``owner_wide``."""
    wide = owner_wide(owner_volumes, statuses, name)
    points = [F.struct(F.lit(s).alias("stream"), *[F.col(s)[c].alias(c) for c in ("value", "status", "coverage_pct")])
              for s in STREAMS]
    return wide.select(name, "period", F.explode(F.array(*points)).alias("p")).select(name, "period", "p.*")


def owner_field_series(attributed: DataFrame, derived: DataFrame, key: Column | str = "company",
                       name: str = "company", parts: int = 256) -> DataFrame:
    """(owner, field, period) -> energy equivalents, with a known zero where the field was not held.

    The grid is the owner's own fields times the owner's own months. An owner's months
    (bounded by the calendar) and the numbers of its parts (``parts`` at most) are small sets;
    its fields are dealt over these parts, each with its own months in one array, and take the
    owner's months by (owner, part). They are laid out after that, so the grid itself is neither
    shuffled nor joined, and an owner of nearly all fields is spread over ``parts`` tasks.
    """
    owner = F.col(key) if isinstance(key, str) else key
    part = F.pmod(F.xxhash64("field"), F.lit(parts)).cast("int").alias("part")
    # one exchange, by (owner, part), serves the sums, the arrays of a field and the join of the months
    dealt = attributed.select(owner.alias(name), part, "field", "period", *EQUITY_STREAMS).repartition(name, "part")
    facts = dealt.groupBy(name, "part", "field", "period").agg(*[F.sum(s).cast(TOTAL).alias(s) for s in EQUITY_STREAMS])
    zero = F.lit(0).cast(TOTAL)
    point = F.struct("period", *[F.coalesce(s, zero).alias(s) for s in EQUITY_STREAMS])
    # a field has one point per month at most, so the calendar bounds the array
    fields = facts.groupBy(name, "part", "field").agg(F.collect_list(point).alias("points"))
    months = attributed.select(owner.alias(name), part, "period").groupBy(name).agg(
        F.collect_set("period").alias("periods"), F.collect_set("part").alias("owned")
    ).select(name, "periods", F.explode("owned").alias("part"))
    missing = F.transform(F.array_except("periods", "points.period"),
                          lambda p: F.struct(p.alias("period"), *[zero.alias(s) for s in EQUITY_STREAMS]))
    filled = fields.join(months, [name, "part"]).select(
        name, "field", F.explode(F.concat("points", missing)).alias("p")).select(name, "field", "p.*")
    rated = filled.join(per_month(derived), "period")
    return rated.select(
        name, "field", "period",
        *[round3(c).alias(s) for s, c in _derived_values().items()],
        "liquids_status", "gas_status", "total_status",
    )


def owner_index(attributed: DataFrame, wide: DataFrame, name: str = "company") -> DataFrame:
    """Span, field count and the values and statuses of the owner's last month, from ``owner_wide``."""
    counts = attributed.select(name, "field").distinct().groupBy(name).agg(F.count("*").alias("field_count"))
    last = wide.groupBy(name).agg(F.min("period").alias("first_period"), F.max(F.struct("period", *STREAMS)).alias("newest"))
    return last.join(counts, name).select(
        name, X.slugify(F.col(name)).alias("slug"), "first_period",
        F.col("newest.period").alias("last_period"), "field_count",
        *[F.col(f"newest.{s}.{c}").alias(f"{s}_{c}") for s in STREAMS for c in ("value", "status")],
    )


def compact(series: DataFrame, name: str = "company") -> DataFrame:
    """The series without coverage figures."""
    return series.select(name, "period", "stream", "value", "status")


def equity_metadata(published: DataFrame, stakes: DataFrame, matches: DataFrame, entities: DataFrame,
                    publication_start: str) -> DataFrame:
    """What an ownership build records about itself, as one row."""
    spans = published.agg(F.min("period").alias("earliest_period"), F.max("period").alias("latest_period"))
    matched = matches.agg(
        F.count("method").alias("matched_field_count"),
        F.count_if(F.col("method").isNull()).alias("unmatched_field_count"),
    )
    sizes = stakes.agg(F.count("*").alias("interval_count"))
    names = entities.agg(F.count("*").alias("legal_entity_count"))
    return one_row(spans, matched, sizes, names).select(
        "*",
        F.lit(publication_start).alias("publication_start"),
        F.lit(X.PUBLISH_COVERAGE).alias("minimum_coverage_pct"),
        F.lit(X.WARN_COVERAGE).alias("warning_coverage_pct"),
        F.lit(SCF_PER_BOE).cast("bigint").alias("scf_per_boe"),
    )
