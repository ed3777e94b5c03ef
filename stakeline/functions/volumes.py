"""Exact arithmetic for volumes.

Double sums depend on row order and therefore on the shuffle. Volumes are
summed exactly, rounded half-up as decimals, and only turned into doubles where
a result leaves the engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

# fixed values: output stream names, in published order
NATIVE_STREAMS = ("oil_mbd", "assoc_gas_mmscfd", "dry_gas_mmscfd", "condensate_mbd", "water_mbd")
EQUITY_STREAMS = ("oil_mbd", "dry_gas_mmscfd", "assoc_gas_mmscfd", "condensate_mbd")
DERIVED_STREAMS = ("liquids_mboed", "natural_gas_mboed", "total_mboed")

# fixed values: 6,000 scf per boe expressed per thousand
SCF_PER_BOE = 6000
GAS_MMSCF_PER_MBOE = 6

TOTAL = DecimalType(38, 12)
PUBLISHED = DecimalType(18, 3)
SHARE = DecimalType(28, 6)
PERCENT = DecimalType(9, 6)


NANO = Decimal("0.000000001")
MILLI = Decimal("0.001")


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on row order; nothing but nulls adds up to zero.

    Whole units and billionths are summed as two integers - cheap, inside code
    generation, exact - and put together as one decimal per group. Building a
    decimal per row instead costs several times the rest of the scan.
    """
    whole = F.floor(value)
    fraction = F.rint((value - whole) * 1e9).cast("bigint")
    none = F.lit(0).cast("bigint")
    total = F.coalesce(F.sum(whole), none).cast("decimal(20,0)")
    rest = F.coalesce(F.sum(fraction), none).cast("decimal(20,0)")
    return (total.cast(TOTAL) + (rest * F.lit(NANO)).cast(TOTAL)).cast(TOTAL)


def published_sum(value: Column) -> Column:
    """``round3(exact_sum(value))``, rounded in integers, so that a group makes one decimal.

    The billionths add up to no less than zero, so a tie below zero is the one that must not go up.
    """
    whole = F.floor(value)
    fraction = F.rint((value - whole) * 1e9).cast("bigint")
    none = F.lit(0).cast("bigint")
    total, rest = F.coalesce(F.sum(whole), none), F.coalesce(F.sum(fraction), none)
    million = F.lit(1_000_000).cast("bigint")
    thousandths = total * 1000 + F.floor(rest / million)
    left = rest % million
    up = (left > 500_000) | ((left == 500_000) & (thousandths >= 0))
    return ((thousandths + up.cast("bigint")).cast("decimal(18,0)") * F.lit(MILLI)).cast(PUBLISHED)


def round3(value: Column) -> Column:
    """Three decimals, ties away from zero, null stays null, never minus zero."""
    return F.round(value.cast(TOTAL), 3).cast(PUBLISHED)


def derived(liquids: Column, gas: Column) -> dict[str, Column]:
    """Energy equivalents at full precision from liquids and *undivided* gas volumes.

    Gas stays undivided until here: sums of sixths would already be rounded, and
    a sum that lies exactly on a rounding boundary would fall to the wrong side.
    """
    liquids, gas = liquids.cast(TOTAL), gas.cast(TOTAL)
    return {
        "liquids_mboed": liquids,
        "natural_gas_mboed": (gas / GAS_MMSCF_PER_MBOE).cast(TOTAL),
        "total_mboed": ((liquids * GAS_MMSCF_PER_MBOE + gas).cast(TOTAL) / GAS_MMSCF_PER_MBOE).cast(TOTAL),
    }
