"""Named queries: a Spark plan and, where SQL can say it, the equivalent statement for checking."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .domain import Domain
from .reference_sql import with_views


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Domain], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def entry(name: str, sql: str | None = None):
    """Registers ``build(domain)`` under ``name`` with its check statement."""
    def add(build: Callable[[Domain], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, build, sql)
        return build
    return add


def load() -> dict[str, Entry]:
    from . import (  # noqa: F401  (importing registers)
        catalog_checks, catalog_coverage, catalog_licence, catalog_ownership, catalog_panels, catalog_production,
        catalog_sources,
    )
    from . import catalog_reports  # noqa: F401  (after the queries it puts together)
    return ENTRIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, sf_dir: build(Domain(spark, sf_dir))
    return {name: runner(e.build) for name, e in load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(e.sql) for name, e in load().items() if e.sql is not None}
