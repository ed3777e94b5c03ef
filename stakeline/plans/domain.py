"""The engine's tables over one data set, as lazily built plans.

Every attribute is a DataFrame whose plan Catalyst prunes to what a query asks
for. The few that feed several branches of a query, or many queries, are stored
tables (see ``store``): landed intervals, field history, attributes and latest records,
name matches, resolved field-months, owner facts, the entity mapping, group
months and group-field months. Each is far smaller than the unit reports, which
are only ever scanned.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scalars as X
from ..functions.volumes import EQUITY_STREAMS
from ..operators import attribution, coverage, groups, intervals, licence, matching, production, ranking
from ..sources import adapters
from .store import input_version, is_stored, parts_of, stored, stored_in_buckets, stored_in_partitions

# fixed values: parameters of the queries over the test tables
PUBLICATION_START = "199703"
TODAY_MONTH = "2026-11-01"
LATEST_MONTH = "2001-12-01"
CANDIDATE_STARTS = ["199501", "199601", "199703", "199801", "199901", "200001", "200101"]


INPUTS = ("lineitem", "orders", "supplier", "customer", "nation")


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def _key(self) -> tuple:
        return (self.sf_dir, *input_version(self.spark, [f"{self.sf_dir}/{n}.parquet" for n in INPUTS]))

    def _stored(self, name: str, build) -> DataFrame:
        return stored(self.spark, self._key, name, build)

    def _is_stored(self, name: str) -> bool:
        return is_stored(self.spark, self._key, name)

    def raw(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, name)

    def side_by_side(self, *names: str) -> None:
        """Builds stored tables that don't need one another at the same time; each alone leaves cores idle at its ends."""
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(lambda name: getattr(self, name), names))

    # sources
    @cached_property
    def prod(self) -> DataFrame:
        return adapters.unit_production(self.raw("lineitem"))

    @cached_property
    def landed(self) -> str:
        """Path of the reports as a transfer job lands them: a folder per year, files by date."""
        return stored_in_partitions(self.spark, self._key, "landed", lambda: adapters.landed_production(self.raw("lineitem")), "year")

    @cached_property
    def pages(self) -> DataFrame:
        """The reports as landed pages of a feature service."""
        return self._stored("pages", lambda: adapters.feature_pages(self.prod))

    @cached_property
    def classification(self) -> DataFrame:
        return adapters.unit_classification(self.raw("supplier"))

    @cached_property
    def stakes(self) -> DataFrame:
        return self._stored("stakes", lambda: adapters.stakes(self.raw("orders")))

    @cached_property
    def stake_parts(self) -> int:
        return parts_of(self.spark, self.stakes)

    @cached_property
    def aliases(self) -> DataFrame:
        return adapters.aliases(self.raw("supplier"))

    @cached_property
    def subareas(self) -> DataFrame:
        return adapters.subareas(self.raw("customer"))

    @cached_property
    def overrides(self) -> DataFrame:
        return adapters.group_overrides(self.raw("nation"))

    @cached_property
    def episodes(self) -> DataFrame:
        return adapters.episodes(self.raw("orders"))

    @cached_property
    def polygons(self) -> DataFrame:
        return adapters.polygons(self.raw("supplier"))

    # production
    @cached_property
    def classified(self) -> DataFrame:
        return production.classify(self.prod, self.classification)

    @cached_property
    def history(self) -> DataFrame:
        return self._stored("history", lambda: production.field_history(self.classified))

    @cached_property
    def volumes(self) -> DataFrame:
        """The streams that ownership counts: read from the history where there is one, otherwise without its other sums."""
        if self._is_stored("history"):
            return self.history
        return self._stored("volumes", lambda: production.equity_volumes(self.classified))

    @property
    def reported(self) -> DataFrame:
        """Months of fields: read from the history or the volumes where there are any, otherwise without sums."""
        for name in ("history", "volumes"):
            if self._is_stored(name):
                return getattr(self, name)
        return self._stored("reported", lambda: production.reported_months(self.classified))

    @cached_property
    def attributes(self) -> DataFrame:
        return self._stored("attributes", lambda: production.current_attributes(self.classified))

    @cached_property
    def spans(self) -> DataFrame:
        return production.unit_spans(self.classified)

    @cached_property
    def latest_classified(self) -> DataFrame:
        return production.classify(production.latest_rows(self.prod), self.classification)

    @cached_property
    def latest(self) -> DataFrame:
        return self._stored("latest", lambda: production.field_latest(self.latest_classified))

    @cached_property
    def operators(self) -> DataFrame:
        return production.operator_history(self.history, self.attributes)

    @cached_property
    def country(self) -> DataFrame:
        return production.country_history(self.history)

    # ownership
    @cached_property
    def left_names(self) -> DataFrame:
        """Fields with a month: read from a stored table of months where there is one, otherwise without sums."""
        stored_months = any(self._is_stored(n) for n in ("history", "volumes", "reported"))
        months = self.reported if stored_months else production.production_rows(self.classified)
        return months.select("field").distinct()

    @cached_property
    def right_names(self) -> DataFrame:
        return self.starts.select("equity_field").distinct()

    @cached_property
    def starts(self) -> DataFrame:
        return self._stored("starts", lambda: intervals.start_months(self.stakes))

    @cached_property
    def matches(self) -> DataFrame:
        return self._stored("matches", lambda: matching.match_names(self.left_names, self.right_names, self.aliases))

    @cached_property
    def window(self):
        return intervals.window_of(self.reported)

    @cached_property
    def latest_month(self):
        return self.latest.select(F.max(X.month_start(F.col("period")))).scalar()

    @cached_property
    def resolved(self) -> DataFrame:
        self.side_by_side("volumes", "starts")  # the latter with the intervals
        self.side_by_side("matches", "layout")
        return self._stored("resolved", lambda: self._resolve(self.volumes))

    @cached_property
    def categorised(self) -> DataFrame:
        """``resolved`` for questions that count field-months: read from it where stored, otherwise without volumes."""
        if self._is_stored("resolved"):
            return self.resolved
        self.side_by_side("reported", "starts")
        self.side_by_side("matches", "layout")
        return self._stored("categorised", lambda: self._resolve(self.reported.select("field", "period", "month_start")))

    def _resolve(self, months: DataFrame) -> DataFrame:
        return intervals.resolve(
            months, self.matches, self.stakes, TODAY_MONTH, *self.window, layout=self.layout, starts=self.starts)

    @cached_property
    def layout(self) -> DataFrame:
        """Intervals by active month, in buckets of (field, month)."""
        return stored_in_buckets(self.spark, self._key, "layout", lambda: intervals.month_layout(self.stakes, *self.window, self.starts),
                                 ["equity_field", "month_start"], self.stake_parts)

    @cached_property
    def published(self) -> DataFrame:
        return production.in_range(self.resolved, PUBLICATION_START)

    @cached_property
    def attributed(self) -> DataFrame:
        return intervals.attribute(self.published, self.layout)

    @cached_property
    def attributed_all(self) -> DataFrame:
        return intervals.attribute(self.resolved, self.layout)

    @cached_property
    def shares(self) -> DataFrame:
        """The attributed volumes of all months, for the several questions a batch run asks of them."""
        return self._stored("shares", lambda: self.attributed_all.select("company", "field", "period", *EQUITY_STREAMS))

    @cached_property
    def published_shares(self) -> DataFrame:
        """``attributed`` for questions of its volumes: read from the shares of all months where there are any."""
        return production.in_range(self.shares, PUBLICATION_START) if self._is_stored("shares") else self.attributed

    @cached_property
    def resolved_latest(self) -> DataFrame:
        return self._stored("resolved_latest", lambda: intervals.resolve_latest(
            self.latest, self.matches, self.stakes, self.latest_month, self.starts))

    @cached_property
    def attributed_latest(self) -> DataFrame:
        return intervals.attribute(
            self.resolved_latest, intervals.month_layout(self.stakes, self.latest_month, self.latest_month, self.starts))

    # coverage
    @cached_property
    def categories_all(self) -> DataFrame:
        return coverage.by_category(self.resolved)

    @cached_property
    def months_all(self) -> DataFrame:
        return coverage.monthly(self.categories_all)

    @cached_property
    def categories(self) -> DataFrame:
        return coverage.by_category(self.published)

    @cached_property
    def months(self) -> DataFrame:
        return coverage.monthly(self.categories)

    @cached_property
    def native_status(self) -> DataFrame:
        return coverage.native_status(self.months)

    @cached_property
    def derived_status(self) -> DataFrame:
        return coverage.derived_status(self.months)

    # owners
    @cached_property
    def facts(self) -> DataFrame:
        return self._stored("facts", lambda: attribution.owner_facts(self.attributed))

    @cached_property
    def owner_volumes(self) -> DataFrame:
        """(company, period) sums: of the facts where there are any, otherwise of the attributed rows without a sum by field."""
        if self._is_stored("facts"):
            return attribution.owner_months(self.facts)
        return self._stored("owner_volumes", lambda: attribution.owner_months(self.attributed))

    @cached_property
    def owner_wide(self) -> DataFrame:
        return attribution.owner_wide(self.owner_volumes, coverage.month_statuses(self.months))

    @cached_property
    def series(self) -> DataFrame:
        return attribution.owner_series(self.owner_volumes, coverage.month_statuses(self.months))

    @cached_property
    def entities(self) -> DataFrame:
        """Companies with a share: read from the facts or the owners' months where there are any, otherwise without sums."""
        shares = next((getattr(self, n) for n in ("facts", "owner_volumes") if self._is_stored(n)), None)
        shares = shares if shares is not None else self.attributed
        return self._stored("entities", lambda: shares.select(F.col("company").alias("entity")).distinct())

    @cached_property
    def evidence(self) -> DataFrame:
        return groups.holder_evidence(self.subareas)

    @cached_property
    def mapping(self) -> DataFrame:
        return self._stored("mapping", lambda: groups.build_mapping(self.entities, self.evidence, self.overrides))

    @cached_property
    def membership(self) -> DataFrame:
        return groups.grouped_entities(self.entities, self.mapping)

    @cached_property
    def collapsed(self) -> DataFrame:
        return groups.collapsed_entities(self.entities, self.mapping)

    @cached_property
    def group_series(self) -> DataFrame:
        return groups.month_series(groups.group_months(self.owner_wide, self.membership), self.membership)

    @cached_property
    def group_overview(self) -> DataFrame:
        return groups.month_series(groups.group_months(self.owner_wide, self.collapsed), self.collapsed)

    @cached_property
    def group_wide(self) -> DataFrame:
        return self._stored("group_wide", lambda: groups.energy_months(
            groups.group_months(self.owner_wide, self.collapsed)))

    @cached_property
    def group_fields(self) -> DataFrame:
        mapped = self.facts.join(self.collapsed, self.facts["company"] == self.collapsed["entity"])
        return self._stored("group_fields", lambda: attribution.owner_field_series(
            mapped, self.derived_status, "grp", "grp"))

    # licences
    @cached_property
    def subarea_entries(self) -> DataFrame:
        return licence.subarea_entries(self.subareas)

    @cached_property
    def episode_entries(self) -> DataFrame:
        return licence.episode_entries(self.episodes)

    @cached_property
    def polygon_matches(self) -> DataFrame:
        no_aliases = self.aliases.where(F.lit(False))
        right = self.polygons.select(F.col("polygon_name").alias("equity_field")).distinct()
        return matching.match_names(self.left_names, right, no_aliases)

    @cached_property
    def search_entries(self) -> DataFrame:
        companies = self.entities.select(
            F.lit("legal-entity").alias("type"), F.col("entity").alias("label"),
            X.slugify(F.col("entity")).alias("slug"),
        )
        fields = self.left_names.select(  # after the companies, which leave the history to read
            F.lit("field").alias("type"), F.col("field").alias("label"), X.slugify(F.col("field")).alias("slug")
        )
        operators = self.attributes.select("operator").distinct().select(
            F.lit("operator").alias("type"), F.col("operator").alias("label"), F.col("operator").alias("slug")
        )
        return fields.unionByName(companies).unionByName(operators)

    @cached_property
    def search_index(self) -> DataFrame:
        """Postings of the search entries, in order of their runs of characters, so that a query reads few row groups."""
        return self._stored("search_index", lambda: ranking.postings(self.search_entries).repartitionByRange("gram").sortWithinPartitions(
            "gram", "label"))
