from stakeline.operators import intervals
from stakeline.plans import registry, store
from stakeline.plans.domain import Domain

SF = "/root/testdata/sf0.001"


def built(spark, name):
    store.forget()
    registry.queries()[name](spark, SF).collect()
    return {key[-1] for key in store._TABLES}


def test_names_need_no_sums(spark):
    assert "history" not in built(spark, "A15_match_coverage_latest")
    names = Domain(spark, SF).left_names
    assert sorted(names.collect()) == sorted(Domain(spark, SF).history.select("field").distinct().collect())


def test_entities_need_no_owner_sums(spark):
    for name in ("A35_mapping_build", "A36_mapping_names", "Q12_search", "U4_search_union"):
        assert "facts" not in built(spark, name)
    found = Domain(spark, SF).entities
    assert sorted(found.collect()) == sorted(Domain(spark, SF).facts.select("company").distinct().collect())


def test_group_queries_read_entities_from_the_facts(spark):
    assert {"facts", "entities"} <= built(spark, "V18_breakdown_reconciles")


def test_owner_months_need_no_sums_by_field(spark):
    for name in ("X16_group_status", "A19_company_month"):
        found = built(spark, name)
        assert "owner_volumes" in found and not {"facts", "history"} & found
    direct = Domain(spark, SF)
    got = sorted(map(tuple, direct.owner_volumes.collect()))
    assert got and direct.entities.count() == len({r[0] for r in got})
    store.forget()
    by_field = Domain(spark, SF)
    assert by_field.facts.count() > 0  # stored: the months are read from it
    assert sorted(map(tuple, by_field.owner_volumes.collect())) == got


def test_coverage_needs_no_other_sums(spark):
    found = built(spark, "W3_stability_point")
    assert "volumes" in found and "history" not in found
    found = built(spark, "Q15_latest_checkpoint_report")
    assert "categorised" in found and not {"history", "volumes", "resolved"} & found


def test_months_and_volumes_are_those_of_the_history(spark):
    store.forget()
    narrow = Domain(spark, SF)
    keys = ["field", "period", "month_start"]
    months = sorted(map(tuple, narrow.reported.select(*keys).collect()))
    counted = narrow.categorised
    columns = counted.columns
    counted = sorted(map(tuple, counted.collect()), key=repr)
    streams = [*keys, "oil_mbd", "dry_gas_mmscfd", "assoc_gas_mmscfd", "condensate_mbd"]
    volumes = narrow.volumes
    types, volumes = volumes.select(*streams).dtypes, sorted(map(tuple, volumes.select(*streams).collect()))
    whole = Domain(spark, SF)
    history = whole.history.select(*streams)
    assert history.dtypes == types and sorted(map(tuple, history.collect())) == volumes
    assert sorted(map(tuple, history.select(*keys).collect())) == months
    assert sorted(map(tuple, whole.resolved.select(*columns).collect()), key=repr) == counted


def test_partitions_follow_the_rows(spark, monkeypatch):
    assert store.parts_of(spark, spark.range(1000)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(store, "PART_ROWS", 90)
    assert store.parts_of(spark, spark.range(1000)) == 12
    store.forget()
    layout = Domain(spark, SF)
    parts = store.parts_of(spark, layout.stakes)
    plan = intervals.month_facts(layout.layout)._jdf.queryExecution().executedPlan().toString()
    assert parts > 4 and f"{parts} out of {parts}" in plan and "Exchange" not in plan
    store.forget()
