import random

import pytest
from helpers import one, production, rows
from pyspark.sql import functions as F

from stakeline.functions.volumes import NATIVE_STREAMS
from stakeline.operators import checks as K, licence as L, production as P, ranking as R
from stakeline.sources import readers, schemas, sinks


def test_pages_round_trip(spark, tmp_path):
    page = '{"features":[%s],"exceededTransferLimit":%s}'
    feature = '{"attributes":{"object_id":%d,"field":"F","unit":"U","period":"202001","oil_mbd":1.5},"geometry":{"x":1.0,"y":55.0}}'
    (tmp_path / "1.json").write_text(page % (",".join(feature % i for i in (1, 2, 3)), "true"))
    (tmp_path / "2.json").write_text(page % (",".join(feature % i for i in (3, 4)), "false"))
    (tmp_path / "3.json").write_text(page % ("", "false"))
    pages = readers.read_pages(spark, str(tmp_path))
    found = readers.features(pages)
    assert found.count() == 5 and "x" in found.columns
    assert "x" not in readers.features(pages, geometry=False).columns
    assert rows(readers.repeated_features(found)) == [(3, 2)]


FEATURE = '{"attributes":{"object_id":%d,"field":"F","unit":"U","period":"202001","oil_mbd":1.5},"geometry":{"x":1.0,"y":55.0}}'


def landing(spark, folder, pages, counts=None):
    """pages: (offset, object ids, flag); ``counts``: what the extract had, by offset, if other than what is there."""
    folder.joinpath("pages").mkdir(parents=True)
    lines = ['{"offset":%d,"exceededTransferLimit":%s,"features":[%s]}' % (o, flag, ",".join(FEATURE % i for i in ids)) for o, ids, flag in pages]
    folder.joinpath("pages", "part.json").write_text("\n".join(lines))
    found = counts or {o: len(ids) for o, ids, _ in pages}
    spark.createDataFrame(list(found.items()), schemas.MANIFEST).write.parquet(str(folder / "manifest"))
    return str(folder)


@pytest.mark.parametrize("pages,kept", [
    ([(0, [1, 2], "true"), (2, [3], "false"), (4, [4, 5], "true")], [1, 2, 3]),  # a short page without the flag ends the answer
    ([(0, [1, 2], "true"), (2, [3], "true"), (4, [4], "false")], [1, 2, 3, 4]),  # a short page with the flag does not
    ([(0, [1, 2], "false"), (2, [3, 4], "false"), (4, [], "true"), (6, [5, 6], "true")], [1, 2, 3, 4]),  # an empty page does, whatever its flag
    ([(4, [], "false"), (2, [3, 4], "null"), (0, [1, 2], "null")], [1, 2, 3, 4]),  # offsets give the order, not the file
    ([(0, [1, 2], "true"), (2, [3, 4], "true")], [1, 2, 3, 4]),  # no end: all there is
])
def test_stop_rules_of_landed_pages(spark, tmp_path, pages, kept):
    path = landing(spark, tmp_path / "extract", pages)
    found = readers.features(readers.page_stream(spark, path, 2))
    assert [r[0] for r in rows(found, "object_id")] == kept and "x" in found.columns
    assert "x" not in readers.features(readers.page_stream(spark, path, 2, geometry=False), geometry=False).columns
    keep = lambda frame: (frame.write.parquet(str(tmp_path / "out")), spark.read.parquet(str(tmp_path / "out")))[1]
    assert readers.fetched_features(spark, path, 2, keep).count() == len(kept)


def test_lost_and_malformed_pages(spark, tmp_path):
    path = landing(spark, tmp_path / "lost", [(0, [1, 2], "true"), (4, [5], "false")], {0: 2, 2: 2, 4: 2})
    pages = readers.page_stream(spark, path, 2)
    assert rows(readers.page_gaps(pages, readers.read_manifest(spark, path))) == [(2, 2, 0), (4, 2, 1)]
    with pytest.raises(readers.SourceError, match="fetched 3 rows, the extract had 6"):
        readers.fetched_features(spark, path, 2, lambda frame: (frame.write.parquet(str(tmp_path / "o")), frame)[1])
    bad = tmp_path / "bad"
    bad.joinpath("pages").mkdir(parents=True)
    bad.joinpath("pages", "part.json").write_text('{"offset":0,"features":[\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        readers.page_stream(spark, str(bad), 2).collect()


def landed_days(spark, folder):
    days = spark.range(4000).selectExpr("id", "date_add(date'2018-03-01', cast(id % 1000 as int)) as reported_on", "id % 7 as v")
    days.withColumn("year", F.year("reported_on")).repartitionByRange("year", "reported_on").sortWithinPartitions("year", "reported_on").write.partitionBy("year").parquet(folder)
    return "id bigint, reported_on date, v bigint, year int"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_footers_answer_statistics(spark, tmp_path):
    shape = landed_days(spark, str(tmp_path / "days"))
    found = readers.footer_statistics(spark, str(tmp_path / "days"), shape, "reported_on")
    assert "PushedAggregation: [MIN(reported_on), MAX(reported_on), COUNT(*)]" in found._jdf.queryExecution().toString()
    got = one(found)
    assert (str(got["min_value"]), str(got["max_value"]), got["row_count"]) == ("2018-03-01", "2020-11-24", 4000)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_landings_are_read_by_folder_and_day(spark, tmp_path):
    shape, path = landed_days(spark, str(tmp_path / "days")), str(tmp_path / "days")
    newest = readers.latest_landed(spark, path, shape)
    assert {str(r["reported_on"])[:7] for r in newest.collect()} == {"2020-11"} and newest.count() == 4 * 24
    scans = [line for line in plan_of(newest).splitlines() if "PartitionFilters" in line]
    assert any("subquery" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    files = lambda frame: {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}
    assert all("year=2020" in f for f in files(newest))
    some = readers.in_months(spark, path, shape, "201812", "201901")
    assert {str(r["reported_on"])[:7] for r in some.collect()} == {"2018-12", "2019-01"}
    assert "year#" in plan_of(some).split("PartitionFilters: [")[1].split("]")[0] and len(files(some)) < len(files(spark.read.parquet(path)))


def test_titles_of_builds(spark, tmp_path):
    now = spark.createDataFrame([(3, "Interests, May")], "record_count int, source_title string")
    outcome = lambda before, after=now: one(K.title_change(before, after))["outcome"]
    assert outcome(now) == "unchanged" and outcome(now.limit(0)) == "first run"
    assert outcome(now.withColumn("source_title", F.lit("Interests, April"))) == "changed"
    assert outcome(now.withColumn("source_title", F.lit(None).cast("string"))) == "changed"
    assert outcome(now, now.withColumn("source_title", F.lit(None).cast("string"))) == "no title"


def test_builds_are_compared_by_digests(spark):
    before = spark.range(5000).selectExpr("concat('f', id % 50) as field", "cast(id div 50 as string) as period", "if(id % 9 = 0, null, id) as v", "id as built_at")
    same = before.withColumn("built_at", F.lit(0)).repartition(7)
    keys = ["field", "period"]
    changes = lambda after: K.changes_by_digest(before, after, K.range_digests(before, keys), K.range_digests(after, keys), keys)
    assert changes(same).count() == 0
    assert "Scan ExistingRDD" not in plan_of(changes(same)) and "Range (" not in plan_of(changes(same))  # empty without reading the tables
    other = same.where("period <> '7' or field <> 'f3'").withColumn(
        "v", F.when(F.expr("period = '9' and field = 'f1'"), None).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([("new", "1", 1, 0)], same.schema))
    assert rows(changes(other)) == [("f1", "9", "changed"), ("f3", "7", "gone"), ("new", "1", "new")]
    assert rows(changes(other)) == rows(K.table_changes(before, other, keys))


def test_search_by_index_equals_the_scan(spark):
    labels = ["Clair", "Nuclear North", "clair ridge", "CLAIRE", "air", "aaaa", "aaaaaa", "x-clair", "Ünï clair", ""]
    entries = spark.createDataFrame([("field", label, label.lower().replace(" ", "-")) for label in labels] + [("operator", "Clair", "c")], "type string, label string, slug string")
    index = R.postings(entries)
    for query in ("clair", " CLA", "aaa", "aaaaa", "nï c", "cl", "", "zzz", "clair ridge and more"):
        assert R.search_index(entries, index, query).collect() == R.search(entries, query).collect(), query
    assert rows(index.where("label = 'aaaa'"), "gram") == [("aaa",)]


def test_csv_contracts(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("field,unit,classification,note\nF,U,storage,x\n")
    assert rows(readers.read_classification(spark, str(path))) == [("F", "U", "storage", "x")]
    path.write_text("field,unit,classification,note\nF,U,maybe,x\n")
    with pytest.raises(Exception, match="invalid classification"):
        readers.read_classification(spark, str(path)).collect()
    assert readers.read_aliases(spark, str(tmp_path / "absent.csv")).count() == 0
    bad = tmp_path / "a.csv"
    bad.write_text("production_name,equity_name\nA,\n")
    with pytest.raises(Exception, match="empty equity_name"):
        readers.read_aliases(spark, str(bad)).collect()
    wrong = tmp_path / "w.csv"
    wrong.write_text("other,equity_name\nA,B\n")
    with pytest.raises(Exception):
        readers.read_aliases(spark, str(wrong)).collect()


def test_last_override_line_wins(spark):
    data = spark.createDataFrame([(1, "A", "X", "b", "approved"), (2, " A ", "Y", "b", "approved"), (3, "", "Z", "b", "approved")], schemas.OVERRIDES)
    assert rows(readers.effective_overrides(data), "entity", "display_group") == [("A", "Y")]


def test_contract_differences(spark):
    frame = spark.createDataFrame([(1, "x")], "object_id int, field string")
    assert K.contract_differences(frame.schema, "object_id bigint, field string, unit string") == [
        ("object_id", "bigint", "int"), ("unit", "string", None)]
    with pytest.raises(K.CheckFailed, match="unit is missing"):
        K.require_contract(frame, "unit string", "production")
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("x", 1)], "b string, a int")
    assert one(K.schema_fingerprint(spark, a)) == one(K.schema_fingerprint(spark, b))


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "site")
    table, empty = spark.range(3), spark.range(0)
    assert sinks.current_build(spark, target) is None
    sinks.publish(spark, target, "b1", {"t": table}, {"fine": empty})
    with pytest.raises(K.CheckFailed, match="broken"):
        sinks.publish(spark, target, "b2", {"t": table}, {"broken": table})
    assert sinks.current_build(spark, target).endswith("builds/b1")
    assert not (tmp_path / "site" / "builds" / "b2").exists()
    sinks.publish(spark, target, "b3", {"t": spark.range(5)}, {})
    assert spark.read.parquet(sinks.current_build(spark, target) + "/t").count() == 5


def test_of_two_builds_from_one_predecessor_one_is_refused(spark, tmp_path):
    target = str(tmp_path / "site")
    sinks.publish(spark, target, "b1", {"t": spark.range(1)}, {})
    seen = sinks.newest_commit(spark, target)
    sinks.publish(spark, target, "b2", {"t": spark.range(2)}, {}, after=seen)
    with pytest.raises(K.CheckFailed, match="another build was published after commit 1"):
        sinks.publish(spark, target, "b3", {"t": spark.range(3)}, {}, after=seen)
    assert sinks.current_build(spark, target).endswith("builds/b2") and sinks.newest_commit(spark, target) == 2
    sinks.publish(spark, target, "b4", {"t": spark.range(4)}, {})
    assert spark.read.parquet(sinks.current_build(spark, target) + "/t").count() == 4


def test_documents_by_slug(spark, tmp_path):
    points = spark.createDataFrame([("a", "202001", 1.0), ("a", "202002", None), ("b", "202001", 2.0)], "slug string, period string, v double")
    docs = sinks.section(points, "series", "slug", ["period"])
    sinks.write_documents(docs, str(tmp_path / "d"))
    assert rows(sinks.read_document(spark, str(tmp_path / "d"), "a"), "position", "body") == [
        ("202001", '{"period":"202001","v":1.0}'), ("202002", '{"period":"202002","v":null}')]
    many = sinks.section(spark.range(3000).selectExpr("'a' as slug", "lpad(id, 6, '0') as period", "repeat('x', 1000) as v"), "series", "slug", ["period"])
    for name, written, lines in (("small", docs, 2), ("large", many, 3000)):
        size = one(sinks.write_sized(written, str(tmp_path / name)))
        assert size["documents"] == written.count() and size["bytes"] > 0
        assert sinks.read_document(spark, str(tmp_path / name), "a").count() == lines


def test_chart_csv_leaves_null_cells_empty(spark, tmp_path):
    frame = spark.createDataFrame([("202001", 1.5, None)], "period string, a double, b double")
    sinks.write_csv(frame, str(tmp_path / "c"), ["period"])
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("part-*.csv"))
    assert text == "period,a,b\n202001,1.5,\n"


def test_shapes(spark):
    ring = [[0.0, 50.0], [1.0, 50.0], [1.0, 51.0], [0.0, 50.0]]
    far = [[4.0, 60.0], [5.0, 60.0], [5.0, 61.0], [4.0, 60.0]]
    shapes = spark.createDataFrame([("p", [ring]), ("m", [ring, far]), ("n", []), ("z", None)], "name string, rings array<array<array<double>>>")
    got = {r["properties"]["name"]: (r["geometry_type"], r["coordinates"][:4]) for r in sinks.polygon_features(L.with_rings(shapes)).collect()}
    assert got == {"p": ("Polygon", "[[[0"), "m": ("MultiPolygon", "[[[[")}
    assert rows(K.missing_rings(shapes), "name") == [("n",), ("z",)]
    assert one(L.ring_extent(shapes)) == {"lon_min": 0.0, "lon_max": 5.0, "lat_min": 50.0, "lat_max": 61.0}


def test_negatives_and_bounds(spark):
    prod = production(spark, [dict(oil_mbd=-1.0), dict(oil_mbd=None, lon=9.0), dict(gas_pipeline=-0.5)])
    assert rows(K.negatives(prod, ["object_id"], [*NATIVE_STREAMS, "gas_pipeline"])) == [(0, "oil_mbd", -1.0), (2, "gas_pipeline", -0.5)]
    assert rows(K.out_of_bounds(prod.select("object_id", "lon", "lat")), "object_id") == [(1,)]


def test_a_dropped_field_is_caught_among_many_rounded_values(spark):
    rng = random.Random(42)
    data = [(f"F{i % 300}", f"{2000 + i // 3600}{1 + (i // 300) % 12:02d}", rng.random() * 20) for i in range(36000)]
    frame = spark.createDataFrame(data, "field string, period string, v double").withColumn("v", F.round(F.col("v").cast("decimal(28,12)"), 3))
    gaps = lambda right: K.conservation(frame, right, {"v": "v"}).withColumn("tolerance", F.lit(K.X.rounding_tolerance_value(36000, 12000)))
    assert K.beyond(gaps(frame)).count() == 0
    lost = frame.unionByName(frame.limit(1).select("field", "period", (-F.lit(3.0)).cast("decimal(18,3)").alias("v")))
    assert K.beyond(gaps(lost)).count() == 1


def test_formula_check(spark):
    columns = "k string, oil_mbd double, condensate_mbd double, dry_gas_mmscfd double, assoc_gas_mmscfd double, liquids_mboed double, natural_gas_mboed double, total_mboed double"
    data = [("ok", 1.0, 1.0, 6.0, 0.0, 2.0, 1.0, 3.0), ("bad", 1.0, 1.0, 6.0, 0.0, 2.0, 6.0, 8.0), ("none", 1.0, 1.0, 6.0, 0.0, None, 1.0, 3.0)]
    assert rows(K.formula_offenders(spark.createDataFrame(data, columns), ["k"])) == [("bad", "formula"), ("none", "missing")]


def test_build_comparison(spark):
    kind = "record_count bigint, field_count bigint, history_record_count bigint, history_field_count bigint, latest_period string"
    old = spark.createDataFrame([(100, 100, 1000, 100, "202606")], kind)
    new = spark.createDataFrame([(119, 89, 1201, 120, "202605")], kind)
    got = dict(rows(K.build_changes(old, new), "check", "outcome"))
    assert got == {"record count": "passed", "field count": "failed", "history record count": "failed",
                   "history field count": "passed", "latest period": "failed"}
    first = dict(rows(K.build_changes(spark.createDataFrame([], kind), new), "check", "outcome"))
    assert set(first.values()) == {"skipped"}


def test_table_changes_ignore_build_time(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", None, "x")], "k string, v int, built_at string")
    new = spark.createDataFrame([("a", 1, "y"), ("b", 3, "y"), ("d", 4, "y")], "k string, v int, built_at string")
    assert rows(K.table_changes(old, new, ["k"])) == [("b", "changed"), ("c", "gone"), ("d", "new")]


def test_percentage_words(spark):
    frame = spark.createDataFrame([("a", 1.0)], "licence string, equity_pct double")
    assert K.percentage_columns(frame.columns) == ["equity_pct"]
    assert one(K.percentage_keys(frame))["offending"] == 1


def test_episode_filters(spark):
    data = [(1, "P1", "B1", "2000-01-01", "2001-01-01", "G", "S"), (2, "P1", "B1", "2000-06-01", None, "G", "S"), (3, "P2", "", "2001-01-01", None, "", "S")]
    frame = spark.createDataFrame(data, "episode_id int, licence_reference string, block_reference string, start_date string, end_date string, operator_group string, licence_status string")
    assert rows(L.filter_episodes(frame, "2000-07-01"), "episode_id") == [(1,), (2,)]
    assert rows(L.filter_episodes(frame, "2001-01-01"), "episode_id") == [(2,), (3,)]
    assert one(L.episode_summary(frame)) == {"distinct_licence_count": 2, "distinct_block_count": 1, "episode_count": 3}
    assert L.episode_summary(frame.where("false")).count() == 0
    assert rows(L.facet_values(frame, ["operator_group"])) == [("operator_group", "G")]


def test_search_ranking(spark):
    labels = ["Clair", "Eclair", "New Clair Field", "Clair Ridge", "x/clair", "claim"]
    entries = spark.createDataFrame([("field", v, v.lower()) for v in labels], "type string, label string, slug string")
    found = [r["label"] for r in R.search(entries, " CLA ").collect()]
    assert found == ["Clair", "claim", "Clair Ridge", "x/clair", "New Clair Field", "Eclair"]
    assert R.search(entries, "  ").count() == 0


def test_three_remainder_rules(spark):
    def frame(data):
        return spark.createDataFrame(data, "k string, period string, v double").withColumn("v", F.col("v").cast("decimal(18,3)"))
    series = frame([("a", "202001", 5.0), ("a", "202002", 7.0), ("b", "202001", 3.0), ("c", "202001", 1.0)])
    totals = frame([("t", "202001", 8.5), ("t", "202002", 6.0), ("t", "202003", None)])
    chosen = spark.createDataFrame([("a",)], "k string")
    got = {(r["label"], r["bucket"]): None if r["v"] is None else float(r["v"]) for r in R.top_n_of_total(series, totals, "k", "v", chosen, annual=False).collect()}
    assert got[R.OTHER_FIELDS, "202001"] == 3.5 and got[R.OTHER_FIELDS, "202002"] == 0.0 and got[R.OTHER_FIELDS, "202003"] is None
    yearly = {(r["label"], r["bucket"]): float(r["v"]) for r in R.top_n_of_total(series, totals, "k", "v", chosen).collect()}
    assert yearly == {("a", "2020"): 6.0, (R.OTHER_FIELDS, "2020"): 1.25}
    inside = {r["label"] for r in R.top_n_within(series, totals, "k", "v", 3).collect()}
    assert R.OTHER_FIELDS not in inside
    assert R.OTHER_FIELDS in {r["label"] for r in R.top_n_within(series, totals, "k", "v", 2).collect()}


def test_handover_of_latest_attributes_is_deterministic(spark):
    prod = production(spark, [dict(unit="B", region="Z", oil_mbd=1.0), dict(unit="A", region="Y", oil_mbd=1.0)])
    latest = one(P.field_latest(prod.withColumn("unit_class", F.lit("production"))))
    assert latest["region"] == "Y"


def test_one_row_of_several_parts(spark):
    from stakeline.operators.rows import one_row

    a, b = spark.range(1).selectExpr("id as a"), spark.range(1).selectExpr("'x' as b")
    assert rows(one_row(a, b)) == [(0, "x")]
    assert rows(one_row(a, b.limit(0))) == []
    with pytest.raises(Exception, match="several rows"):
        one_row(spark.range(2).selectExpr("id as a"), b).collect()


def test_only_a_local_master_gets_a_folder_of_its_own():
    from stakeline.session import refuse_remote

    refuse_remote("local[4]")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            refuse_remote(master)


def test_stored_tables_follow_their_files(spark, tmp_path):
    import os

    from stakeline.plans import store

    spark.range(3).write.parquet(str(tmp_path / "t"))
    before = store.input_version(spark, [str(tmp_path / "t")])
    assert before == store.input_version(spark, [str(tmp_path / "t")])
    spark.range(1).write.mode("append").parquet(str(tmp_path / "t"))
    assert before != store.input_version(spark, [str(tmp_path / "t")])
    kept = store.stored(spark, ("test",), "kept-table", lambda: spark.range(2).toDF("id"))
    path = kept.inputFiles()[0].removeprefix("file://")
    store.forget(keep=("kept-table",))
    assert os.path.exists(path) and kept.count() == 2
    store.forget()
    assert not os.path.exists(path)


def test_landed_reports_are_made_after_their_rows_are_spread(spark):
    from stakeline.sources import adapters

    lines = adapters.table(spark, "/root/testdata/sf0.001", "lineitem")
    landed = adapters.landed_production(lines)
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    assert "OPERATOR" in plan.split("RepartitionByExpression")[0] and "OPERATOR" not in plan.split("RepartitionByExpression")[1]
    assert landed.drop("year", "reported_on").exceptAll(adapters.unit_production(lines)).count() == 0
    assert landed.count() == lines.count() and landed.where("year <> year(reported_at) or reported_on <> cast(reported_at as date)").count() == 0


def test_counts_of_landed_pages_gather_no_features(spark, tmp_path):
    from stakeline.sources import adapters

    pages = adapters.landed_pages(adapters.unit_production(adapters.table(spark, "/root/testdata/sf0.001", "lineitem")), leftovers=True)
    assert "collect_list" not in pages.select("offset", "n")._jdf.queryExecution().optimizedPlan().toString()
    readers.land_pages(pages, str(tmp_path / "extract"))
    landed = spark.read.json(str(tmp_path / "extract" / "pages"))
    assert set(landed.columns) == {"offset", "exceededTransferLimit", "features"}
    assert rows(readers.read_manifest(spark, str(tmp_path / "extract"))) == rows(landed.select("offset", F.size("features").cast("bigint")))


def test_bodies_become_text_after_the_rows_are_spread(spark, tmp_path):
    points = spark.createDataFrame([("b", "202002", 2.0), ("a", "202001", None), ("a", "202002", 1.5)], "slug string, period string, v double")
    found = []
    for text in (True, False):
        docs = sinks.documents([sinks.section(points, n, "slug", ["period"], text=text) for n in ("one", "two")])
        assert (dict(docs.dtypes)["body"] == "string") == text
        sinks.write_documents(docs, str(tmp_path / str(text)))
        found.append(sorted(map(tuple, sinks.read_documents(spark, str(tmp_path / str(text))).collect())))
    assert found[0] == found[1] and len(found[0]) == 6 and '"v":null' in found[0][0][3]
