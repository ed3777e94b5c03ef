import zlib
from collections import Counter, defaultdict

import pytest
from cases import awkward, frame

from stakeline.llm import sharding as S


def check(rows, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs)
    count = Counter(r.shard for r in rows)
    assert set(count) <= set(range(shards))
    sizes = [count.get(s, 0) for s in range(shards)]
    assert not rows or max(sizes) - min(sizes) <= 1
    for s in count:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


@pytest.mark.parametrize("shards", [16, 3])
def test_law_and_slots(spark, shards):
    docs = frame(spark, awkward())
    check(S.assign_shards(docs, shards).collect(), docs.collect(), shards)


def test_groups_stay_together(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(3000 + i, f"copied {i % 120}") for i in range(600)]
    rows += [(9000 + i, "the hot one") for i in range(1300)]  # a third of all rows
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = S.assign_shards(docs, 16).collect()
    check(got, docs.collect(), 16)
    where = defaultdict(set)
    for r in got:
        if 3000 <= r.doc_id < 9000:
            where[r.text_crc32].add(r.shard)
    # before propagation nearly every group of five lies in four shards or more
    assert sum(len(s) > 1 for s in where.values()) < 40
    assert len({r.shard for r in got if r.doc_id >= 9000}) >= 6


def test_empty_table(spark):
    assert S.assign_shards(frame(spark, [])).count() == 0


def test_same_result_for_any_partitioning(spark):
    docs = frame(spark, awkward()).select("doc_id", "text").where("doc_id is not null").distinct()
    one = sorted(map(tuple, S.assign_shards(docs.coalesce(1), 4).collect()))
    assert one == sorted(map(tuple, S.assign_shards(docs.repartition(7), 4).collect()))


@pytest.mark.parametrize("hot", [1300, 700, 0])
def test_a_huge_group_does_not_hold_up_others(spark, hot):
    rows = [(i, f"text {i}") for i in range(2000 - hot)] + [(3000 + i, f"copied {i % 400}") for i in range(2000)]
    rows += [(9000 + i, "the hot one") for i in range(hot)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = S.assign_shards(docs, 16).collect()
    check(got, docs.collect(), 16)
    labels = defaultdict(set)
    for r in got:
        if 3000 <= r.doc_id < 9000:
            labels[r.text_crc32].add(r.label)
    # labels are the shards before rows are cut into even runs
    assert sum(len(s) > 1 for s in labels.values()) <= 4
