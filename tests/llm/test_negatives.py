import math
import random

import numpy as np
import pytest

from stakeline.llm import catalog
from stakeline.llm import negatives as N


def brute(rows, scale=256, every=50, positives=5, negatives=3, low=50, high=95):
    usable = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(scale * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out, done = [], set()
    for a, u, label in sorted(usable, key=lambda r: (r[0], r[2], r[1])):
        if a % every or a in done:
            continue
        done.add(a)
        scored = [(-sum(x * y for x, y in zip(u, v)), i, other) for i, v, other in usable if len(v) == len(u) and i != a]
        for s, p, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            window = sorted(r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s)
            out += [(a, p, k, n, -s, -t) for k, (t, n, _) in enumerate(window[:negatives], 1)]
    return sorted(map(repr, out))


def found(frame, **options):
    return sorted(repr(tuple(r)) for r in N.mine(frame, label=catalog.moved_label, **options).collect())


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(parts)


def invented(n, seed, width=6):
    rnd = random.Random(seed)
    return [(i, [rnd.choice([0.5, 0.25, -0.25, 1.0, 0.125, 0.75]) for _ in range(width)], rnd.randrange(4)) for i in range(n)]


def test_strassen_equals_plain_product():
    rng = np.random.default_rng(3)
    for m, k, n, leaf in ((1, 1, 1, 1), (5, 7, 3, 1), (16, 16, 16, 2), (33, 20, 41, 4), (3, 64, 100, 2), (0, 4, 5, 1), (4, 0, 5, 1)):
        a, b = rng.integers(-9999, 9999, (m, k)), rng.integers(-9999, 9999, (k, n))
        assert (N.strassen(a, b, leaf) == a @ b).all()
    big = rng.integers(-2**31, 2**31, (8, 8))
    exact = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in big.T.tolist()] for r in big.tolist()]
    wrapped = [[(v + 2**63) % 2**64 - 2**63 for v in r] for r in exact]
    assert N.strassen(big, big, 1).tolist() == wrapped


def test_product_is_exact_on_both_sides_of_what_doubles_hold(monkeypatch):
    rng, kinds, strassen = np.random.default_rng(4), [], N.strassen
    monkeypatch.setattr(N, "LEAF", 4)
    monkeypatch.setattr(N, "strassen", lambda a, b, *leaf: (kinds.append(a.dtype.kind), strassen(a, b, *leaf))[1])
    for bits in (8, 16, 20, 22, 24, 31, 62):
        a, b = (rng.choice([-2**bits, 2**bits - 1, 2**bits - 3], shape) for shape in ((9, 33), (33, 20)))
        exact = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T.tolist()] for r in a.tolist()]
        assert N.product(a, b).tolist() == [[(v + 2**63) % 2**64 - 2**63 for v in r] for r in exact]
    assert {kinds[0], kinds[-1]} == {"f", "i"}
    lowest = np.full((1, 1), np.iinfo(np.int64).min)
    assert N.largest(lowest) == 2**63 and N.product(lowest, np.ones((1, 1), dtype=np.int64)).tolist() == lowest.tolist()
    assert N.product(np.zeros((2, 0), dtype=np.int64), np.zeros((0, 3), dtype=np.int64)).tolist() == [[0] * 3] * 2


def test_windows_of_scores():
    positive = np.array([0, 1, 7, 99, 100, 101, 12345, -1, -7, -250, 2**56])
    low, high = N.windows_of(positive, 50, 95)
    for p, a, b in zip(positive.tolist(), low.tolist(), high.tolist()):
        assert 100 * a >= 50 * p > 100 * (a - 1) and 100 * b <= 95 * p < 100 * (b + 1)


def test_equals_plain_python(spark):
    rows = invented(400, 1)
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, rows), every=9, positives=2, negatives=4, high=90) == brute(rows, every=9, positives=2, negatives=4, high=90)


def test_small_tiles_blocks_and_groups_give_the_same(spark, monkeypatch):
    rows = invented(300, 2)
    for name, value in (("BLOCK_ROWS", 3), ("GROUP_BYTES", 200), ("PART_TILES", 1), ("HELD", 2), ("LEAF", 2)):
        monkeypatch.setattr(N, name, value)
    assert found(table(spark, rows, 7), every=10) == brute(rows, every=10)


def test_nothing_is_broadcast(spark, monkeypatch):
    plans, rows, settle = [], invented(300, 5), N.settle

    def settled(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return settle(frame, name)
    monkeypatch.setattr(N, "settle", settled)
    frame = N.mine(table(spark, rows), label=catalog.moved_label)
    plans.append(frame._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) == 3 and not any("Broadcast" in p for p in plans)
    assert sorted(repr(tuple(r)) for r in frame.collect()) == brute(rows)


def test_copies_of_blocks_are_no_more_bytes_than_those_of_tiles(spark):
    one = lambda k, n: (1, n, bytes([k % 256, k // 256]) * 4 * n, bytes(8 * n), bytes(8 * n))
    tiles = spark.createDataFrame([one(k, 1) for k in range(300)], N._TILE)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n, parts in ((30, 10), (300, least), (1, 300)):
        pairs = N.met(tiles, spark.createDataFrame([one(0, n)], N._TILE))
        seen = [r.part for r in pairs.select("part").collect()]
        assert len(seen) == 300 and max(seen) < parts and len(set(seen)) > parts / 2


def test_heaps_live_through_all_tiles_of_a_part(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 3), ("PART_TILES", 7), ("HELD", 8)):
        monkeypatch.setattr(N, name, value)
    given, rows, best_of = [], invented(300, 6), N.best_of
    monkeypatch.setattr(N, "best_of", lambda rows_found, *more: (given.append(rows_found.count()), best_of(rows_found, *more))[1])
    assert found(table(spark, rows, 7), every=5) == brute(rows, every=5)
    assert given[0] == 60 * 5 and given[1] <= 60 * 5 * 3  # one part, 20 blocks of 3 anchors, 5 positives with 3 negatives each


def test_awkward_rows(spark):
    rows = invented(120, 3) + [
        (200, None, 1), (201, [0.5] * 6, None), (None, [0.5] * 6, 1), (202, [0.5, None] * 3, 1), (203, [float("nan")] * 6, 1),
        (204, [float("inf")] * 6, 1), (205, [3e38] * 6, 1), (206, [], 1), (207, [], 2), (250, [], 1), (208, [0.5] * 3, 1),
        (300, [0.5] * 3, 1), (209, [0.4] * 3, 2), (210, [0.4] * 3, 2), (210, [0.4] * 3, 2), (300, [0.5] * 3, 1), (None, None, None)]
    want = brute([r for r in rows if r[0] != 205])
    assert found(table(spark, rows)) == want
    clashing = table(spark, rows).withColumnsRenamed({"vec_id": "score", "embedding": "rows", "label": "anchor"}).selectExpr(
        "*", "1 as label", "'x' as part", "2 as ids")
    assert found(clashing, id_col="score", vector_col="rows", label_col="anchor") == want


def test_empty_tables(spark):
    docs = table(spark, invented(60, 4))
    assert N.mine(docs.limit(0)).count() == 0
    assert N.mine(docs.where("vec_id % 50 != 0")).count() == 0


@pytest.mark.parametrize("score", [np.iinfo(np.int64).min, np.iinfo(np.int64).max])
def test_heap_takes_the_ends_of_the_range(score):
    heap = N.Heap(1, 2)
    for values in ([5, score], [score, 4]):
        heap.take(np.zeros(2, dtype=np.int64), np.array(values), np.arange(2))
    assert heap.scores[0].tolist() == sorted([5, 4, score, score], reverse=True)[:2]
