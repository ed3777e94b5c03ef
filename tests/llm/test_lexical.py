import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import awkward, frame, invented

from stakeline.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, best=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted, out = {}, []
    for item, text in items:
        wanted.setdefault(item, Counter()).update(terms(text))
    for item, query in wanted.items():
        found = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in query.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:best], 1)]
    return sorted(map(repr, out))


def found(docs, items, **options):
    return sorted(repr(tuple(r)) for r in X.search(docs, items, **options).collect())


def tables(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
            spark.createDataFrame(items, "item_id bigint, text string"))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 40}, {"best": 3}])
def test_equals_plain_python(spark, options):
    docs = invented(300) + [(300 + i, "stone river Hill läuft") for i in range(25)]  # ties at the border
    items = [(1, "stone river"), (2, "läuft läuft HILL"), (3, ""), (4, None), (5, "nowhere"), (6, "ten no yes the"), (1, "of")]
    assert found(*tables(spark, docs, items), **options) == brute(docs, items, **{k: v for k, v in options.items() if k == "best"})


def test_small_tiles_give_the_same(spark, monkeypatch):
    docs, items = invented(200, seed=8), [(i, " ".join(t.split()[:9])) for i, t in invented(30, seed=9)]
    for name, value in (("TILE_DOCS", 7), ("TILE_BYTES", 400), ("TILE_ITEMS", 4), ("TILE_COLUMNS", 3), ("GROUPS", 2)):
        monkeypatch.setattr(X, name, value)
    assert found(*tables(spark, docs, items)) == brute(docs, items)


def test_sums_beyond_2_to_53_stay_exact():
    rnd = random.Random(4)
    most = (X.EXACT - 1) // X.MOST_IMPACT
    rows = [[(t, rnd.choice([1, 7, most // 3, most, 3 * most + 11])) for t in range(12)] for _ in range(5)]
    docs = 6
    impacts = np.array([[rnd.choice([0, 1, 999_983, X.MOST_IMPACT]) for _ in range(12)] for _ in range(docs)], dtype=np.int64)
    flat = impacts.T.reshape(-1)
    got = X.ItemTile(0, rows).scores(docs, np.arange(13) * docs, np.tile(np.arange(docs), 12), flat.astype(np.float64))
    assert got.tolist() == [[sum(int(impacts[d, t]) * w for t, w in row) for row in rows] for d in range(docs)]
    for terms_of, weights in X.ItemTile(0, rows).stretches:
        assert weights.sum(axis=0).max() * X.MOST_IMPACT < X.EXACT


def test_awkward_rows(spark):
    docs = frame(spark, awkward() + [(None, "stone and word of ten words", *[None] * 10)] * 2)
    items = [(1, "the word ten"), (None, "x story WORDS"), (None, "line"), (3, "é中文 it's"), (3, None)]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(docs, benchmark) == brute(rows, items)
    renamed = docs.withColumnsRenamed({"doc_id": "item", "text": "terms"})
    assert found(renamed, benchmark, id_col="item", text_col="terms") == brute(rows, items)


def test_empty_tables(spark):
    docs, items = tables(spark, invented(10), [(1, "stone")])
    assert X.search(docs.limit(0), items).count() == 0
    assert X.search(docs, items.limit(0)).count() == 0
    assert X.search(docs, spark.createDataFrame([(1, "..")], "item_id bigint, text string")).count() == 0
