import random
import re

import pytest
from cases import awkward, frame

from stakeline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, width=13):
    own, hit, found = words(text), set(), set()
    for item, content in items:
        v = words(content)
        for i in range(max(1, len(v) - width + 1) if v else 0):
            window = v[i:i + width]
            for k in range(len(own) - len(window) + 1):
                if own[k:k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_search_equals_brute_force():
    rnd = random.Random(11)
    pick = lambda n, of: " ".join(rnd.choice(of) for _ in range(n))
    for _ in range(150):
        items = [(i, pick(rnd.choice([0, 1, 2, 5, 13, 14, 20]), ["a", "b", "é", "Ab", "a-b"])) for i in range(4)]
        texts = [pick(rnd.choice([0, 1, 3, 40]), ["a", "b", "é", "ab", "."]) for _ in range(5)]
        for text, (n, spans, ids) in zip(texts, D.Searcher(items).search([t.encode() for t in texts])):
            assert (n, sum(b - a for a, b in spans), sorted(map(str, ids))) == brute(text, items)


def tables(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(1, item), (2, "Short item"), (3, None), (4, ""), (5, item.upper()), (5, item.upper())]
    docs = awkward() + [(20, f"before {item}, after", *[None] * 10), (21, "a short, item here", *[None] * 10),
                        (22, item[:-3] + "x", *[None] * 10)]
    return frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"), items


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 60])
def test_documents(spark, block_bytes):
    docs, benchmark, items = tables(spark)
    found = D.judged(D.find_contamination(docs, benchmark, block_bytes=block_bytes)).collect()
    texts = docs.select("doc_id", "text").collect()
    want = sorted(repr((r.doc_id, *brute(r.text, items))) for r in texts)
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]))) for r in found) == want
    assert {r.doc_id for r in found if r.contaminated} == {20, 21, 22}


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 60])
def test_filter_keeps_the_rest_with_all_columns(spark, block_bytes):
    docs, benchmark, _ = tables(spark)
    kept = D.drop_contaminated(docs, benchmark, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if r.doc_id not in (20, 21, 22))


def test_empty_tables(spark):
    docs, benchmark, _ = tables(spark)
    assert D.find_contamination(docs.limit(0), benchmark).count() == 0
    clean = D.judged(D.find_contamination(docs, benchmark.limit(0)))
    assert clean.where("contaminated or n_hit > 0").count() == 0 and clean.count() == docs.count()


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 60])
def test_null_item_ids_mark_words_but_are_not_listed(spark, block_bytes):
    docs, benchmark, items = tables(spark)
    nameless = spark.createDataFrame([(None, text) for _, text in items], "item_id bigint, text string")
    found = D.judged(D.find_contamination(docs, nameless, block_bytes=block_bytes))
    want = {r.doc_id: r.n_hit for r in D.judged(D.find_contamination(docs, benchmark)).collect()}
    assert {r.doc_id: r.n_hit for r in found.collect()} == want
    assert found.where("n_items > 0 or size(items) > 0").count() == 0


def test_blocks_come_one_at_a_time_and_lose_nothing(spark):
    _, benchmark, items = tables(spark)
    blocks = list(D.benchmark_blocks(benchmark, "item_id", "text", 60))
    assert len(blocks) > 1
    assert sorted(x for block in blocks for x in block) == sorted(x for x in items if x[1] is not None)


def test_filter_with_other_item_columns(spark):
    docs, benchmark, _ = tables(spark)
    named = benchmark.selectExpr("item_id as name", "text as question", "'x' as text")
    for block_bytes in (D.BLOCK_BYTES, 60):
        kept = D.drop_contaminated(docs, named, item_col="name", item_text_col="question", block_bytes=block_bytes)
        assert {20, 21, 22}.isdisjoint({r.doc_id for r in kept.collect()})
