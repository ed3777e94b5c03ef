import random

import xxhash
from cases import awkward, frame

from stakeline.llm import simhash as S


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in root}


def test_fingerprints_and_components(spark):
    base = "a long story of a river that runs past stones and trees until it meets the sea in the far south at last"
    near = [(100 + i, " ".join(w for k, w in enumerate(base.split() * 30) if k != 7 * i), *[None] * 10) for i in range(30)]
    docs = frame(spark, awkward() + near)
    got = S.near_duplicates(docs).collect()
    texts = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    roots = plain_roots({p for _, p in texts})
    least = {}
    for doc_id, p in texts:
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    want = sorted(repr((d, p, least.get(roots[p]))) for d, p in texts)
    assert sorted(repr((r.doc_id, r.print % 2**64, r.component_id)) for r in got) == want
    kept = S.keep_one_each(docs)
    assert kept.columns == docs.columns
    # the twin rows of one document stay together, and rows without an id where nothing near has one
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, p in texts if d == least.get(roots[p]))
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["a text without an id here"]


def near_prints(rnd, n, bits, spread):
    centre = rnd.getrandbits(64)
    found = set()
    while len(found) < n:
        p = centre
        for b in rnd.sample(bits, rnd.randrange(0, spread)):
            p ^= 1 << b
        found.add(p)
    return found


def test_links_connect_all_that_are_near(spark):
    """Crowded buckets of every level lose no connection."""
    rnd = random.Random(9)
    prints = {rnd.getrandbits(64) for _ in range(300)}
    for n, bits, spread in ((400, range(64), 5), (150, range(8), 8), (60, range(20, 34), 4), (3, range(64), 4)):
        prints |= near_prints(rnd, n, list(bits), spread)
    table = spark.createDataFrame([(S.signed(p),) for p in prints], "print bigint")
    edges = S.links(table, bucket=8)
    for e in edges.collect():
        assert ((e.a ^ e.b) % 2**64).bit_count() <= 3
    groups = {}
    for r in S.components(edges).collect():
        groups.setdefault(r.root, set()).add(r.node % 2**64)
    want = {}
    for p, root in plain_roots(prints).items():
        want.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_masks_follow_the_rule():
    levels = S.levels()
    assert [len({m[1] for m in level}) for level in levels][0] == 24
    assert {bin(m[1]).count("1") for m in levels[0]} == {32} and {bin(m[1]).count("1") for m in levels[1]} == {48}
    assert {bin(m[1]).count("1") for m in levels[2]} == {56}


def test_long_chains_and_empty(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in S.components(chain).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
    assert S.near_duplicates(frame(spark, [])).count() == 0
