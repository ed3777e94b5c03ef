import random
import string

from cases import awkward, frame

from stakeline.llm import line_dedup as L

KEYS = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key_of(line):
    return line.strip(" \t\n\x0b\f\r").translate(KEYS)


def brute(rows, least_chars=20, least_docs=3):
    """(id, lines, dropped, kept text) of every row; the null id is smaller than all others."""
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders.setdefault(key_of(line), set()).add(doc_id)
    last = {k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in last or last[key_of(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(repr, out))


def found(docs, **options):
    return sorted(repr(tuple(r)) for r in L.dedup_lines(docs, **options).collect())


def invented(n, seed):
    rnd = random.Random(seed)
    shared = [f"Shared line {k} with Ünïcode and more words" for k in range(6)] + ["short", "", "  exactly twenty chars "]
    rows = []
    for i in range(n):
        lines = [rnd.choice(shared) if rnd.random() < 0.5 else f"a line of its own {rnd.randrange(40)} and more" for _ in range(rnd.randrange(0, 9))]
        rows.append((i, "\n".join(x.upper() if rnd.random() < 0.2 else f"\t{x} " if rnd.random() < 0.2 else x for x in lines)))
    return rows


def test_equals_plain_python(spark):
    rows = invented(120, 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for options in ({}, {"batches": 1}, {"batches": 11, "fanout": 2}, {"least_docs": 1}, {"least_docs": 9, "least_chars": 1}):
        rule = {k: v for k, v in options.items() if k.startswith("least")}
        assert found(docs, **options) == brute(rows, **rule), options


def test_awkward_rows(spark):
    line = "this very line stands in many documents"
    more = [(30 + k, f"{line}\n{line.upper()}\nown line of number {k} in here\n") for k in range(4)] + [(None, line), (33, line), (33, "no\n" + line)]
    docs = frame(spark, awkward() + [(i, t, *[None] * 10) for i, t in more])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, batches=3) == brute(rows)
    assert found(docs.withColumnsRenamed({"doc_id": "n_lines", "text": "h1"}), id_col="n_lines", text_col="h1") == brute(rows)


def test_a_line_of_every_document(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('one line that every document has\n', id) as text")
    kept = L.dedup_lines(docs).where("n_dropped = 0").collect()
    assert [r.doc_id for r in kept] == [2999]


def test_empty_table(spark):
    docs = frame(spark, awkward()).limit(0)
    assert L.dedup_lines(docs).count() == 0


def test_runs_are_levelled_and_merge_without_a_shuffle(spark):
    runs = L.Runs(spark, fanout=3)
    for k in range(7, 0, -1):
        batch = spark.range(50).selectExpr(f"{k} * 100 + id as doc_id", f"id % {k * 5} as h1", "id % 2 as h2")
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 2]
    assert "Exchange" not in runs.merged()._jdf.queryExecution().executedPlan().toString()
    assert runs.merged().count() == runs.entries().select("h1", "h2").distinct().count()
    want = {}
    for k in range(7, 0, -1):
        for i in range(50):
            want.setdefault((i % (k * 5), i % 2), set()).add(k * 100 + i)
    got = {(r.h1, r.h2): r.holder for r in runs.decided().collect()}
    assert got == {key: max(ids) for key, ids in want.items() if len(ids) >= 3}
    runs.clear()
    assert not spark.catalog.tableExists(runs.name)
