import hashlib

from cases import awkward, frame
from test_simhash import plain_fingerprint, plain_roots

import corpus_pipeline
from stakeline.llm import catalog, language

WORDS = "the river runs past stones and trees to the far sea while people walk along its banks every day of the year"


def test_stages_and_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in catalog.queries()
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in catalog.queries()} - {"pipeline"}


def test_each_stage_does_its_part(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = [(i, f"{WORDS} number {i} {WORDS[i:]} {WORDS[:2 * i + 20]}", "en", "s", 1, *[None] * 7) for i in range(40)]
    rows += [(100, rows[5][1], "en", "s", 1, *[None] * 7), (101, f"now {item} then", "en", "s", 1, *[None] * 7),
             (102, "here the password=0123456789abcdef00 was told to all people by the river", "en", "s", 1, *[None] * 7),
             (103, None, "en", "s", 1, *[None] * 7), (104, "12 34", "en", "s", 1, *[None] * 7)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < 4:
            assert out.columns == now.columns
        path = f"{tmp_path}/stage{k}"
        out.write.parquet(path)
        now = spark.read.parquet(path)
        left.append({r.doc_id: r for r in now.collect()})
    model = language.Model(catalog.learned_languages(docs))
    assert set(left[0]) == {r[0] for r in rows if model.predict(r[1])[2]}
    assert {103, 104}.isdisjoint(left[0])
    prints = {i: plain_fingerprint(r.text) for i, r in left[0].items()}
    roots = plain_roots(set(prints.values()))
    assert set(left[1]) == {min(i for i in prints if roots[prints[i]] == root) for root in set(roots.values())}
    assert 100 not in left[1] and {101, 102} <= set(left[1])
    assert set(left[2]) == set(left[1]) - {101} and set(left[3]) == set(left[2]) == set(left[4])
    assert left[3][102].text == "here the password=[SECRET] was told to all people by the river"
    assert left[3][102].n_chars == len(left[3][102].text)
    for doc_id, r in left[4].items():
        assert r.decoded_sha256 == hashlib.sha256(left[3][doc_id].text.encode()).hexdigest()
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, left[4].values()))


def test_awkward_and_empty_tables(spark, tmp_path):
    for name, rows in (("awkward", awkward()), ("empty", [])):
        where = f"{tmp_path}/{name}"
        frame(spark, rows).write.parquet(f"{where}/documents.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{where}/benchmark.parquet")
        assert corpus_pipeline.run(spark, where).count() <= len(rows)
