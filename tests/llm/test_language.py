import random

from cases import awkward, frame

from stakeline.llm import language as L

WORDS = {"en": "the of and stone river with which that through", "de": "der die und stein fluss mit durch nicht für",
         "fr": "le la et pierre rivière avec dans pour être"}


def labelled(n, seed=1):
    rnd = random.Random(seed)
    names = sorted(WORDS)
    return [(1000 + i, " ".join(rnd.choice(WORDS[names[i % 3]].split()) + rnd.choice(["", "en", "s"]) for _ in range(40)), names[i % 3])
            for i in range(n)]


def test_held_out_accuracy(spark):
    model = L.learn(spark.createDataFrame(labelled(90), "doc_id bigint, text string, lang string"))
    assert sorted(model) == ["de", "en", "fr"]
    fresh = labelled(60, 2)
    got = L.predict(spark.createDataFrame(fresh, "doc_id bigint, text string, lang string"), model).collect()
    assert sum(r.lang_pred == lang for r, (_, _, lang) in zip(sorted(got), fresh)) >= 58
    assert all(0 <= r.score <= 1 for r in got)


def test_awkward_rows(spark):
    docs = frame(spark, awkward())
    model = L.learn(docs)
    got = L.predict(docs, model)
    assert got.count() == docs.count()
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert all(by[d].lang_pred == "und" and by[d].score == 0 and not by[d].accepted for d in (3, 4, 5))
    assert by[1].lang_pred == "en" and by[1].score == 1.0
    kept = L.keep_accepted(docs, model)
    assert kept.columns == docs.columns and {3, 4, 5}.isdisjoint({r.doc_id for r in kept.collect()})


def test_nothing_to_learn_from(spark):
    empty = frame(spark, [])
    assert L.learn(empty) == {} and L.predict(empty, {}).count() == 0
    assert {r.lang_pred for r in L.predict(frame(spark, awkward()), {}).collect()} == {"und"}


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.createDataFrame(labelled(90), "doc_id bigint, text string, lang string")
    assert L.learn(docs, sample_rows=5) == L.learn(docs.repartition(7), sample_rows=5)


def test_narrow_margins_are_rejected():
    model = L.Model({"a": b"one two three", "b": b"one two three"})
    name, score, accepted = model.predict("one two three")
    assert (name, score, accepted) == ("a", 0.0, False)


def test_all_sampled_texts_are_in_the_dictionary(spark):
    """Long texts count by parts from begin to end, so that every one of them has a share."""
    def name(i):
        return "".join(chr(97 + int(c)) for c in f"{i:04d}")
    filler = "plain words of no weight " * 400
    rows = [(i, f"{name(i)}qq {filler} {name(i)}zz", "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.learn(docs)["en"].decode()
    assert len(model) <= L.DICTIONARY_BYTES
    assert sum(f"{name(i)}qq" in model for i in range(200)) == 200
    assert sum(f"{name(i)}zz" in model for i in range(200)) == 200


def test_learning_equals_a_plain_version(spark):
    docs = spark.createDataFrame(labelled(90) + [(None, "the of and", "en"), (5, None, "en"), (6, "der die", None)],
                                 "doc_id bigint, text string, lang string")
    texts = {}
    for i, text, lang in labelled(90):
        texts.setdefault(lang, []).append((i, L.folded(text)))
    assert L.learn(docs) == {lang: b" ".join(dict.fromkeys(t for _, t in sorted(found))) for lang, found in texts.items()}


def brute(text, dictionaries):
    """The smallest encoding, chunk by chunk."""
    import zstandard

    data = L.folded(text or "")
    if not data.strip():
        return "und"
    levels = L.SHORT_LEVELS if len(data) < L.SHORT_BYTES else (L.LEVEL,)
    sizes = {}
    for lang, content in dictionaries.items():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sizes[lang] = 0
        for level in levels:
            encoder = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False, write_checksum=False,
                                               write_dict_id=False)
            sizes[lang] += sum(len(encoder.compress(data[k:k + L.CHUNK_BYTES])) for k in range(0, len(data), L.CHUNK_BYTES))
    return min(sorted(sizes), key=sizes.get)


def test_predictions_equal_a_plain_version(spark):
    model = L.learn(spark.createDataFrame(labelled(90), "doc_id bigint, text string, lang string"))
    texts = [text for _, text, _ in labelled(30, 3)] + ["", None, "123", "der stein " * 3000, "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.lang_pred for r in L.predict(docs, model).collect()} == {i: brute(t, model) for i, t in enumerate(texts)}


def test_query_on_awkward_rows(spark, tmp_path):
    from stakeline.llm import catalog

    frame(spark, awkward()).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op7_language(spark, str(tmp_path))
    assert got.count() == len(awkward())
    assert got.where("held_out is null or lang_pred is null or score is null or score < 0 or score > 1").count() == 0
    assert got.where("doc_id is null and held_out").count() == 0
