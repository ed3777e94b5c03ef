import base64
import hashlib
import random

import pytest
from cases import awkward, frame, invented

from stakeline.llm import byte_bpe as B
from stakeline.llm import pieces as PC
from stakeline.llm import token_counts as T

public = pytest.importorskip("public_tokenizers")
RANKS, MODEL = public.path("byte_bpe_multi_50k.tiktoken"), public.path("piece_bpe_32k.model")
SIGNS = list("ab s'tmdrevl  \n\t1٢.,!é中\u0085　́Ⅷ½▁<>\x00") + ["<s>", "'ll", "🙂"]


def odd_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(SIGNS) for _ in range(rnd.randrange(0, 15))) for _ in range(n)]


def rows_of(spark):
    rows = awkward() + [(100 + i, t, *[None] * 10) for i, t in enumerate(odd_texts(300, 4))]
    rows += [(1000 + i, t, *[None] * 10) for i, t in invented(100)]
    return frame(spark, [tuple(r[:2]) + tuple(r[2:]) for r in rows])


def test_pre_tokens_are_those_of_the_pattern():
    regex = pytest.importorskip("regex")
    pattern = regex.compile(public.PATTERN)
    for text in odd_texts(20_000, 1):
        assert B.pre_tokens(text) == pattern.findall(text), repr(text)


@pytest.mark.parametrize("block_bytes", [PC.BLOCK_BYTES, 500])
def test_encoding_and_round_trip(spark, block_bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = rows_of(spark)
    got = B.digests(B.decode(B.encode(docs, RANKS, block_bytes=block_bytes), RANKS)).collect()

    def want(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(want(r.doc_id, r.text)) for r in docs.collect())


@pytest.mark.parametrize("block_bytes", [PC.BLOCK_BYTES, 500])
def test_counts(spark, block_bytes):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = rows_of(spark)
    got = T.count_tokens(docs, MODEL, block_bytes=block_bytes).collect()

    def want(r):
        n = len(model.encode(r.text or ""))
        return (r.doc_id, len((r.text or "").encode()), n, n > T.LIMIT)
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(want(r)) for r in docs.collect())


def test_empty_table(spark):
    docs = frame(spark, [])
    assert T.count_tokens(docs, MODEL).count() == 0
    assert B.decode(B.encode(docs, RANKS), RANKS).count() == 0


@pytest.mark.parametrize("ids_at_once", [B.SLICE_IDS, 40])
def test_decoding_in_the_worker_that_encodes(spark, monkeypatch, ids_at_once):
    monkeypatch.setattr(B, "SLICE_IDS", ids_at_once)
    docs = rows_of(spark)
    fused = B.encode(docs, RANKS, block_bytes=900, decoded_col="bytes of the text")
    assert fused.columns == ["doc_id", "token_ids", "bytes of the text"]
    apart = B.decode(B.encode(docs, RANKS, block_bytes=900), RANKS)
    assert sorted(map(repr, map(tuple, fused.collect()))) == sorted(map(repr, map(tuple, apart.collect())))
    assert sorted(repr((r[0], bytes(r[2]).decode())) for r in fused.collect()) == sorted(repr((r.doc_id, r.text or "")) for r in docs.collect())


def test_decoding_null_and_unknown_ids(spark):
    frame_ = spark.createDataFrame([(1, None), (2, []), (3, [5])], "doc_id int, token_ids array<int>")
    got = {r.doc_id: r.decoded for r in B.decode(frame_, RANKS).collect()}
    assert got[1] is None and got[2] == b"" and len(got[3]) == 1
    with pytest.raises(Exception):
        B.decode(spark.createDataFrame([(1, [-1])], "doc_id int, token_ids array<int>"), RANKS).collect()


def test_buckets_follow_the_data(spark, monkeypatch):
    assert [PC.bucket_count(n) for n in (0, 100 << 20, 30 << 30, 100 << 40)] == [16, 16, 175, 10240]
    docs = rows_of(spark)
    few = sorted(map(repr, T.count_tokens(docs, MODEL, block_bytes=500).collect()))
    monkeypatch.setattr(PC, "BUCKET_BYTES", 4)  # more buckets than most blocks have pre-tokens
    assert sorted(map(repr, T.count_tokens(docs, MODEL, block_bytes=500).collect())) == few
