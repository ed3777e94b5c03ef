"""Token counts without ids (operator 3).

Every distinct pre-token is counted once by the tokenizer; the counts are joined to the pre-token
frequencies of each document and summed. See ``pieces`` for how the rows travel.

A text may be cut where no piece of the model reaches across: before a run of blanks, and on both sides of
a line break. ``sentencepiece_cut_is_safe`` checks that of the model at hand: no piece has a blank after
another character, none of several characters has a line break.

Defined cases: a null text counts as an empty one, with no bytes and no tokens; repeated rows give repeated
results; ids may be null; other columns do not matter.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import id_and_text
from .pieces import BLOCK_BYTES, once_per_piece, pack_numbers, per_document, unpack_numbers

LIMIT = 4096
_BLANK = "▁"


def sentencepiece_cut_is_safe(model) -> bool:
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return not any(_BLANK in p.lstrip(_BLANK) or len(p) > 1 and "\n" in p for p in pieces)


def _splitter():
    find = re.compile(r" +[^ \n]*|[^ \n]+|\n").findall

    def split(text: str) -> list[str]:
        # the model reads its blank sign like a blank, and puts a blank before a text
        return find(" " + text.replace(_BLANK, " ")) if text else []
    return split


def _counter(model_path: str):
    def treat_factory():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if not sentencepiece_cut_is_safe(model):
            raise ValueError("this model has pieces that reach across blanks or line breaks")
        known: dict[bytes, int] = {}

        def treat(pieces: list[bytes]) -> bytes:
            new = [p for p in pieces if p not in known]
            # the model adds one blank; where a pre-token has none, a line break takes it: two more tokens
            texts = [p[1:] if p[:1] == b" " else b"\n" + p for p in new]
            for p, ids in zip(new, model.encode([t.decode("utf-8", "surrogatepass") for t in texts], num_threads=1)):
                # an empty text would have no tokens, yet the blank alone is one
                known[p] = (len(ids) or 1) if p[:1] == b" " else len(ids) - 2
            return pack_numbers(np.array([known[p] for p in pieces]))
        return treat
    return treat_factory


def _finish(arrow: pa.Schema):
    def finish(block, parts, n):
        counts = np.zeros(max(n, 1), dtype=np.int64)
        for numbers, packed in parts:
            counts[numbers] = unpack_numbers(packed)
        tokens = per_document(counts[block.codes], block.bounds)
        return pa.record_batch([pa.array([r["doc_id"] for r in block.rows], arrow.field("doc_id").type),
                                pa.array([r["n_bytes"] for r in block.rows], pa.int64()),
                                pa.array(tokens, pa.int64())], schema=arrow)
    return finish


def count_tokens(docs: DataFrame, model_path: str, *, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document, by a sentencepiece model."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = id_and_text(docs, id_col, text_col).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    kind = docs.schema["doc_id"].dataType
    arrow = pa.schema([("doc_id", to_arrow_type(kind)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    counted = once_per_piece(docs, "text", ["doc_id", "n_bytes"], lambda: _splitter(), _counter(model_path),
                             _finish(arrow), f"doc_id {kind.simpleString()}, n_bytes bigint, n_tokens bigint",
                             block_bytes=block_bytes)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
