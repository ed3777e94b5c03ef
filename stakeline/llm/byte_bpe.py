"""Byte-level BPE encoding and decoding (operator 8).

Texts become pre-tokens with positions; each distinct pre-token goes through the global shuffle once per
block and is encoded once; the ids are joined back and put together by position (see ``pieces``). Decoding
looks ids up in the table of token bytes, which has one entry per vocabulary entry.

Pre-tokens are those of the usual pattern: contractions, an optional blank with letters, digits or other
signs, and white space, of which a run gives its last character to what follows it. They are found for a
whole text at once, from the class of each character: letter, number, white space or other.

Defined cases: a null text is an empty one, with no ids; an id outside the table raises; repeated rows give
repeated results; a lone surrogate cannot occur in Spark strings; other columns do not matter.
"""

from __future__ import annotations

import base64
import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import id_and_text, map_arrow
from .pieces import BLOCK_BYTES, once_per_piece, pack_strings, unpack_strings

# fixed values: the white space of Unicode, and the contractions of the pattern
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
#: Ids that are decoded together.
SLICE_IDS = 1 << 18


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, _OTHER, dtype=np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = _LETTER
        elif kind == "N":
            table[code] = _NUMBER
    table[WHITE_SPACE] = _SPACE
    return table


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text; together they are the text."""
    if not text:
        return []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _classes()[points]
    n = len(kind)
    cut = np.empty(n, dtype=bool)
    cut[0] = True
    cut[1:] = kind[1:] != kind[:-1]
    space = kind == _SPACE
    # the last of a run of white space stands apart where something follows; a blank joins what follows
    last = np.flatnonzero(space[:-1] & ~space[1:]) if n > 1 else np.empty(0, dtype=np.int64)
    cut[last] = True
    cut[last[points[last] == 32] + 1] = False
    # contractions: an apostrophe that begins a match, then one of the listed endings
    for at in np.flatnonzero(points == 39).tolist():
        if at + 1 < n and kind[at + 1] == _LETTER and cut[at]:
            ending = next((c for c in CONTRACTIONS if text.startswith(c, at + 1)), None)
            if ending:
                cut[at + 1] = False
                if at + 1 + len(ending) < n:
                    cut[at + 1 + len(ending)] = cut[at + 1 + len(ending)] or kind[at + 1 + len(ending)] != _SPACE
    starts = np.flatnonzero(cut).tolist()
    return [text[a:b] for a, b in zip(starts, [*starts[1:], n])]


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _encoder(ranks_path: str):
    def treat_factory():
        encoding = _encoding(ranks_path)
        known: dict[bytes, bytes] = {}

        def treat(pieces: list[bytes]) -> bytes:
            for p in pieces:
                if p not in known:
                    known[p] = np.array(encoding.encode_single_token(p) if p in encoding._mergeable_ranks
                                        else encoding._encode_single_piece(p), dtype="<u4").tobytes()
            return pack_strings([known[p] for p in pieces])
        return treat
    return treat_factory


@functools.cache
def _encoding(ranks_path: str):
    import tiktoken

    # pre-tokens are made here; the pattern is only asked for by the constructor
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=load_ranks(ranks_path), special_tokens={})


def _finish(arrow: pa.Schema):
    def finish(block, parts, n):
        ids: list = [None] * n
        for numbers, packed in parts:
            for number, blob in zip(numbers.tolist(), unpack_strings(packed)):
                ids[number] = blob
        flat = np.frombuffer(b"".join(ids), dtype="<u4") if n else np.empty(0, dtype="<u4")
        length = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        start = np.cumsum(length) - length
        lists = []
        for a, b in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist()):
            codes = block.codes[a:b]
            many = length[codes]
            place = np.arange(many.sum()) + np.repeat(start[codes] - (np.cumsum(many) - many), many)
            lists.append(flat[place].astype(np.int32))
        values = np.concatenate(lists) if lists else np.empty(0, dtype=np.int32)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        return pa.record_batch([pa.array([r["doc_id"] for r in block.rows], arrow.field(0).type),
                                pa.ListArray.from_arrays(pa.array(ends), pa.array(values)).cast(arrow.field(1).type)],
                               schema=arrow)
    return finish


def encode(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, decoded_col: str | None = None) -> DataFrame:
    """``doc_id, token_ids`` per document, with the bytes that they decode to in ``decoded_col`` where one is named.

    Decoding goes on in the worker that put the ids together, so that ids don't travel in between.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    docs = id_and_text(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType
    arrow = pa.schema([("doc_id", to_arrow_type(kind)), ("token_ids", pa.list_(pa.int32()))])
    schema = f"doc_id {kind.simpleString()}, token_ids array<int>"
    then = decoder(ranks_path, 1, decoded_col) if decoded_col else None
    return once_per_piece(docs, "text", ["doc_id"], lambda: pre_tokens, _encoder(ranks_path), _finish(arrow),
                          f"{schema}, `{decoded_col}` binary" if decoded_col else schema, block_bytes=block_bytes, then=then)


def decode(encoded: DataFrame, ranks_path: str, *, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col``, the bytes of the tokens in ``ids_col`` (binary); null ids give null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + f", `{out_col}` binary"
    return map_arrow(encoded, decoder(ranks_path, encoded.columns.index(ids_col), out_col), schema)


def decoder(ranks_path: str, place: int, out_col: str):
    """A function that adds to batches the bytes of the ids in column ``place``, by the table of token bytes."""
    def work(batches):
        ranks = load_ranks(ranks_path)
        length = np.full(max(ranks.values()) + 1, -1, dtype=np.int64)
        for token, rank in ranks.items():
            length[rank] = len(token)
        tokens = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), dtype=np.uint8)
        start = np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
        for batch in (part for b in batches for part in slices(b, place)):
            ids = batch.column(place)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(length) or length[flat].min() < 0):
                raise ValueError("a token id is not in the table")
            many, size = length[flat], ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(many)])
            index = np.int32 if ends[-1] + len(tokens) < 2**31 else np.int64
            data = tokens[np.arange(ends[-1], dtype=index) + np.repeat((start[flat] - ends[:-1]).astype(index), many)].tobytes()
            bounds = ends[np.concatenate([[0], np.cumsum(size)])].tolist()
            out = [None if gone else data[a:b] for gone, a, b in zip(ids.is_null().to_pylist(), bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, out_col])
    return work


def slices(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Rows with about ``SLICE_IDS`` ids at most together, which bounds the index arrays; a longer row stands alone."""
    upto = np.cumsum(batch.column(place).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + SLICE_IDS, side="right")))
        yield batch.slice(at, end - at)
        at = end


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded documents."""
    ids = F.concat_ws(",", F.col("token_ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
                          F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
