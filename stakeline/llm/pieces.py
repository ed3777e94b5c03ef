"""Work done once per distinct pre-token of a corpus (used by operators 3 and 8).

Documents are gathered in blocks of about ``BLOCK_BYTES`` of text. Within a block each pre-token is kept
once and texts become the numbers of their pre-tokens, by position. The block's pre-tokens are dealt by a
hash into buckets and sent there packed, so that the shuffle meets each pre-token once per block, however
frequent it is. In its bucket a pre-token is treated once, for all blocks. The results go back to the block
in the order in which its pre-tokens were sent and are put in place of their numbers.

The documents are read twice: once for the pre-tokens, once for the numbers. So nothing but packed
pre-tokens, their results and the numbers are shuffled, and no table is written. A block is named by a
digest of what it holds, so both readings must agree on it; a block without its results raises.

A bucket holds one row per block and a block is bounded, so a frequent pre-token or a frequent document
does not make a hot key. Memory: one block, and the distinct pre-tokens of one bucket. The number of
buckets is the root of the measured bytes of text: distinct pre-tokens grow about as fast as that, so a
bucket holds about as many at any size, while a block still has many pre-tokens for each row it sends
(0.5 GB: 21 buckets, 30 GB: 169, 100 TB: about 10,000). Every bucket is a partition of its own.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_arrow

#: Bytes of text of one block, at least one document, and fewest buckets.
BLOCK_BYTES, BUCKETS = 8 << 20, 16
#: Bytes of text for which there is one bucket; for ``n`` squared times as many there are ``n``.
BUCKET_BYTES = 1 << 20
_ROW = "block string, bucket int, docs binary, payload binary"
_ARROW = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("docs", pa.binary()), ("payload", pa.binary())])
_CODES = -1


def pack_strings(values: list[bytes]) -> bytes:
    """Lengths and bytes of many strings, compressed."""
    import zstandard

    lengths = np.array([len(v) for v in values], dtype=np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(
        len(values).to_bytes(4, "little") + lengths.tobytes() + b"".join(values))


def unpack_strings(blob: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, dtype=np.uint32, count=n, offset=4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate([[4 + 4 * n], ends[:-1]]) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers below 2**32 by planes of bytes, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack_numbers(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


@dataclass
class Block:
    """Documents with their pre-tokens as numbers: ``codes[bounds[i]:bounds[i + 1]]`` are those of row i."""

    rows: list[dict]
    bounds: np.ndarray
    codes: np.ndarray


class _Gathering:
    def __init__(self):
        self.rows, self.texts, self.size = [], [], 0

    def add(self, row: dict, text: str):
        self.rows.append(row)
        self.texts.append(text)
        self.size += len(text)

    def emit(self, split: Callable[[str], list], part: str, buckets: int) -> Iterator[pa.RecordBatch]:
        import pickle
        import zlib

        import xxhash

        numbers: dict = defaultdict()
        numbers.default_factory = numbers.__len__
        digest, codes, bounds = xxhash.xxh3_128(), [], [0]
        for text in self.texts:
            raw = text.encode("utf-8", "surrogatepass")
            digest.update(len(raw).to_bytes(8, "little") + raw)
            codes.append(np.fromiter(map(numbers.__getitem__, split(text)), dtype=np.uint32))
            bounds.append(bounds[-1] + len(codes[-1]))
        name = digest.hexdigest()
        if part == "codes":
            docs = pickle.dumps((self.rows, np.array(bounds)))
            payload = pack_numbers(np.concatenate(codes)), len(numbers).to_bytes(4, "little")
            yield pa.record_batch([[name], [_CODES], [docs], [payload[1] + payload[0]]], schema=_ARROW)
            return
        dealt: list[list[bytes]] = [[] for _ in range(buckets)]
        local: list[list[int]] = [[] for _ in range(buckets)]
        for number, piece in enumerate(numbers):
            raw = piece if isinstance(piece, bytes) else piece.encode("utf-8", "surrogatepass")
            k = zlib.crc32(raw) % buckets
            dealt[k].append(raw)
            local[k].append(number)
        full = [k for k in range(buckets) if dealt[k]]
        yield pa.record_batch([[name] * len(full), full, [pack_numbers(np.array(local[k])) for k in full],
                               [pack_strings(dealt[k]) for k in full]], schema=_ARROW)


def _blocks(split_factory, part: str, buckets: int, keep: list[str], block_bytes: int):
    def work(batches):
        split, gathering = split_factory(), _Gathering()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows = batch.select(keep).to_pylist() if part == "codes" and keep else [{} for _ in texts]
            for row, text in zip(rows, texts):
                gathering.add(row, text or "")
                if gathering.size >= block_bytes:
                    yield from gathering.emit(split, part, buckets)
                    gathering = _Gathering()
        if gathering.rows:
            yield from gathering.emit(split, part, buckets)
    return work


def bucket_count(n_bytes: int) -> int:
    """Buckets for so many bytes of text."""
    return max(BUCKETS, math.isqrt(max(0, n_bytes) // BUCKET_BYTES))


def once_per_piece(docs: DataFrame, text_col: str, keep: list[str], split_factory: Callable[[], Callable],
                   treat_factory: Callable[[], Callable[[list[bytes]], bytes]],
                   finish: Callable[[Block, Iterator[tuple[np.ndarray, bytes]], int], pa.RecordBatch],
                   schema: str, *, buckets: int | None = None, block_bytes: int = BLOCK_BYTES,
                   then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """Splits texts, treats each distinct pre-token once and finishes each block with the results.

    ``split_factory()`` gives a function from a text to its pre-tokens; ``treat_factory()`` one from the
    pre-tokens of one block and bucket to a packed result in the same order; ``finish(block, parts, n)``
    gets (numbers of the pre-tokens, packed result) of each bucket and their count ``n``. ``then`` goes on
    with the finished batches in the same worker.
    """
    buckets = buckets or bucket_count(docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0)
    source = docs.select(F.col(text_col).alias("__text"), *keep)

    def treat(batches):
        treat_bucket, bucket = None, None
        for batch in batches:
            out = []
            for b, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
                if b != bucket:  # a new memory for each bucket
                    treat_bucket, bucket = treat_factory(), b
                out.append(treat_bucket(unpack_strings(payload)))
            yield batch.set_column(3, _ARROW.field(3), pa.array(out, pa.binary()))

    def put_back(batches):
        import pickle

        block, name, left, parts, count = None, None, 0, [], 0

        def done():
            if block is None or left:
                raise RuntimeError(f"block {name}: its pre-tokens and its numbers do not belong together")
            return finish(block, iter(parts), count)

        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != name:
                    if name is not None:
                        yield done()
                    block, name, left, parts, seen = None, row["block"], None, [], set()
                if row["bucket"] == _CODES:
                    rows, bounds = pickle.loads(row["docs"])
                    if block is None:
                        count = left = int.from_bytes(row["payload"][:4], "little")
                        block = Block(rows, bounds, unpack_numbers(row["payload"][4:]))
                    else:  # equal blocks: the same texts in the same order
                        block = Block(block.rows + rows, np.concatenate([block.bounds, bounds[1:] + block.bounds[-1]]),
                                      np.concatenate([block.codes, unpack_numbers(row["payload"][4:])]))
                elif row["bucket"] not in seen:
                    seen.add(row["bucket"])
                    parts.append((unpack_numbers(row["docs"]), row["payload"]))
                    left -= len(parts[-1][0])
        if name is not None:
            yield done()

    words = map_arrow(source.select("__text"), _blocks(split_factory, "pieces", buckets, [], block_bytes), _ROW)
    codes = map_arrow(source, _blocks(split_factory, "codes", buckets, keep, block_bytes), _ROW)
    treated = map_arrow(words.repartitionById(buckets, "bucket").sortWithinPartitions("bucket"), treat, _ROW)
    back = treated.unionByName(codes).repartition("block").sortWithinPartitions("block", "bucket")
    return map_arrow(back, (lambda batches: then(put_back(batches))) if then else put_back, schema)


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
