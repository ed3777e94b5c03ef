"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 2).

Words are runs of ASCII digits, letters (lower-cased) and all non-ASCII characters. A test string is a
window of ``width`` words of a benchmark item, or the whole item where it has fewer. Texts and test
strings are written as bytes, one blank after each word, so a search over bytes finds word windows:

* a block shift table tells, for the block of bytes that ends at a position, how far the search may
  jump without missing an occurrence;
* where the shift is zero, the bucket of that suffix block names the possible test strings;
* the bytes are then compared directly.

Test strings are put into classes by length, so that a short one does not shorten the jumps of the long
ones. Many places of a batch are searched at the same time, each with its own jumps.

Defined cases: a null or wordless text has no words and is not contaminated; items without words give no
test strings; an item that is there twice counts twice if its ids differ; an item with a null id marks the
words that it hits, but is neither listed nor counted; with no benchmark every document is clean; repeated rows give repeated results; a null ``doc_id`` stays null. Other columns of the
documents do not matter. Texts are searched whole, in slices of whole documents.

The benchmark goes to the tasks in blocks of about ``block_bytes`` of text at most (an item is not divided),
which is checked first; the driver holds one block at a time. More blocks mean more passes over the
documents, each written before the next block is fetched, whose hits are then united per document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import id_and_text, map_arrow, settle, texts_as_bytes

WIDTH = 13
#: Most bytes of benchmark text in one set of search tables.
BLOCK_BYTES = 4 << 20
#: Bytes of text searched at once, and places searched side by side: one for so many bytes.
SLICE_BYTES, LANE_BYTES = 4 << 20, 512
SEPARATOR = 10
_TABLE_BITS = 18
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
#: Lower-cases A-Z; all other ASCII but digits and letters becomes a blank.
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def test_strings(items: list[tuple], width: int = WIDTH) -> dict[bytes, list]:
    """Each test string with the ids of the items it comes from."""
    found: dict[bytes, list] = {}
    for item_id, text in items:
        words = words_of(text or "")
        for i in range(max(1, len(words) - width + 1) if words else 0):
            ids = found.setdefault(b" ".join(words[i:i + width]) + b" ", [])
            if not ids or ids[-1] != item_id:
                ids.append(item_id)
    return found


class Tables:
    """Shift table and suffix buckets of test strings of similar length."""

    def __init__(self, strings: list[bytes], numbers: list[int]):
        self.strings, self.least = strings, min(map(len, strings))
        self.block = min(16, max(1, self.least // 2))
        heads = np.frombuffer(b"".join(s[:self.least] for s in strings), dtype=np.uint8).reshape(len(strings), -1)
        self.shift = np.full(1 << _TABLE_BITS, self.least - self.block + 1, dtype=np.int32)
        for end in range(self.block, self.least + 1):
            np.minimum.at(self.shift, self._hash(heads[:, end - self.block:end]), self.least - end)
        suffix = self._hash(heads[:, self.least - self.block:])
        self.members = np.argsort(suffix, kind="stable")
        counts = np.bincount(suffix, minlength=1 << _TABLE_BITS)
        self.bucket = np.concatenate([[0], np.cumsum(counts)])
        self.heads, self.numbers = heads, numbers

    def _hash(self, blocks: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(blocks), 16), dtype=np.uint8)
        padded[:, :self.block] = blocks
        return ((padded.view(np.uint64) * _MIX).sum(axis=1) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, data: np.ndarray, raw: bytes) -> Iterator[tuple[int, int]]:
        """(start, number of the test string) of every occurrence at a word start."""
        if len(data) < self.least:
            return
        views = np.lib.stride_tricks.sliding_window_view(data, self.block)
        at = np.arange(self.least - 1, len(data), LANE_BYTES)
        stop = np.minimum(at + LANE_BYTES, len(data))
        while len(at):
            slot = self._hash(views[at - self.block + 1])
            shift = self.shift[slot]
            zero = np.flatnonzero(shift == 0)
            if len(zero):
                yield from self._confirm(at[zero] - self.least + 1, slot[zero], data, raw)
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]

    def _confirm(self, starts, slots, data, raw):
        first = (starts == 0) | (data[starts - 1] == 32) | (data[starts - 1] == SEPARATOR)
        starts, slots = starts[first], slots[first]
        many = self.bucket[slots + 1] - self.bucket[slots]
        starts = np.repeat(starts, many)
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        string = self.members[np.repeat(self.bucket[slots], many) + offset]
        same = data[starts] == self.heads[string, 0]
        for start, s in zip(starts[same].tolist(), string[same].tolist()):
            pattern = self.strings[s]
            if raw[start:start + len(pattern)] == pattern:
                yield start, self.numbers[s]


class Searcher:
    def __init__(self, items: list[tuple], width: int = WIDTH):
        found = test_strings(items, width)
        self.strings, self.ids = list(found), list(found.values())
        self.widths = np.array([s.count(b" ") for s in self.strings], dtype=np.int64)
        classes: dict[int, list[int]] = {}
        for n, s in enumerate(self.strings):
            classes.setdefault(len(s).bit_length(), []).append(n)
        self.tables = [Tables([self.strings[n] for n in ns], ns) for ns in classes.values()]

    def search(self, texts: list[bytes]) -> list[tuple[int, list, list]]:
        """(words, hit spans as [first word, end), item ids) of each text."""
        joined = np.frombuffer(b"".join(t + b" \n" for t in texts).translate(_WORD_BYTES), dtype=np.uint8).copy()
        ends = np.cumsum([len(t) + 2 for t in texts])
        joined[ends - 1] = SEPARATOR
        word = (joined != 32) & (joined != SEPARATOR)
        keep = word | (joined == SEPARATOR)
        keep[1:] |= word[:-1]
        data = joined[keep]
        raw = data.tobytes()
        word = word[keep]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        word_at = np.flatnonzero(begins)
        last_word = np.searchsorted(word_at, np.flatnonzero(data == SEPARATOR))
        first_word = np.concatenate([[0], last_word[:-1]])
        spans: dict[int, list] = {}
        items: dict[int, set] = {}
        hits = [hit for tables in self.tables for hit in tables.search(data, raw)]
        if hits:
            at = np.searchsorted(word_at, [h[0] for h in hits])
            doc = np.searchsorted(last_word, at, side="right")
            for (_, n), w, d in zip(hits, at.tolist(), doc.tolist()):
                low = w - int(first_word[d])
                spans.setdefault(d, []).append((low, low + int(self.widths[n])))
                items.setdefault(d, set()).update(self.ids[n])
        return [(int(last_word[d] - first_word[d]), united(spans.get(d, ())), sorted(items.get(d, ()), key=str))
                for d in range(len(texts))]


def united(spans) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_bytes`` at most, by the measured size of the table, one at a time."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) if size else 0
    if count <= 1:
        if count:
            yield [tuple(r) for r in items.collect()]
        return
    # sorted by block, so that a block is read from few row groups
    dealt = settle(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * count)))
                   .repartitionByRange("block").sortWithinPartitions("block"), "items")
    for k in range(2 * count):
        block = [tuple(r) for r in dealt.where(F.col("block") == k).select("item_id", "text").collect()]
        if block:
            yield block


_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64())])
_HITS = "doc_id bigint, copy_of string, n_words bigint, spans array<struct<first:bigint,end:bigint>>, items array<string>"


def _search_block(docs: DataFrame, items: list[tuple], width: int, keyed: bool) -> DataFrame:
    def work(batches):
        import xxhash

        searcher = Searcher(items, width)
        for batch in batches:
            texts = [t or b"" for t in texts_as_bytes(batch.column("text"))]
            found = [x for a, b in slices(texts) for x in searcher.search(texts[a:b])]
            yield pa.record_batch([
                batch.column("doc_id"),
                pa.array([xxhash.xxh3_128_hexdigest(t) if keyed else None for t in texts], pa.string()),
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[{"first": a, "end": b} for a, b in s] for _, s, _ in found], pa.list_(_SPAN)),
                pa.array([[str(i) for i in ids if i is not None] for _, _, ids in found], pa.list_(pa.string())),
            ], names=["doc_id", "copy_of", "n_words", "spans", "items"])
    return map_arrow(docs, work, _HITS.replace("doc_id bigint", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans, items``.

    ``spans`` are the hit words as [first, end) word numbers, ``items`` the ids (as text, sorted) of the
    items with a window in the document.
    """
    docs = id_and_text(docs, id_col, text_col)
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _search_block(docs, first, width, False).drop("copy_of")
    merged = _merged(docs, chain([first, second], blocks), width)
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "n_words", "spans", "items")


def _merged(docs: DataFrame, blocks: Iterable[list[tuple]], width: int) -> DataFrame:
    """``doc_id, copy_of, copies, n_words, spans, items`` per distinct row, from one pass for each block.

    The hits of a block are written before the next block is fetched, so the driver holds one block and a
    lost executor costs running tasks only. Later blocks add rows only for documents that they hit.
    """
    parts = []
    for k, items in enumerate(blocks):
        part = _search_block(docs, items, width, True)
        parts.append(settle((part if k == 0 else part.where(F.size("spans") > 0)).withColumn("block", F.lit(k)), "hits"))
    grouped = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "copy_of").agg(
        F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).alias("copies"),
        F.first("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )

    def unite(batches):
        for batch in batches:
            spans = [[{"first": a, "end": b} for a, b in united((s["first"], s["end"]) for s in row)]
                     for row in batch.column("spans").to_pylist()]
            k = batch.schema.get_field_index("spans")
            yield batch.set_column(k, pa.field("spans", pa.list_(_SPAN)), pa.array(spans, pa.list_(_SPAN)))
    return map_arrow(grouped, unite, grouped.schema)


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds ``n_hit``, ``n_items`` and ``contaminated``: at least one word in ``share`` is hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["first"])
    return found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("bigint")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", width: int = WIDTH, share: int = 20,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs
    if second is not None:  # the verdict is that of the text, so only digests of contaminated texts are joined
        digest = F.sha2(docs[text_col].cast("binary"), 256)
        texts = docs.select(digest.alias("doc_id"), docs[text_col].alias("text")).where("text is not null")
        bad = settle(judged(_merged(texts, chain([first, second], blocks), width), share).where("contaminated").select(
            F.col("doc_id").alias("digest")), "contaminated")
        return docs.join(bad, digest == bad["digest"], "left_anti")
    place = docs.columns.index(text_col)

    def work(batches):
        searcher = Searcher(first, width)
        for batch in batches:
            texts = [t or b"" for t in texts_as_bytes(batch.column(place))]
            found = [x for a, b in slices(texts) for x in searcher.search(texts[a:b])]
            hit = [sum(b - a for a, b in s) for _, s, _ in found]
            yield batch.filter(pa.array([not (h > 0 and share * h >= n) for h, (n, _, _) in zip(hit, found)], pa.bool_()))
    return map_arrow(docs, work, docs.schema)
