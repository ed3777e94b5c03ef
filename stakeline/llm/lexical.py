"""Ranked lexical search by dense blocked multiplication (operator 12).

A term's impact in a document times its weight in an item, summed, is a product of two matrices. Both are cut
into tiles and multiplied by BLAS in float64:

* items come in tiles of few items whose vocabulary is numbered anew, so a tile is dense and small;
* documents come in tiles of up to ``TILE_DOCS``: for each tile the numbers and frequencies of the terms that
  items use, sorted by term. Tiles are written once; statistics of the corpus are sums over them;
* the columns of a tile are split where the sum of weights times the largest impact would reach 2^53, so each
  partial product is a whole number that float64 holds; partial products are added as 64-bit integers. A weight that is
  too large by itself is laid out over several columns;
* of each product tile all scores that reach the k-th are kept, ties included, and merged by (score, id) into
  the best k of the task; tasks are merged by windows, first within groups of tasks, then all.

Items are read in blocks of at most ``block_bytes`` of text, by the measured size of the table; each block goes
to the tasks with their code and reads the documents once. Sums of the corpus are over all documents.

Scores: N documents with a term, L terms in them, n terms of a document, df and tf as usual,
``w = floor(1000 ln((2N+2)/(2df+1)))``, ``m = 25 + 75 n N div L``, score = sum of ``w * (10^9 tf div (1000 tf + 8 m))``.

Defined cases: null texts have no terms; rows of items that share an id are one item with the terms of all; a null
item id is an item like others; every row of the documents is a document of its own, also if ids repeat, and a null
id comes last among equal scores; items without a term in the corpus give no rows; an empty table on either
side gives no rows; other columns do not matter. Ids of documents are whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .decontaminate import words_of
from .frames import id_and_text, map_arrow, settle, texts_as_bytes

BEST = 10
#: Most bytes of item texts in one block.
BLOCK_BYTES = 4 << 20
#: Most documents and bytes of text in a document tile; most items and columns in an item tile.
TILE_DOCS, TILE_BYTES, TILE_ITEMS, TILE_COLUMNS = 1024, 4 << 20, 64, 2048
#: Whole numbers up to this are exact in float64; no impact is larger than ``MOST_IMPACT``.
EXACT, MOST_IMPACT = 1 << 53, 1_000_000
#: Groups in which the results of tasks are merged first.
GROUPS = 64

_TILE = ("ids array<bigint>, sizes array<bigint>, terms binary, places binary, counts binary, "
         "seen array<int>, seen_in array<bigint>")
_TILE_ARROW = pa.schema([
    ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("terms", pa.binary()), ("places", pa.binary()),
    ("counts", pa.binary()), ("seen", pa.list_(pa.int32())), ("seen_in", pa.list_(pa.int64()))])


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """``(item_id, {term: count})`` of the items, one block after the other."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes)
    if count > 1:  # twice as many, so that uneven shares stay below the bound
        count *= 2
    part = F.pmod(F.xxhash64("item_id"), F.lit(max(count, 1)))
    for k in range(count):
        terms: dict = {}
        for row in (items if count == 1 else items.where(part == k)).collect():
            terms.setdefault(row.item_id, Counter()).update(words_of(row.text or ""))
        if block := [(item_id, found) for item_id, found in terms.items() if found]:
            yield block


def tile_of(ids: list, texts: list[bytes | None], number: dict[bytes, int]) -> dict:
    """A document tile: frequencies of the numbered terms, sorted by term."""
    sizes, found, owner = [], [], []
    for place, text in enumerate(texts):
        words = words_of_bytes(text)
        sizes.append(len(words))
        own = [k for k in map(number.get, words) if k is not None]
        found.extend(own)
        owner.append(len(own))
    terms = np.array(found, dtype=np.int64)
    places = np.repeat(np.arange(len(texts)), owner)
    pairs, counts = np.unique(terms * len(texts) + places, return_counts=True)
    terms, places = pairs // max(len(texts), 1), pairs % max(len(texts), 1)
    seen, seen_in = np.unique(terms, return_counts=True)
    return {"ids": ids, "sizes": sizes, "terms": terms.astype(np.int32).tobytes(), "places": places.astype(np.int32).tobytes(),
            "counts": counts.astype(np.int64).tobytes(), "seen": seen.astype(np.int32), "seen_in": seen_in}


def words_of_bytes(text: bytes | None) -> list[bytes]:
    from .decontaminate import _WORD_BYTES  # digits, letters in lower case and what is not ASCII

    return (text or b"").translate(_WORD_BYTES).split()


def document_tiles(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    def work(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), texts_as_bytes(batch.column("text"))
            start, size = 0, 0
            for i, text in enumerate(texts):
                if i > start and (i - start == TILE_DOCS or size + len(text or b"") > TILE_BYTES):
                    yield pa.RecordBatch.from_pylist([tile_of(ids[start:i], texts[start:i], number)], _TILE_ARROW)
                    start, size = i, 0
                size += len(text or b"")
            if start < len(texts):
                yield pa.RecordBatch.from_pylist([tile_of(ids[start:], texts[start:], number)], _TILE_ARROW)
    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, _TILE)


class ItemTile:
    """Weights of a few items, with their own vocabulary, as dense stretches of columns."""

    def __init__(self, first: int, rows: list[list[tuple[int, int]]]):
        """``rows`` are (term, weight) lists of the items from number ``first`` on."""
        self.first, self.items = first, len(rows)
        terms = sorted({t for row in rows for t, _ in row})
        weights = np.zeros((len(terms), self.items), dtype=np.int64)
        column = {t: k for k, t in enumerate(terms)}
        for item, row in enumerate(rows):
            for term, weight in row:
                weights[column[term], item] += weight
        self.stretches: list[tuple[np.ndarray, np.ndarray]] = []  # terms of the columns, weights
        most = (EXACT - 1) // MOST_IMPACT
        chosen: list[int] = []
        parts: list[np.ndarray] = []
        total = np.zeros(self.items, dtype=np.int64)
        for term, row in zip(terms, weights):
            while row.any():
                part = np.minimum(row, most)
                if len(chosen) == TILE_COLUMNS or (chosen and (total + part).max() > most):
                    self._close(chosen, parts)
                    chosen, parts, total = [], [], np.zeros(self.items, dtype=np.int64)
                chosen.append(term)
                parts.append(part)
                total, row = total + part, row - part
        if chosen:
            self._close(chosen, parts)

    def _close(self, chosen, parts) -> None:
        self.stretches.append((np.array(chosen, dtype=np.int64), np.array(parts, dtype=np.float64)))

    def scores(self, docs: int, begins: np.ndarray, places: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """(documents, items): exact sums; ``begins`` are the bounds of each term's entries."""
        out = np.zeros((docs, self.items), dtype=np.int64)
        for terms, weights in self.stretches:
            low, many = begins[terms], begins[terms + 1] - begins[terms]
            if not many.any():
                continue
            column = np.repeat(np.arange(len(terms)), many)
            entry = np.arange(len(column)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            tile = np.zeros((docs, len(terms)))
            tile[places[entry], column] = impacts[entry]
            out += (tile @ weights).astype(np.int64)
        return out


def item_tiles(weighted: list[list[tuple[int, int]]]) -> Iterator[ItemTile]:
    start, terms = 0, set()
    for k, row in enumerate(weighted):
        own = {t for t, _ in row}
        if k > start and (k - start == TILE_ITEMS or len(terms | own) > TILE_COLUMNS):
            yield ItemTile(start, weighted[start:k])
            start, terms = k, set()
        terms |= own
    if start < len(weighted):
        yield ItemTile(start, weighted[start:])


class BestOf:
    """The k best (score, id) of each item so far; a missing id comes last among equals."""

    def __init__(self, items: int, k: int):
        self.k, self.scores, self.ids, self.missing = k, [np.zeros(0, np.int64)] * items, [np.zeros(0, np.int64)] * items, [np.zeros(0, bool)] * items
        self.least = np.ones(items, dtype=np.int64)

    def take(self, first: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        least = self.least[first:first + scores.shape[1]]
        if len(scores) > self.k:  # all that reach the k-th of this tile, ties included
            least = np.maximum(least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        rows, items = np.nonzero((scores >= least).T)[::-1]
        for item in np.unique(items):
            own = rows[items == item]
            self._merge(first + item, scores[own, item], ids[own], missing[own])

    def _merge(self, item: int, scores, ids, missing) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        missing = np.concatenate([self.missing[item], missing])
        order = np.lexsort((ids, missing, -scores))[:self.k]
        self.scores[item], self.ids[item], self.missing[item] = scores[order], ids[order], missing[order]
        if len(order) == self.k:
            self.least[item] = self.scores[item][-1]


def search_tiles(tiles: DataFrame, item_ids: list, id_kind: str, weighted: list[list[tuple[int, int]]], terms: int, n_docs: int,
                 n_terms: int, k: int) -> DataFrame:
    """The k best documents of every item in each task."""
    def work(batches):
        blocks, best, any_rows = list(item_tiles(weighted)), BestOf(len(weighted), k), False
        for batch in batches:
            for row in range(batch.num_rows):
                any_rows = True
                cell = lambda name: batch.column(name)[row]  # noqa: B023, E731
                ids = cell("ids").values
                missing = np.array([not x for x in ids.is_valid().to_pylist()], dtype=bool)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                sizes = cell("sizes").values.to_numpy()
                of = np.frombuffer(cell("terms").as_py(), dtype=np.int32)
                places = np.frombuffer(cell("places").as_py(), dtype=np.int32)
                counts = np.frombuffer(cell("counts").as_py(), dtype=np.int64)
                norm = 25 + (75 * sizes * n_docs) // n_terms
                impacts = ((1_000_000_000 * counts) // (1000 * counts + 8 * norm[places])).astype(np.float64)
                begins = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=terms))])
                for block in blocks:
                    best.take(block.first, block.scores(len(ids), begins, places, impacts), ids, missing)
        if any_rows:
            item = [i for i in range(len(weighted)) for _ in best.scores[i]]
            yield pa.record_batch([
                pa.array(item, pa.int32()),
                pa.array(np.concatenate(best.ids), pa.int64(), mask=np.concatenate(best.missing)),
                pa.array(np.concatenate(best.scores), pa.int64())], names=["item", "doc_id", "score"])
    found = map_arrow(tiles, work, "item int, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    for keys in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    names = tiles.sparkSession.createDataFrame(list(enumerate(item_ids)), f"item int, item_id {id_kind}")
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, *, best: int = BEST, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item."""
    docs = id_and_text(docs, id_col, text_col)
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    id_kind = items.schema["item_id"].dataType.simpleString()
    results = []
    for block in item_blocks(items, block_bytes):
        vocabulary = sorted(set().union(*(found for _, found in block)))
        number = {term: k for k, term in enumerate(vocabulary)}
        tiles = settle(document_tiles(docs, number), "tiles")
        held = F.filter("sizes", lambda n: n > 0)
        total = tiles.agg(F.sum(F.size(held).cast("bigint")).alias("docs"),
                          F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("terms")).first()
        if not total.terms:
            break
        # as many rows as the block has terms
        seen = tiles.select(F.explode(F.arrays_zip("seen", "seen_in")).alias("s")).groupBy(F.col("s.seen").alias("term")).agg(
            F.sum("s.seen_in").alias("df")).collect()
        weight = {term: math.floor(1000 * math.log((2 * total.docs + 2) / (2 * df + 1))) for term, df in seen}
        weighted = [[(number[t], count * weight[number[t]]) for t, count in found.items() if weight.get(number[t])]
                    for _, found in block]
        results.append(settle(search_tiles(tiles, [i for i, _ in block], id_kind, weighted, len(vocabulary), total.docs,
                                           total.terms, best), "ranked"))
    if not results:
        return docs.sparkSession.createDataFrame([], f"item_id {id_kind}, rank int, doc_id bigint, score bigint")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
