"""Hard-negative mining by Strassen multiplication of integer tiles (operator 13).

Vectors become whole numbers, ``floor(scale * x)``. Anchors lie in blocks, all rows in tiles, and the scores of a
block against a tile are one product of int64 matrices: Strassen's recursion halves all three sides (padded with
zeros to even ones), adds and subtracts quarters exactly and multiplies seven times in place of eight, down to
``LEAF``. Where no sum on the way can reach 2^53 it runs on doubles, which are exact there. Otherwise sums that pass 64 bits
on the way wrap around and come back, so every score that fits into a long is exact.

Two readings of the tiles:

* the first keeps a heap of the best ``positives`` rows of its label for each anchor. Heaps of tasks are merged by a window
  over (anchor), which limits each task's rows before the shuffle;
* the second knows each anchor's positives and so the windows of scores that make a hard negative, and keeps a heap of the
  best ``negatives`` rows of other labels for each (anchor, positive), merged the same way.

Blocks and tiles meet by an equality join on (width, part of the tiles, group of the blocks). A group holds at most
``GROUP_BYTES`` of anchors and, on average, half of ``HELD`` blocks; tiles are laid out once per group and blocks once per
part, and the join is a sorted one, so neither side is broadcast. What moves is tiles x groups + blocks x parts; parts are as
many as keep the second no larger than the first (at least the session's partitions). A task holds one tile, the blocks of
one group and the heaps of ``HELD`` blocks at most.

Defined cases: rows with a null id, label or vector, a null or non-finite component, or a component that is no
64-bit number once scaled, take no part; vectors meet those of their own length only (empty ones score 0); an anchor
is not its own positive, rows that repeat an id are rows of their own but not of the anchor's; ties go to the smaller id; an
anchor without positives or without rows in a window gives none; other columns do not matter; empty tables give no rows.
Rows that repeat an anchor's id are one anchor, by the row with the smallest label and vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import map_arrow, settle

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
#: A hard negative scores from LOW to HIGH hundredths of its positive.
LOW, HIGH = 50, 95
#: Anchors in a block, bytes of anchors in a group, tiles in a part at least, blocks whose heaps a task holds.
BLOCK_ROWS, GROUP_BYTES, PART_TILES, HELD = 512, 64 << 20, 1, 256
#: A side of this length is multiplied plainly.
LEAF = 32

_TILE = "width int, rows int, ids binary, labels binary, vectors binary"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int | None = None) -> np.ndarray:
    """``a @ b`` of whole numbers: modulo 2^64 in int64, exact in doubles while no sum on the way reaches 2^53."""
    leaf = LEAF if leaf is None else leaf
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= max(leaf, 1):
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    out = np.empty((2 * i, 2 * h), dtype=a.dtype)
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    out[:i, :h] = p1 + p4 - p5 + strassen(a12 - a22, b21 + b22, leaf)
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12, leaf)
    return out[:m, :n]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``strassen`` of int64 matrices; in doubles, which processors multiply faster, where every sum on the way is exact."""
    side, most = min(*a.shape, b.shape[1]), a.shape[1] * largest(a) * largest(b)
    while side > max(LEAF, 1):  # a level doubles the numbers of both sides
        side, most = -(-side // 2), 4 * most
    if 4 * most < 2**53:  # up to four products are added
        return strassen(a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
    return strassen(a, b)


def largest(a: np.ndarray) -> int:
    """The largest magnitude, as a number without bounds."""
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, label: Callable | None, scale: int) -> DataFrame:
    """``id, label, vector`` of the rows that take part, with whole components."""
    named = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("raw"))
    scaled = F.transform("raw", lambda x: F.floor(x * scale))
    fits = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (x * scale >= F.lit(-2.0**63)) & (x * scale < F.lit(2.0**63)))
    kept = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull()).where(fits)
    return kept.select("id", (label(F.col("id"), F.col("label")) if label else F.col("label")).cast("bigint").alias("label"),
                       scaled.alias("vector"))


def tiled(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Tiles of rows with vectors of one length."""
    def work(batches):
        for batch in batches:
            vectors = batch.column("vector")
            widths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy().astype(np.int64)
            begins = np.concatenate([[0], np.cumsum(widths)])
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for width in np.unique(widths):
                every = np.flatnonzero(widths == width)
                for low in range(0, len(every), most or len(every)):
                    own = every[low:low + (most or len(every))]
                    block = flat[begins[own][:, None] + np.arange(width)]
                    yield pa.record_batch([
                        pa.array([width], pa.int32()), pa.array([len(own)], pa.int32()), pa.array([ids[own].tobytes()], pa.binary()),
                        pa.array([labels[own].tobytes()], pa.binary()), pa.array([block.astype(np.int64).tobytes()], pa.binary()),
                    ], names=["width", "rows", "ids", "labels", "vectors"])
    return map_arrow(rows.select("id", "label", "vector"), work, _TILE)


def size_of(tiles: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of all their cells."""
    cells = [F.octet_length(name).cast("bigint") for name, kind in tiles.dtypes if kind == "binary"]
    size = tiles.agg(F.count("*").alias("rows"), F.sum(reduce(add, cells)).alias("bytes")).first()
    return size.rows, size.bytes or 0


def met(tiles: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every tile with every block of its width, by a sorted join on (width, part, group)."""
    (many, tile_bytes), (held, block_bytes) = size_of(tiles), size_of(blocks)
    # blocks come again with every tile, so a task keeps the heaps of all blocks of a group; hashing makes some groups larger
    groups = max(1, -(-block_bytes // GROUP_BYTES), -(-2 * held // HELD))
    # so many that tasks share the work evenly, but that the copies of blocks are no more bytes than those of tiles
    least = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-many // PART_TILES), max(least, tile_bytes * groups // max(1, block_bytes))))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    left = tiles.select("*", dealt(parts).alias("part"), spread(groups).alias("group"))
    right = blocks.select("width", *[F.col(c).alias(f"a_{c}") for c in blocks.columns if c != "width"], dealt(groups).alias("group"), spread(parts).alias("part"))
    # Spark takes a frame for as large as it was before its rows are laid out, and would send small blocks through the driver
    keys = ["width", "part", "group"]
    return left.repartition(parts * groups, *keys).join(right.repartition(parts * groups, *keys).hint("merge"), keys)


def matrix(cell, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(cell.as_py(), dtype=np.int64).reshape(rows, width)


class Heap:
    """The best ``k`` (score, id) of each of ``n`` owners so far, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.filled = np.zeros((n, k), dtype=bool)

    def floors(self) -> np.ndarray:
        """The score of each owner below which none can enter."""
        return self.scores[:, -1] if self.k else np.full(len(self.scores), np.iinfo(np.int64).max)

    def take(self, owner: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates as (owner, score, id)."""
        if self.k == 0 or not len(owner):
            return
        full = self.filled[owner, -1]  # those below the last of a full heap can't enter
        near = ~full | (scores >= self.scores[owner, -1])
        owner, scores, ids = owner[near], scores[near], ids[near]
        if not len(owner):
            return
        old = np.nonzero(self.filled[np.unique(owner)])
        held = np.unique(owner)[old[0]]
        owner = np.concatenate([held, owner])
        scores, ids = np.concatenate([self.scores[held, old[1]], scores]), np.concatenate([self.ids[held, old[1]], ids])
        order = np.lexsort((ids, -scores, owner))
        # -scores of the smallest long wraps around to itself and would come first
        if (scores == np.iinfo(np.int64).min).any():
            order = np.array(sorted(range(len(owner)), key=lambda i: (owner[i], -int(scores[i]), ids[i])))
        owner, scores, ids = owner[order], scores[order], ids[order]
        begin = np.searchsorted(owner, owner)
        place = np.arange(len(owner)) - begin
        best = place < self.k
        at = owner[best], place[best]
        self.scores[at], self.ids[at], self.filled[at] = scores[best], ids[best], True


def heaped(pairs: DataFrame, schema: str, heap_of: Callable, offer: Callable, given: Callable) -> DataFrame:
    """Runs all (tile, block) rows through heaps of blocks: ``heap_of(cells)``, ``offer(heap, cells, scores)``, ``given(heap, cells)``."""
    names = [f.split()[0] for f in schema.split(", ")]

    def out(heaps) -> Iterator[pa.RecordBatch]:
        for heap, kept in heaps.values():
            columns = given(heap, kept)
            if len(columns[0]):
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    def work(batches):
        heaps: dict = {}
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {n: batch.column(n)[row] for n in batch.schema.names}
                width, rows, block_rows = cell["width"].as_py(), cell["rows"].as_py(), cell["a_rows"].as_py()
                key = (width, cell["a_ids"].as_py())
                if key not in heaps:
                    if len(heaps) == HELD:
                        yield from out(heaps)
                        heaps.clear()
                    kept = {n: np.frombuffer(cell[n].as_py(), dtype=np.int64) for n in batch.schema.names
                            if n.startswith("a_") and n != "a_rows"}
                    heaps[key] = heap_of(kept), kept
                heap, kept = heaps[key]
                anchors = kept["a_vectors"].reshape(block_rows, width)
                scores = product(anchors, matrix(cell["vectors"], rows, width).T)
                ids = np.frombuffer(cell["ids"].as_py(), dtype=np.int64)
                labels = np.frombuffer(cell["labels"].as_py(), dtype=np.int64)
                offer(heap, kept, ids, labels, scores)
        yield from out(heaps)
    return map_arrow(pairs.drop("part", "group"), work, schema)


def best_of(found: DataFrame, keys: list[str], id_name: str, k: int) -> DataFrame:
    """The first ``k`` rows of each key; tasks drop theirs beyond it before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc(id_name))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_of_label(pairs: DataFrame, k: int) -> DataFrame:
    """``anchor, positive, score``: the best ``k`` other rows of an anchor's label."""
    def offer(heap, kept, ids, labels, scores):
        same = (kept["a_labels"][:, None] == labels[None, :]) & (kept["a_ids"][:, None] != ids[None, :])
        owner, place = np.nonzero(same & (scores >= heap.floors()[:, None]))
        heap.take(owner, scores[owner, place], ids[place])

    def given(heap, kept):
        owner, place = np.nonzero(heap.filled)
        return kept["a_ids"][owner], heap.ids[owner, place], heap.scores[owner, place]
    found = heaped(pairs, "anchor bigint, positive bigint, score bigint", lambda kept: Heap(len(kept["a_ids"]), k), offer, given)
    return best_of(found, ["anchor"], "positive", k)


def windows_of(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score with ``low * positive <= 100 * score <= high * positive``."""
    whole, rest = np.divmod(positive, 100)  # in parts, so that the products stay within 64 bits
    return low * whole - (-(low * rest) // 100), high * whole + (high * rest) // 100


def in_windows(pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """``anchor, slot, negative, score``: the best ``k`` rows of other labels in the window of each positive."""
    def offer(heap, kept, ids, labels, scores):
        least, most = windows_of(kept["a_scores"], low, high)
        least = np.maximum(least, heap.floors())
        anchor, n = kept["a_owner"], len(kept["a_ids"])
        # the widest window of an anchor first, then those of its positives, which lie one after the other
        lowest, highest = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(lowest, anchor, least)
        np.maximum.at(highest, anchor, most)
        row, place = np.nonzero((kept["a_labels"][:, None] != labels) & (scores >= lowest[:, None]) & (scores <= highest[:, None]))
        many = np.bincount(anchor, minlength=n)
        begin = np.cumsum(many) - many
        for slot in range(many.max(initial=0)):
            row, place = row[many[row] > slot], place[many[row] > slot]
            owner, s = begin[row] + slot, scores[row, place]
            fits = (s >= least[owner]) & (s <= most[owner])
            heap.take(owner[fits], s[fits], ids[place[fits]])

    def given(heap, kept):
        owner, place = np.nonzero(heap.filled)
        return kept["a_ids"][kept["a_owner"][owner]], kept["a_slots"][owner], heap.ids[owner, place], heap.scores[owner, place]
    found = heaped(pairs, "anchor bigint, slot bigint, negative bigint, score bigint", lambda kept: Heap(len(kept["a_owner"]), k),
                   offer, given)
    return best_of(found, ["anchor", "slot"], "negative", k)


def with_positives(anchors: DataFrame) -> DataFrame:
    """Blocks of anchors, each with its positives: number, owner and score."""
    def work(batches):
        for batch in batches:
            vectors = batch.column("vector")
            widths = np.diff(vectors.offsets.to_numpy())
            flat, begins = vectors.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(widths)])
            ids, labels, positives = batch.column("id").to_numpy(), batch.column("label").to_numpy(), batch.column("scores").to_pylist()
            for width in np.unique(widths):
                every = np.flatnonzero(widths == width)
                for low in range(0, len(every), BLOCK_ROWS):
                    own = every[low:low + BLOCK_ROWS]
                    many = [len(positives[i]) for i in own]
                    pack = lambda values: pa.array([np.asarray(values, dtype=np.int64).tobytes()], pa.binary())
                    yield pa.record_batch([
                        pa.array([width], pa.int32()), pa.array([len(own)], pa.int32()), pack(ids[own]), pack(labels[own]),
                        pack(flat[begins[own][:, None] + np.arange(width)]), pack(np.repeat(np.arange(len(own)), many)),
                        pack([k for n in many for k in range(n)]), pack([s for i in own for s in positives[i]]),
                    ], names=["width", "rows", "ids", "labels", "vectors", "owner", "slots", "scores"])
    return map_arrow(anchors.select("id", "label", "vector", "scores"), work,
                     f"{_TILE}, owner binary, slots binary, scores binary")


def gathered(anchors: DataFrame) -> DataFrame:
    """Anchors in as few partitions as their blocks fill."""
    return anchors.repartition(max(1, -(-anchors.count() // BLOCK_ROWS)))


def mine(rows: DataFrame, *, scale: int = SCALE, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, label: Callable | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``label(id, label)`` may give rows another label first.
    """
    kept = usable(rows, id_col, vector_col, label_col, label, scale)
    tiles = settle(tiled(kept), "tiles")
    first = Window.partitionBy("id").orderBy("label", "vector")
    anchors = kept.where(F.col("id") % every == 0).withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")
    anchors = settle(anchors, "anchors")
    blocks = settle(tiled(gathered(anchors), BLOCK_ROWS), "blocks")
    chosen = settle(nearest_of_label(met(tiles, blocks), positives).select(
        "anchor", "positive", "score", (F.col("rank") - 1).cast("bigint").alias("slot")), "positives")
    # at most ``positives`` scores an anchor, in the order of their slots
    scores = chosen.groupBy(F.col("anchor").alias("id")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("slot", "score"))), lambda p: p["score"]).alias("scores"))
    windows = settle(with_positives(gathered(settle(anchors.join(scores.hint("merge"), "id"), "scored"))), "windows")
    found = in_windows(met(tiles, windows), negatives, low, high)
    return found.join(chosen.withColumnRenamed("score", "positive_score").hint("merge"), ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank"), F.col("negative").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
