"""Removal of repeated text by hashing of units (operator 4).

A text is cut into units: ``line``, ``paragraph`` (between empty lines) or ``sentence`` (a line cut after
sentence ends). Units are normalised: case folded, words kept, all else dropped. A unit with fewer words than
``min_words`` is extended over the units that follow until it has enough, so that short units count only
together with their surroundings; what is left too short at the end of a text is never removed. Digests are
grouped over all documents, the occurrence with the smallest (document, start) stays, all others are removed;
their places in the original text are kept as offsets in characters (code points).

A passage may begin and end anywhere, so beside these units there are runs of ``RUN`` = 26 words chosen by
their content (winnowing): of every 26 runs that follow each other the one with the smallest hash. Two texts
with 51 words in common have 26 whole runs in common and so choose the same one, whatever stands around. Runs
chosen next to each other meet, so a longer passage goes but for less than 26 words at its ends. A run is
never compared with a line or sentence; equal runs that overlap (one word over and over) count once.
Characters of scripts without blanks are words of their own.

Units may overlap by their extension; removed spans of a document that meet are united.

Defined cases: null, empty and wordless texts have no units; repeated rows of one document have the same
first occurrence, which stays in each of them; a null id ranks after all others; a repeat inside one
document counts like one in another; other columns do not matter. Digests have 128 bits, put together from those
of the words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import id_and_text, map_arrow, settle

UNIT, MIN_WORDS, RUN = "sentence", 14, 26
_CUT = {
    "sentence": re.compile(r"(?<=[.!?\u0589\u061f\u06d4\u0964\u0965\u1362])\s+|(?<=[\u3002\uff01\uff1f\uff61])\s*|\n+"),
    "line": re.compile(r"\n+"),
    "paragraph": re.compile(r"\n\s*\n"),
}
# Thai to Lao, Myanmar, Khmer, kana, Han
_SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORDS = re.compile(f"[^\\W{_SINGLE}]+|[{_SINGLE}]")
#: Words whose hashes a worker keeps.
_KEPT_WORDS = 1 << 18
#: Odd numbers: multipliers of the two halves of a digest, and what mixes its bits.
_STEPS, _MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), 0xBF58476D1CE4E5B9


class _Hashes(dict):
    """128-bit digests of words, without regard to case."""

    def __missing__(self, word: str) -> bytes:
        import xxhash

        if len(self) >= _KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_128_digest(word.lower().encode("utf-8", "surrogatepass"))
        return value


_HASHES = _Hashes()


class Text:
    """The words of a text: where each begins and ends, and sums from which any stretch of words is hashed at once.

    A stretch's hash is the sum of its words' hashes times powers of an odd number, modulo 2^64, for each half of the
    digest. Sums over all words before a place are kept, so a stretch is a difference, brought back to power 0.
    """

    def __init__(self, text: str):
        matches = list(_WORDS.finditer(text))
        n = len(matches)
        self.start = np.fromiter((m.start() for m in matches), dtype=np.int64, count=n)
        self.end = np.fromiter((m.end() for m in matches), dtype=np.int64, count=n)
        values = np.frombuffer(b"".join([_HASHES[m.group()] for m in matches]), dtype=">u8").reshape(n, 2).astype(np.uint64)
        self.powers, inverses = _powers(n)
        self.sums = np.zeros((n + 1, 2), dtype=np.uint64)
        np.cumsum(values * inverses, axis=0, out=self.sums[1:])

    def digests(self, first: np.ndarray, end: np.ndarray, mark: int) -> np.ndarray:
        """(high, low) of the words [first, end) of each pair; ``mark`` tells kinds of stretches apart."""
        out = (self.sums[end] - self.sums[first]) * self.powers[first] + ((end - first).astype(np.uint64) * np.uint64(_MIX) + np.uint64(mark))[:, None]
        out ^= out >> np.uint64(29)  # the low bits are mixed best
        return out * np.uint64(_MIX)


_GROWN: list = [np.ones((1, 2), dtype=np.uint64), np.ones((1, 2), dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the two multipliers, and those 0 to n - 1 of their inverses, modulo 2^64."""
    if len(_GROWN[0]) <= n:
        size = max(2 * len(_GROWN[0]), n + 1)
        for k, bases in enumerate((_STEPS, [pow(s, -1, 1 << 64) for s in _STEPS])):
            table = np.ones((size, 2), dtype=np.uint64)
            table[1:] = np.array(bases, dtype=np.uint64)
            _GROWN[k] = np.cumprod(table, axis=0, dtype=np.uint64)
    return _GROWN[0], _GROWN[1][:n]


def runs(words: Text) -> tuple[np.ndarray, np.ndarray]:
    """First words and digests of the chosen runs of ``RUN`` words."""
    n = len(words.start)
    if n < 2 * RUN - 1:
        return np.empty(0, dtype=np.int64), np.empty((0, 2), dtype=np.uint64)
    every = np.arange(n - RUN + 1)
    digest = words.digests(every, every + RUN, 1)
    least = np.lib.stride_tricks.sliding_window_view(digest[:, 0], RUN).argmin(axis=1)
    chosen = np.unique(least + np.arange(len(least)))
    digest = digest[chosen]
    if len(np.unique(digest[:, 0])) < len(digest):  # equal runs that overlap count once
        over: dict[bytes, int] = {}
        keep = []
        for k, at in enumerate(chosen.tolist()):
            own = digest[k].tobytes()
            if over.get(own, 0) <= at:
                over[own] = at + RUN
                keep.append(k)
        chosen, digest = chosen[keep], digest[keep]
    return chosen, digest


def cut_units(text: str, words: Text, unit: str, min_words: int) -> tuple[np.ndarray, ...]:
    """Places in the text, first words and ends (in words) of each unit with enough words."""
    bounds = [0]
    for cut in _CUT[unit].finditer(text):
        bounds += cut.span()
    bounds.append(len(text))
    low, high = np.array(bounds[::2]), np.array(bounds[1::2])
    first, end = np.searchsorted(words.start, low), np.searchsorted(words.start, high)
    some = first < end
    low, high, first, end = low[some], high[some], first[some], end[some]
    # up to the first unit, itself or a later one, that gives enough words
    upto = np.searchsorted(end, first + min_words)
    enough = upto < len(end)
    upto = np.maximum(upto, np.arange(len(end)))[enough]
    return low[enough], high[upto], first[enough], end[upto]


def units(text: str, unit: str = UNIT, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of each unit with enough words, and of the chosen runs."""
    words = Text(text)
    low, high, first, end = cut_units(text, words, unit, min_words)
    chosen, digest = runs(words)
    return (np.concatenate([low, words.start[chosen]]), np.concatenate([high, words.end[chosen + RUN - 1]]),
            np.concatenate([words.digests(first, end, 0), digest]))


def unit_digests(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """``high, low, doc_id, first, end``: the digest and place of each unit."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            found = [units(text or "", unit, min_words) for text in batch.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            first, end, digest = (np.concatenate([f[k] for f in found]) for k in range(3))
            digest = digest.view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(digest[:, 0]), pa.array(digest[:, 1]), batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32)),
            ], names=["high", "low", "doc_id", "first", "end"])
    return map_arrow(docs, work, f"high bigint, low bigint, doc_id {kind}, first int, end int")


def find_repeats(docs: DataFrame, *, unit: str = UNIT, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, start, end, kept_doc_id, kept_start``: one row per occurrence that is to go."""
    # stored, so that texts are cut and hashed once for the grouping and the join
    places = settle(unit_digests(id_and_text(docs, id_col, text_col), unit, min_words), "places")
    # a null id ranks last
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("kept_doc_id"), F.col("first").alias("kept_start"))
    kept = places.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(rank).alias("kept")).where("n > 1").drop("n")
    # stored, so that both sides of the join come from exchanges of their own and a very frequent unit can be split
    kept = settle(kept, "kept-units")
    return places.join(kept, ["high", "low"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("kept.kept_doc_id")) & (F.col("first") == F.col("kept.kept_start")))
    ).select("doc_id", F.col("first").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"),
             "kept.kept_doc_id", F.col("kept.kept_start").cast("bigint").alias("kept_start"))


def without_repeats(docs: DataFrame, repeats: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated spans cut out of the text; rows with a null id keep their text.

    Spans are gathered per document, where the length of its text bounds them.
    """
    spans = repeats.where("doc_id is not null").groupBy(F.col("doc_id").alias("__of")).agg(
        F.collect_set(F.struct("start", "end")).alias("__spans"))
    joined = docs.join(spans, docs[id_col] == spans["__of"], "left")
    place, names = joined.columns.index(text_col), docs.columns

    def work(batches):
        for batch in batches:
            texts = []
            for text, cuts in zip(batch.column(place).to_pylist(), batch.column(len(names) + 1).to_pylist()):
                if text is not None and cuts:
                    parts, at = [], 0
                    for start, end in sorted((c["start"], c["end"]) for c in cuts):
                        parts.append(text[at:max(at, start)])
                        at = max(at, end)
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            columns = [batch.column(k) for k in range(len(names))]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return map_arrow(joined, work, docs.schema)
