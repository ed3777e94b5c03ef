"""Language identification by compression (operator 7).

Each language has a zstandard raw-content dictionary of sample text. A text is cut into chunks, each is
encoded with every dictionary, and the language with the smallest total wins. Where the best and the second
are closer than ``MARGIN`` of the second, the guess is rejected (``accepted`` is false); ``lang_pred`` still
names the best. Only letters count: others become single blanks, and case is folded.

Dictionaries are learned from at most ``SAMPLE_ROWS`` labelled rows per language, those with the smallest
hash of their id. All of them count: of a long text the dictionary takes parts at ``PLACES`` places, evenly
spread from its begin to its end, so that together they fill ``DICTIONARY_BYTES`` (with 600 rows about 27
bytes at each place). This sample is a documented bound; of rows that repeat an id, the smallest parts are
taken. At most ``LANGUAGES`` languages are accepted. Learning reads the labelled rows three times, whatever
the number of languages: for counts, for hashes of ids, for parts. All rows are judged, by their whole texts.

Defined cases: null texts and texts without a letter get ``und``, score 0, not accepted; ties go to the
language whose name sorts first; without labelled rows every text gets ``und``; with one language the
score of a text is 1; rows with a null id are judged but not learned from; repeated rows give repeated results; other columns do not matter.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import id_and_text, map_arrow, settle

#: Bounds: labelled rows and dictionary bytes of each language, and languages.
SAMPLE_ROWS, DICTIONARY_BYTES, LANGUAGES = 600, 64 << 10, 500
#: Places of a sampled text that parts are taken from, least characters of a part, and rows drawn by hash for each one sampled.
PLACES, LEAST_PART, SPARE = 4, 16, 4
#: Bytes of text encoded at once, and the margin below which a guess is rejected.
CHUNK_BYTES, MARGIN = 8192, 0.002
#: Compression level; the sizes of texts below ``SHORT_BYTES`` are coarse, so several levels are added up there.
LEVEL, SHORT_LEVELS, SHORT_BYTES = 6, (3, 6, 9, 12), 200
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def folded(text: str) -> bytes:
    """Letters in lower case, all else as single blanks."""
    return " ".join(_LETTERS.findall(text.lower())).encode("utf-8", "surrogatepass")


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def learn(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of labelled rows."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "lang is not null and text is not null and id is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return {}
    spark = rows.sparkSession
    # of SPARE times as many rows as are wanted, so few that fewer than wanted remain by a negligible chance only
    below = spark.createDataFrame([(name, min(1.0, SPARE * sample_rows / n)) for name, n in counts.items()], "lang string, share double")
    rank = F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string")), 11)
    drawn = rows.select("lang", "id", rank.alias("rank")).join(F.broadcast(below), "lang").where(
        F.col("rank") < F.col("share") * float(1 << 53))
    first = Window.partitionBy("lang").orderBy("rank", "id")  # each task keeps sample_rows a language before the shuffle
    picked = drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample_rows).select("lang", "id").distinct()
    picked = settle(picked, "sampled")
    size = picked.groupBy("lang").agg(F.count("*").alias("n"))
    chosen = picked.join(F.broadcast(size), "lang")  # at most sample_rows x LANGUAGES short rows
    # the same number of characters from each of several places, so that the driver gets a dictionary's worth a language
    part = F.greatest(F.lit(LEAST_PART), F.floor(F.lit(DICTIONARY_BYTES) / (F.col("n") * PLACES))).cast("int")
    length = F.length("text")
    cut = [F.substring("text", (F.floor((length - part) * k / (PLACES - 1)) + 1).cast("int"), part) for k in range(PLACES)]
    parts = F.when(length <= part * PLACES, F.array(F.col("text"))).otherwise(F.array(*cut))
    shares = rows.join(F.broadcast(chosen), ["lang", "id"]).groupBy("lang", "id").agg(F.min(parts).alias("parts"))
    samples: dict[str, list] = {}
    for r in shares.collect():
        samples.setdefault(r["lang"], []).append((r["id"], r["parts"]))
    return {name: _dictionary([parts for _, parts in sorted(found)]) for name, found in sorted(samples.items())}


def _dictionary(texts: list[list[str]]) -> bytes:
    """Parts of all texts, the same bytes of each; short ones leave room for more of the others."""
    ready = [[folded(p) for p in parts] for parts in texts]
    whole = list(dict.fromkeys(b" ".join(parts) for parts in ready))
    if sum(len(t) + 1 for t in whole) <= DICTIONARY_BYTES:
        return b" ".join(whole)
    room, left, out = DICTIONARY_BYTES, len(ready), []
    for parts in sorted(ready, key=lambda parts: sum(map(len, parts))):
        each = max(1, room // left // len(parts) - 1)  # a blank after each
        out.append(b" ".join(p[:each] for p in parts))
        room -= len(out[-1]) + 1
        left -= 1
    return b" ".join(dict.fromkeys(out))[:DICTIONARY_BYTES]


class Model:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        def encoder(content: bytes, level: int):
            raw = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            return zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False,
                                            write_dict_id=False).compress

        self.names = sorted(dictionaries)
        self.long = [[encoder(dictionaries[n], LEVEL)] for n in self.names]
        self.short = [[encoder(dictionaries[n], level) for level in SHORT_LEVELS] for n in self.names]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        data = folded(text) if text else b""
        if not data or not self.names or not has_letter(text):
            return UNKNOWN, 0.0, False
        chunks = [data[k:k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]
        encoders = self.short if len(data) < SHORT_BYTES else self.long
        sizes = [sum(len(encode(c)) for encode in each for c in chunks) for each in encoders]
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], self.names[k]))
        score = 1.0 if len(order) == 1 else 1 - sizes[order[0]] / sizes[order[1]]
        return self.names[order[0]], score, score >= MARGIN


def predict(docs: DataFrame, dictionaries: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` per document."""
    docs = id_and_text(docs, id_col, text_col)

    def work(batches):
        model = Model(dictionaries)
        for batch in batches:
            names, scores, accepted = [], [], []
            for text in batch.column(1).to_pylist():
                name, score, ok = model.predict(text)
                names.append(name), scores.append(score), accepted.append(ok)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                   pa.array(accepted, pa.bool_())], names=["doc_id", "lang_pred", "score", "accepted"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, work, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def keep_accepted(docs: DataFrame, dictionaries: dict[str, bytes], *, text_col: str = "text") -> DataFrame:
    """The rows whose guess is accepted, with all their columns."""
    place = docs.columns.index(text_col)

    def work(batches):
        model = Model(dictionaries)
        for batch in batches:
            yield batch.filter(pa.array([model.predict(t)[2] for t in batch.column(place).to_pylist()], pa.bool_()))
    return map_arrow(docs, work, docs.schema)
