"""Line-first quality rules (operator 9), in built-in expressions only.

First every line is judged: it goes if it does not end like a sentence and is short, if it looks like
navigation (parts between bars or bullets), or if it is boilerplate. Then the document is judged by what is
left: one that loses more than ``MOST_LOST`` of the characters of its lines is rejected. Beside that stand
base counts, by which a document fails outright: fewer than 10 words, or over a fifth of its words in
five-word windows that occur twice or more.

Repeated windows are found within a row: window hashes with their positions are sorted, equal neighbours
are repeats, and the distances of their positions give the words covered. The cost is n log n in the words
of a text, nothing is exploded or shuffled.

Defined cases: a null text has no words, lines or symbols, fails and has a null cleaned text; fewer than
five words have no windows; repeated rows give repeated results; other columns do not matter. Windows are
compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import id_and_text

# fixed values: white space, symbols and limits of the rules
BLANKS, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
SHORT_LINE, MOST_LOST = 8, 0.5
ENDING = r"[.!?…:;,\"»”’')\]。！？]\s*$"
NAVIGATION = r"(^|\s)[|»›•·>](\s|$)"
BOILERPLATE = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies|"
               r"enable javascript|sign up for|log ?in to|click here|lorem ipsum)")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more."""
    def covered(hashes):
        def from_sorted(pairs):
            def position(pair, k):
                twin = (F.get(pairs, k - 1)["h"] == pair["h"]) | (F.get(pairs, k + 1)["h"] == pair["h"])
                return F.when(F.coalesce(twin, F.get(pairs, k - 1)["h"] == pair["h"], F.get(pairs, k + 1)["h"] == pair["h"], F.lit(False)), pair["i"])
            places = F.array_sort(F.filter(F.transform(pairs, position), lambda p: p.isNotNull()))
            return let(places, lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window)))),
                F.lit(0).cast("bigint"), lambda total, n: total + n))
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(F.array_sort(pairs), from_sorted))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - window),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))
    return F.when(F.size(words) < window, F.lit(0).cast("bigint")).otherwise(let(hashes, covered))


def line_passes(line: Column) -> Column:
    short = F.size(F.split(F.trim(line), r"\s+")) < SHORT_LINE
    return (line.rlike(ENDING) | ~short) & ~(short & line.rlike(NAVIGATION)) & ~line.rlike(BOILERPLATE)


def assess(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, verdict and cleaned text of every document.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_share, kept,
    clean_text``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", words_in(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: without(line, BLANKS) != "").alias("lines"))
    size = lambda lines: F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, line: n + F.length(line))
    judged = docs.select(
        "doc_id", "text", "lines", F.filter("lines", line_passes).alias("passed"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(without(text, BLANKS)).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        let(F.col("words"), lambda words: repeated_words(words)).alias("n_repeat_words"),
    ).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    ).withColumn(
        "lost_share", F.when(F.size("lines") == 0, F.lit(1.0)).otherwise(1 - size("passed") / size("lines")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_share",
        (~F.col("base_failed") & (F.col("lost_share") <= MOST_LOST)).alias("kept"),
        F.when(F.col("text").isNotNull(), F.array_join("passed", "\n")).alias("clean_text"))
