"""Small tables with the awkward rows that every operator has to take."""

import random

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, score double, "
           "`value` string, `print` bigint, `start` int, `key` string, token_ids string")

LONG = "Word after word the story goes on, and on it goes. " * 4000


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, len(text) if text is not None else None, 7, 0.5, "x", 1, 2, "k", "t")


def awkward():
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    first = "The first line stands here for everyone to read twice.\nAnd a second line follows it at once."
    return [
        row(1, first), row(2, first), row(2, first), row(3, None), row(4, ""), row(5, "   \n\t "), row(None, "a text without an id here"),
        row(6, LONG), row(7, "é中文 ٣٤ 🙂  x'S it's I'LL we'll"), row(8, "one"), row(9, "one two"),
        row(10, "No lang or source is given for this text of ten words.", None, None),
        (None,) * 12, (None,) * 12, row(11, "x" * 50_000),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def invented(n, seed=3, words=("the", "of", "stone", "river", "Hill", "and", "läuft", "no.", "Yes!", "ten")):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for i in range(n)]
