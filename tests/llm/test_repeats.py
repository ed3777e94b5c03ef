import random
import re

import numpy as np
from cases import awkward, frame

from stakeline.llm import repeats as R


WORD = re.compile(r"[^\W\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]+"
                  r"|[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
CUTS = {"sentence": r"(?<=[.!?\u0964\u061f])\s+|(?<=\u3002)\s*|\n+", "line": r"\n+", "paragraph": r"\n\s*\n"}


def plain_units(text, unit, min_words):
    """(start, end, words) by walking from unit to unit."""
    parts, at = [], 0
    for cut in [*re.finditer(CUTS[unit], text), None]:
        stop = cut.start() if cut else len(text)
        words = [w.lower() for w in WORD.findall(text[at:stop])]
        if words:
            parts.append((at, stop, words))
        at = cut.end() if cut else at
    for i, (start, end, words) in enumerate(parts):
        for k in range(i + 1, len(parts)):
            if len(words) >= min_words:
                break
            words, end = words + parts[k][2], parts[k][1]
        if len(words) >= min_words:
            yield start, end, ("unit", *words)


def plain_runs(text):
    """The runs at the chosen places; equal ones that overlap count once."""
    found = list(WORD.finditer(text))
    over = {}
    for k in R.runs(R.Text(text))[0].tolist():
        words = ("run", *[m.group().lower() for m in found[k:k + R.RUN]])
        assert over.get(words, 0) <= k
        over[words] = k + R.RUN
        yield found[k].start(), found[k + R.RUN - 1].end(), words


def brute(rows, unit, min_words):
    places = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in order:
        for start, end, words in [*plain_units(text or "", unit, min_words), *plain_runs(text or "")]:
            places.setdefault(words, []).append((doc_id, start, end))
    out = []
    for found in places.values():
        first = min(found, key=lambda p: (p[0] is None, p[0] or 0, p[1]))
        if len(found) > 1:
            out += [(d, a, b, first[0], first[1]) for d, a, b in found if (d, a) != first[:2]]
    return out


def test_stretches_are_equal_exactly_where_their_words_are():
    rnd = random.Random(2)
    text = " ".join(rnd.choice(["a", "b", "A", "é", "中"]) for _ in range(70))
    words = R.Text(text)
    plain = [m.group().lower() for m in WORD.finditer(text)]
    n = len(plain)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + 9) + 1)]
    digests = words.digests(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), 0)
    by_words = {}
    for (i, j), digest in zip(pairs, digests.tolist()):
        by_words.setdefault(tuple(plain[i:j]), set()).add(tuple(digest))
    assert all(len(d) == 1 for d in by_words.values())
    assert len({next(iter(d)) for d in by_words.values()}) == len(by_words)


def test_every_26_runs_have_a_chosen_one():
    rnd = random.Random(6)
    for n in (50, 51, 52, 77, 300):
        chosen = R.runs(R.Text(" ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))))[0].tolist()
        starts = [-1, *chosen, n - R.RUN + 1] if n >= 51 else []
        assert all(b - a <= R.RUN for a, b in zip(starts, starts[1:])) and bool(chosen) == (n >= 51)


def test_all_units(spark):
    passage = "Here is a sentence that everyone copies into their text. And it goes on with a second one of many words."
    rows = awkward() + [(30, f"Some words first {passage} and more", *[None] * 10), (31, f"Other, other start. {passage} Then ends", *[None] * 10),
                        (32, passage + "\n\n" + passage.upper() + "\n\nShort.", *[None] * 10)]
    docs = frame(spark, rows)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for unit, least in (("sentence", 8), ("line", 3), ("paragraph", 1)):
        got = R.find_repeats(docs, unit=unit, min_words=least)
        assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, brute(texts, unit, least)))


def test_texts_are_cut_at_the_offsets(spark):
    copy = "Twelve words stand in this sentence, so that it counts as one unit."
    docs = spark.createDataFrame([(1, f"é {copy}"), (2, f"Before it 🙂.  {copy}\nAfter."), (3, None), (4, ""), (None, copy)],
                                 "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in R.without_repeats(docs, R.find_repeats(docs, min_words=10)).collect()}
    assert clean[3] is None and clean[4] == "" and copy in clean[2] + clean[1]


def test_earliest_stays_and_rest_goes(spark):
    copy = "Twelve words stand in this sentence, so that it counts as one unit."
    docs = spark.createDataFrame([(5, f"Own start here.\n{copy}"), (9, f"{copy}\nOther end."), (7, f"Alone.\n{copy}\nEnd.")],
                                 "doc_id bigint, text string")
    found = R.find_repeats(docs, unit="line", min_words=12)
    assert {(r.doc_id, r.kept_doc_id) for r in found.collect()} == {(7, 5), (9, 5)}
    clean = {r.doc_id: r.text for r in R.without_repeats(docs, found).collect()}
    assert clean == {5: f"Own start here.\n{copy}", 7: "Alone.\n\nEnd.", 9: "\nOther end."}


def test_empty_table(spark):
    docs = frame(spark, [])
    assert R.find_repeats(docs).count() == 0 and R.without_repeats(docs, R.find_repeats(docs)).count() == 0


def test_passages_inside_longer_sentences(spark):
    rnd = random.Random(4)
    words = lambda n: " ".join("w%d" % rnd.randrange(10**6) for _ in range(n))
    rows, passages = [], {}
    for i in range(40):
        passage = words(51) if i % 4 else "".join(chr(0x4E00 + rnd.randrange(5000)) for _ in range(51))
        rows += [(i, f"{words(i + 3)} {passage} {words(30 - i % 7)}."), (100 + i, f"{words(40)} {passage.upper()}, {words(20)}")]
        passages[100 + i] = passage.upper()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = dict(rows)
    found = R.find_repeats(docs).collect()
    assert {r.doc_id: r.kept_doc_id for r in found} == {100 + i: i for i in range(40)}
    assert all(text[r.doc_id][r.start:r.end] in passages[r.doc_id] for r in found)


def test_one_word_over_and_over_and_other_sentence_ends(spark):
    many = " ".join(["Again"] * 500)
    assert len(R.runs(R.Text(many))[0]) <= 500 // R.RUN
    chinese = "".join(chr(0x4E00 + k) for k in range(40))
    hindi = " ".join(f"क{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"一。{chinese}。二"), (2, f"三四。{chinese}。五"), (3, f"a। {hindi}। b"), (4, f"c। {hindi}। d"), (5, many), (6, f"so {many}")],
                                 "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in R.without_repeats(docs, R.find_repeats(docs)).collect()}
    assert chinese in clean[1] and chinese not in clean[2] and clean[2].startswith("三四。")
    assert hindi in clean[3] and hindi not in clean[4]
    assert len(clean[6].split()) < 60
