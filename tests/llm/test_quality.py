import re
from collections import defaultdict

from cases import awkward, frame, invented

from stakeline.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    words, windows, seen, repeated = WORD.findall(text or ""), defaultdict(list), set(), 0
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text or ""), repeated, len(covered), failed)


def test_counts(spark):
    rows = awkward() + [(50, "a b c d e f a b c d e x y z w q r s t u v", *[None] * 10), (51, "a\x0bb\x0cc\rd\n\n#x|\n#x|\n \n", *[None] * 10)]
    rows += [(200 + i, t, *[None] * 10) for i, t in invented(80, words=("a", "b", "c.", "\n", "d|"))]
    docs = frame(spark, rows)
    got = Q.assess(docs).collect()
    want = sorted(repr((r.doc_id, *brute(r.text))) for r in docs.select("doc_id", "text").collect())
    assert sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_lines_are_judged_first(spark):
    good = "This is a whole sentence with quite enough words in it."
    other = "Another line comes after it without an end but with words"
    texts = {1: f"{good}\nHome | About | Contact\n{other}", 2: "Home | About\nMenu\n" * 30 + good, 3: good,
             4: f"{good}\nAll rights reserved by the owner of this page and others too.", 5: "Menu\nHome\nOne\nTwo\nThree\nFour\nFive\nSix\nSeven\nEight"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in Q.assess(docs).collect()}
    assert got[1].clean_text == f"{good}\n{other}" and got[1].kept
    assert got[3].clean_text == good and got[3].lost_share == 0 and got[3].kept
    assert not got[2].kept and got[4].clean_text == good
    assert got[5].clean_text == "" and not got[5].kept and not got[5].base_failed


def test_empty_table(spark):
    assert Q.assess(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = Q.assess(frame(spark, awkward()).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
