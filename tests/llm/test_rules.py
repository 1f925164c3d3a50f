import random
import re

from tests.llm.helpers import DOCS, prose, split_words
from tidelog.llm import rules


def plain_counts(text):
    text = text or ""
    words = split_words(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(i, i + 8))
    lines = [s for s in text.split("\n") if split_words(s)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)
    )


def test_counts_equal_the_definition(spark):
    seeded = random.Random(1)
    base = prose(seeded, 30)
    texts = [
        "", None, " \n\t ", "one", base, base + "\n" + base, base + " x " + base[:80] + "\n\n" + base, "a " * 60,
        "é ü\x0b中文 #|<x>\x0c y\x1cz", "l\nl\n l\nl\n\n \n\n", prose(seeded, 9) * 2, "x" * 200_000, (base + "\n") * 40,
    ]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], DOCS)
    got = {r[0]: tuple(r)[1:] for r in rules.text_counts(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {k: plain_counts(t) for k, t in enumerate(texts)}


def test_verdicts(spark):
    seeded = random.Random(2)
    clean = prose(seeded, 200)
    texts = {
        1: clean, 2: "short text", 3: "word " * 100, 4: " ".join(w + "###" for w in clean.split()),
        5: " ".join(w.upper() + "!!" for w in clean.split()), 6: "zxcv qwer " + " ".join(f"q{k}x" for k in range(90)), 7: None,
    }
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["failed_rules"] for r in rules.apply_rules(docs, ["doc_id"]).collect()}
    assert got[1] == [] and "n_words" in got[2] and "repeat_word_ratio" in got[3] and "symbol_ratio" in got[4]
    assert "exclamation_ratio" in got[5] and "stop_word_ratio" in got[6] and "n_words" in got[7]


def test_one_projection_clashing_names_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b", 1, 2), (1, "a b", 1, 2), (1, "a b", 1, 2)], "doc_id long, text string, n_words int, kept int")
    judged = rules.apply_rules(docs, ["doc_id"])
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert [r["n_words"] for r in judged.collect()] == [2, 2, 2]
    assert rules.apply_rules(docs.filter("false"), ["doc_id"]).count() == 0
