"""Quality rules against a brute-force count, and on awkward rows."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from screenlake.llm import quality_rules as QR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    again = {k for i, x in enumerate(windows) if n[x] > 1 for k in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


TEXTS = [None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c", "x x x x", "x x x x x x", "line\nline\n\n \nline", "#*$%&|<> §",
         "Ärger hier   da\x0bdort\x0c𝄞𝄞 x", " ".join(f"w{i % 40}" for i in range(200)), "the cat and the dog " * 30,
         " ".join(f"u{i}" for i in range(60)), "tail\r\ntail\r\n", "a b c " + " ".join(f"v{i}" for i in range(80)) + " a b c"]


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in QR.verdicts(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_hash_ties_are_compared_word_by_word(spark, monkeypatch):
    monkeypatch.setattr(QR, "LOW31", "3L")                     # four hash values: nearly all windows tie
    text = " ".join(f"w{i % 17}" if i % 5 else f"z{i}" for i in range(120))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert QR.measures(docs).first().n_repeat_words == brute(text)[4]


def test_one_projection_without_shuffle_or_python(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    plan = QR.verdicts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_keep_good_keeps_rows_and_clashing_columns(spark):
    good = " ".join("the" if i % 6 == 0 else f"house{i}" for i in range(90))
    rows = [(1, good, "a", 1), (1, good, "a", 1), (2, "short", "b", 2), (None, good, None, 3), (3, None, "c", 4), (4, good.replace(" ", " # ", 60), "d", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, text_ string, n_words int").withColumnRenamed("n_words", "measures_")
    got = QR.keep_good(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r["text_"] or "", r["measures_"]) for r in got.collect()) == [(0, "", 3), (1, "a", 1), (1, "a", 1)]
    assert QR.keep_good(docs.limit(0)).count() == 0 and QR.verdicts(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rule,text", [("symbols", "the # and # of # " * 40), ("bullet_lines", "\n".join(f"- the item {i} and more" for i in range(30))),
                                       ("cut_lines", "\n".join(f"the item {i} and more..." for i in range(30))),
                                       ("repeated_lines", "\n".join(f"the item {i % 4} and more" for i in range(30))),
                                       ("stop_words", " ".join(f"word{i}" for i in range(80))), ("word_length", "a b c d e f g h " * 20)])
def test_each_rule_breaks(spark, rule, text):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    r = QR.verdicts(docs).first()
    assert rule in r.broken.split(",") and not r.kept
    assert rule not in QR.verdicts(docs, rules=()).select(F.col("broken")).first().broken
