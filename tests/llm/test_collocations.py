"""Collocations against a brute-force count, both ways of relabelling, awkward rows."""
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.llm import collocations as CO
from screenlake.llm import queries as Q

SF = "/root/testdata/sf0.001"


def brute(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    inside = {(lang, p[i:j]) for (lang, p), a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
              if j - i < len(p) and 100 * a >= 100 * f[lang, p[i:j]]}
    out = {}
    for (lang, p), a in cand.items():
        if (lang, p) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, lf, rf, n[lang], -s) for lang, xs in out.items() for i, (s, a, p, lf, rf) in enumerate(sorted(xs)[:top]))


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(spark):
    docs = Q.table(spark, SF, "documents").select("text", "lang")
    return docs, [(r.text, r.lang) for r in docs.collect()]


@pytest.mark.parametrize("bound,least,top", [(CO.BOUND, 12, 2000), (0, 12, 40)])
def test_equals_brute_force(corpus, bound, least, top, monkeypatch):
    monkeypatch.setattr(CO, "DENSE", 40)
    docs, rows = corpus
    want = brute(rows, least, top=top)
    assert len(want) > 50 and any(len(r[2].split()) == 5 for r in want)
    assert got(CO.collocations(docs, min_count=least, bound=bound, top=top)) == want


def test_hash_ties_of_words_change_the_seed(spark, monkeypatch):
    docs = spark.createDataFrame([("a b c a b", "en")] * 5, "text string, lang string")
    words = CO.word_counts

    def tied(texts, seed):
        return words(texts, seed).withColumn("h", F.lit(7).cast("bigint")) if seed == 0 else words(texts, seed)
    monkeypatch.setattr(CO, "word_counts", tied)
    assert got(CO.collocations(docs, min_count=3)) == brute([("a b c a b", "en")] * 5, 3)


def test_tiled_counts(monkeypatch):
    monkeypatch.setattr(CO, "DENSE", 30)
    monkeypatch.setattr(CO, "TILES", 3)
    rng = np.random.default_rng(2)
    keys = (rng.zipf(1.3, 20000) % 3000 + 1 << CO.ID_BITS) | (rng.zipf(1.3, 20000) % 3000 + 1)
    counts = CO.TiledCounts()
    for part in np.array_split(keys, 7):
        counts.add(part)
    found = Counter()
    for k, c in [counts.sparse(), *counts.tiles()]:
        for x, y in zip(k.tolist(), c.tolist()):
            found[x] += y
    assert len(counts.dense) == 3 and found == Counter(keys.tolist())


def test_awkward_rows(spark):
    rows = [(None, "en", 1), ("", None, 1), (" \t", "en", 1), ("A b. a B\x0bc a\tb c", None, 1), ("a b", "und", 1), ("x " * 5000, "de", 1), ("x x", "de", 1), ("x x", "de", 1)]
    docs = spark.createDataFrame(rows, "text string, lang string, seq int")
    assert got(CO.collocations(docs, min_count=2)) == brute([r[:2] for r in rows], 2)
    assert got(CO.collocations(docs.limit(0), min_count=2)) == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    found = spark.createDataFrame([("en", "a b", 2, 9 * 10**14, [9 * 10**15 + 7], [9 * 10**15 + 9], None)],
                                  "lang string, phrase string, size int, c bigint, pre array<bigint>, suf array<bigint>, longer bigint")
    sizes = spark.createDataFrame([("en", 10**17 + 3)], "lang string, n bigint")
    monkeypatch.setattr(CO, "frequent_phrases", lambda *a: (found, sizes))
    want = 1000 * 9 * 10**14 * (10**17 + 3) // ((9 * 10**15 + 7) * (9 * 10**15 + 9))
    assert CO.collocations(found).first().score == want


def test_large_groups_are_cut_in_rounds(spark):
    rows = spark.range(5000).select(F.lit("en").alias("lang"), F.concat(F.lit("p"), "id").alias("phrase"), (F.col("id") * 7919 % 1009).alias("score"))
    order = [F.desc("score"), F.asc("phrase")]
    want = rows.orderBy(*order).limit(9).select("phrase").collect()
    out = CO.top_rows(rows, "lang", order, 9, "phrase").orderBy("rank").collect()
    assert [r.phrase for r in out] == [r.phrase for r in want] and [r["rank"] for r in out] == list(range(1, 10))
