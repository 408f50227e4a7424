"""Hashed fingerprint against a count gram by gram in plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from screenlake.operators import features as X


def brute(text, nbits, q):
    norm = "".join("0" if c in "123456789" else c for c in text)
    return Counter(int(hashlib.md5(norm[i:i + q].encode()).hexdigest()[:8], 16) % nbits for i in range(len(norm) - q + 1))


TEXTS = ["", "abc", "abcd", "C1CC1", "aaaaaaaaaa", "naïve 𝒳𝒴 text\nwith lines 2024", "".join(chr(0x4E00 + i * 7 % 5000) for i in range(900)), "xy" * 700]


@pytest.mark.parametrize("q", [1, 2, 4, 9])
@pytest.mark.parametrize("limit", [5, 64, 1 << 20])
def test_pieces_count_every_gram_once(q, limit):
    got = [Counter() for _ in TEXTS]
    for piece in X.text_pieces(TEXTS, q, limit):
        assert len(piece) == 1 or sum(len(t) for _, t in piece) <= limit
        who, bit, cnt = X.piece_bits([t for _, t in piece], 512, q)
        for w, b, c in zip(who.tolist(), bit.tolist(), cnt.tolist()):
            got[piece[w][0]][b] += c
    assert got == [brute(t, 512, q) for t in TEXTS]


def test_gram_numbers_of_a_wide_alphabet():
    points = np.random.default_rng(3).integers(0, 1 << 20, 4000).astype(np.uint32)
    points = np.concatenate([points, points])
    at, gram = X.gram_ids(points, 6)
    for i in range(0, gram.size, 97):
        assert (points[at[gram[i]]:at[gram[i]] + 6] == points[i:i + 6]).all()
    assert at.size == len({points[i:i + 6].tobytes() for i in range(gram.size)})


def test_fingerprint_of_nulls_repeated_keys_and_string_keys(spark):
    rows = [("a", "C1CC1"), ("a", "abcd"), (None, "abcd"), ("n", None), ("e", "")]
    fp = X.hashed_fingerprint(spark.createDataFrame(rows, "key string, text string"), nbits=64)
    want = Counter()
    for k, t in rows:
        for b, c in brute(t or "", 64, 4).items():
            want[(k, b)] += c
    assert {(r.key, r.bit): r.cnt for r in fp.collect()} == dict(want)


@pytest.mark.parametrize("nbits", [512, 1 << 16])
def test_looked_up_bits_are_those_of_every_gram(nbits, monkeypatch):
    monkeypatch.setattr(X, "KNOWN_POINTS", 64)          # the wide text has no room, the others fill the tables
    monkeypatch.setattr(X, "KNOWN_PAIRS", 64)
    texts = TEXTS + ["".join(chr(97 + (i * i + k) % 23) for i in range(80)) for k in range(5)]
    table, got, looked_up = X.GramBits(nbits), [Counter() for _ in texts], 0
    for piece in X.text_pieces(texts * 2, 4, 64):
        looked_up += table.of(np.frombuffer("".join(t for _, t in piece).encode("utf-32-le") or b"\0" * 16, np.uint32)) is not None if sum(len(t) for _, t in piece) > 3 else 0
        who, bit, cnt = X.piece_bits([t for _, t in piece], nbits, 4, {}, table)
        for w, b, c in zip(who.tolist(), bit.tolist(), cnt.tolist()):
            got[piece[w][0] % len(texts)][b] += c
    assert got == [Counter({b: 2 * c for b, c in brute(t, nbits, 4).items()}) for t in texts]
    assert looked_up


def test_few_patterns_need_no_substrings_of_the_texts(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a[Dy]b C(=O) C(=O)"), (2, "C(=O)"), (3, ""), (4, None), (5, "Dy] [Dy")], "key int, text string")
    table = spark.createDataFrame([(1, r"\[Dy\]", 1), (2, r"C\(=O\)", 2), (3, r"C\(=O\)", 1), (4, "a", 1)], "key_id int, regex string, min_count int")

    def found():
        keys = X.pattern_keys_from_table(df, table)
        return keys._jdf.queryExecution().analyzed().toString().count("regexp_extract_all"), {tuple(r) for r in keys.collect()}
    few = found()
    monkeypatch.setattr(X, "FEW_PATTERNS", 0)
    many = found()
    assert few == (0, {(1, 1), (1, 2), (1, 3), (1, 4), (2, 3)}) and many[0] and many[1] == few[1]
