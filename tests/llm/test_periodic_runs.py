"""Periodic runs against brute force, the common extensions alone, awkward rows."""
import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from screenlake.llm import periodic_runs as PR
from screenlake.llm import queries as Q

SF = "/root/testdata/sf0.001"


def brute(w, least=24):
    """All runs by scanning every period."""
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if n >= max(least, 3 * q) and not any(all(w[k] == w[k + d] for k in range(s, s + n - d)) for d in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or n == 0:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def digest(doc_id, w):
    runs = brute(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_common_extensions():
    rng = np.random.default_rng(1)
    for size, kinds in ((1, 1), (2, 1), (14, 1), (60, 2), (300, 2), (700, 3), (1500, 40)):
        w = rng.integers(1, kinds + 1, size)
        if size == 700:
            w = np.concatenate([w, w, w])
        lce = PR.CommonExtension(w)
        i, j = np.triu_indices(min(w.size, 120), 1)
        j = j + (w.size - min(w.size, 120)) * (np.arange(j.size) % 2)
        if i.size:
            want = [next((t for t in range(w.size - b) if w[a + t] != w[b + t]), w.size - b) for a, b in zip(i.tolist(), j.tolist())]
            assert lce(i, j).tolist() == want


def test_cover_has_every_difference():
    assert {(b - a) % PR.V for a in PR.COVER for b in PR.COVER} == set(range(PR.V))


@pytest.mark.parametrize("least,probes", [(24, 1 << 20), (24, 50), (3, 1 << 20), (7, 1 << 20)])
def test_runs_equal_brute_force(least, probes, monkeypatch):
    monkeypatch.setattr(PR, "PROBES", probes)
    rng = np.random.default_rng(least)
    texts = []
    for k in range(60):
        if k % 3 == 0:
            w = rng.integers(0, 1 + k % 4, rng.integers(0, 120)).tolist()
        else:
            w = []
            while len(w) < 150:
                w += rng.integers(0, 5, rng.integers(1, 12)).tolist() * int(rng.integers(1, 9))
        texts.append(w)
    _, borders, local, _ = PR._piece_runs([" ".join(map(str, w)).encode() for w in texts], least)
    for d, w in enumerate(texts):
        assert [tuple(r) for r in local[:, borders[d]:borders[d + 1]].T.tolist()] == brute(w, least)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = sorted(digest(i, planted(i, t.encode().decode().split() if t.isascii() else [x.decode() for x in t.encode().split()])) for i, t in docs)
    got = sorted(tuple(r) for r in Q.op11_periodic_runs(spark, SF).collect())
    assert got == want and any(r[1] for r in want)


def test_awkward_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n\x0b", 0), (4, "x " * 24, 0), (4, "x " * 24, 0), (None, "a b " * 12, 0), (5, "x " * 23, 0),
            (6, "x\u00a0y " * 30, 0), (7, " ".join(f"w{i}" for i in range(3000)) + " z" * 5000, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], len(r.collapsed)) for r in PR.periodic_runs(docs).collect()))
    assert got == [(0, 24, [(0, 24, 2)], 3), (1, 0, [], 0), (2, 0, [], 0), (3, 0, [], 0), (4, 24, [(0, 24, 1)], 1), (4, 24, [(0, 24, 1)], 1),
                   (5, 23, [], 45), (6, 30, [(0, 30, 1)], 3), (7, 8000, [(3000, 5000, 1)], len(rows[8][1]) - 2 * 4999)]
    assert PR.run_digests(PR.periodic_runs(docs.limit(0))).count() == 0
