"""Order MinHash and language ID against plain Python."""
import hashlib
import math
import re
from collections import Counter

import pytest
import xxhash
import zlib
from pyspark.sql import functions as F

from screenlake.llm import langid as LI
from screenlake.llm import order_minhash as OM
from screenlake.llm.queries import table

SF = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, bins = Counter(), {}
    for i, x in enumerate(w):
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        if i + 1 < len(w):
            h = xxhash.xxh64_intdigest(w[i + 1].encode(), h)
        h &= 0x7FFFFFFF
        n, seen[h] = seen[h], seen[h] + 1
        if n:
            h = xxhash.xxh64_intdigest(n.to_bytes(4, "little"), xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42)) & 0x7FFFFFFF
        bins.setdefault(h >> 26, []).append((h, i))
    out = []
    for b, elements in sorted(bins.items()):
        in_order = sorted((i, h) for h, i in sorted(elements)[:OM.ELL])
        tuple_hash = xxhash.xxh64_intdigest(",".join(str(h) for _, h in in_order).encode(), 42) & 0xFFFF
        out.append(f"{b:02x}{tuple_hash:04x}")
    return ",".join(out)


def likeness(a, b):
    x, y = ({e for e in f.split(",") if e} for f in (a, b))
    used = {e[:2] for e in x | y}
    return len(x & y) / len(used) if used else 1.0


def test_order_minhash_brute_force(spark):
    docs = table(spark, SF, "documents")
    text = dict(sorted((r.doc_id, r.text or "") for r in docs.collect()))
    text |= {max(text) + 1: "", max(text) + 2: "one", max(text) + 3: "again and again and again and again " * 40, max(text) + 4: "Ärger \U0001F600 größe"}
    ids = sorted(text)
    got = {r.doc_id: r for r in OM.edited_pairs(spark.createDataFrame(list(text.items()), "doc_id bigint, text string")).collect()}
    assert sorted(got) == ids
    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, r = text[i], got[i]
        q = len(t) // 4
        edited = t[:len(t) - q] + text[after][:q]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = fingerprint(t), fingerprint(edited), fingerprint(text[after])
        assert (r.fingerprint, r.edited_fingerprint) == (a, b)
        assert (r.near_edited, r.near_next) == pytest.approx((likeness(a, b), likeness(a, c)))


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def buckets(text):
    """Buckets of the n-grams: letters, runs of others as one blank, a blank at either end."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    sym = " " + re.sub(" +", " ", letters).lstrip() + " "
    for n in LI.SIZES:
        for i in range(len(sym) - n + 1):
            h = 0
            for c in sym[i:i + n]:
                h = (h * 0x100000001B3 & M64) ^ ord(c)
            yield mixed(h + n & M64) & LI.BUCKETS - 1


def test_language_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang", F.substring("text", 1, 1500).alias("text")).orderBy("doc_id").limit(120)
    extra = spark.createDataFrame([(10**6, None, None), (10**6 + 1, None, "12 !!"), (10**6 + 2, None, ""), (10**6 + 3, "en", None)], "doc_id bigint, lang string, text string")
    docs = docs.union(extra).cache()
    rows, learned = docs.collect(), {}
    n_docs, memo = Counter(), {r.doc_id: Counter(buckets(r.text or "")) for r in docs.collect()}
    for r in rows:
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            learned.setdefault(r.lang, Counter()).update(memo[r.doc_id])
            n_docs[r.lang] += 1
    total = {x: sum(c.values()) + LI.ALPHA * LI.BUCKETS for x, c in learned.items()}
    got = {r.doc_id: r for r in LI.identify(docs).collect()}
    assert sorted(got) == sorted(r.doc_id for r in rows)
    for r in rows:
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not any(c.isalpha() for c in r.text or ""):
            assert (g.lang_pred, g.score) == ("und", 0.0)
            continue
        score = {}
        for x in sorted(learned):
            s = round(math.log(n_docs[x] / sum(n_docs.values())) * LI.SCALE)
            for b, n in memo[r.doc_id].items():
                s += n * round((math.log(LI.ALPHA + learned[x][b]) - math.log(total[x])) * LI.SCALE)
            score[x] = s / LI.SCALE
        best = max(sorted(score), key=lambda x: score[x])
        assert g.lang_pred == best
        assert g.score == pytest.approx(1 / sum(math.exp(s - score[best]) for s in score.values()), abs=1e-3)
