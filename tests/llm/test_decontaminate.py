"""Benchmark windows against brute force, in one block and in many."""
import re

import pytest

from screenlake.llm import decontaminate as DC
from screenlake.llm.queries import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall(DC.ascii_lower(text or ""))


def brute(docs, items, n=10):
    """Per (id, text): number of words, hit words, items found."""
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size and item is not None else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    lengths, out = {len(k) for k in windows}, {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for size in lengths:
            for a in range(len(w) - size + 1):
                got = windows.get(tuple(w[a:a + size]))
                if got:
                    hit |= set(range(a, a + size))
                    found |= got
        out[i, text] = (len(w), hit, sorted(found))
    return out


def covered(spans):
    return {j for a, b in spans for j in range(a, b)}


@pytest.mark.parametrize("block_bytes", [2000, 20_000, DC.BLOCK_BYTES])
def test_contamination_equals_brute_force(spark, block_bytes):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    if block_bytes == 2000:
        bench = bench.orderBy("item_id").limit(4)       # every block is a scan of its own
    # an item twice, one inside another, a short one
    more = spark.createDataFrame([(900001, bench.first().text), (900002, bench.first().text), (900003, "the")], bench.select("item_id", "text").schema)
    bench = bench.select("item_id", "text").union(more).cache()
    assert (len(DC.window_blocks(bench, block_bytes=block_bytes)) > 1) == (block_bytes < DC.BLOCK_BYTES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {k[0]: v for k, v in brute(rows, [tuple(r) for r in bench.collect()]).items()}
    got = {r.doc_id: (r.n_words, covered(r.spans), r["items"]) for r in DC.contamination(docs, bench, block_bytes=block_bytes).collect()}
    assert got == want and any(v[1] for v in want.values())


@pytest.mark.parametrize("block_bytes", [300, DC.BLOCK_BYTES])
def test_awkward_rows_and_string_ids(docs, bench, block_bytes):
    bench = bench.selectExpr("cast(item_id as string) as item_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, [tuple(r) for r in bench.collect()])
    got = DC.contamination(docs, bench, block_bytes=block_bytes).collect()
    assert sorted((r.doc_id or 0, r.n_words, sorted(covered(r.spans)), r["items"]) for r in got) == \
        sorted((i or 0, want[i, t][0], sorted(want[i, t][1]), want[i, t][2]) for i, t in rows)
    kept = DC.decontaminate(docs, bench, block_bytes=block_bytes)
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted((i or 0, t or "") for i, t in rows if not want[i, t][1])


def test_segments_of_a_long_item_hold_every_window_once(spark):
    text = " ".join(f"W{i}" for i in range(100))
    bench = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "Two words")], "item_id bigint, text string")
    got = DC.window_table(DC.item_segments(bench, segment_windows=7))
    t = got["sizes"][10]
    assert sorted(got["words"][a:b].decode() for a, b in zip(t["start"], t["end"])) == sorted(" ".join(f"w{i}" for i in range(k, k + 10)) for k in range(91))
    assert sorted(got["sizes"]) == [2, 10] and t["hashes"].size == 91 and t["same"].all()


def test_windows_of_one_hash_are_told_apart(spark):
    got = DC.window_table(DC.item_segments(spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c d")], "item_id bigint, text string")))
    t = got["sizes"][2]
    order = sorted(range(3), key=lambda i: got["items"][t["item"][i]])
    got["sizes"][2] = {"hashes": t["hashes"][:1], "at": [0, 3], **{c: t[c][order] for c in ("item", "start", "end")}, "same": [False]}
    assert [[got["items"][i] for i in DC.items_with(got, 2, 0, x)] for x in (b"a b", b"c d", b"e f")] == [[1, 2], [3], []]


def test_empty_benchmark_changes_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert DC.decontaminate(docs, none).count() == docs.count() == DC.contamination(docs, none).filter("size(spans) = 0").count()
