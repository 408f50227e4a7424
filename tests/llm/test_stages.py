"""Pipeline stages on clashing names, empty tables, nulls and repeated rows; mixing by brute force."""
import re
from collections import Counter

import pytest

import corpus_pipeline
from screenlake.llm import decontaminate as DC
from screenlake.llm import mixing as MX
from screenlake.llm import simhash as SH
from screenlake.llm import toxicity as TX

CLASH = ["toxicity", "evidence_", "text_", "__row", "__keep", "__rank", "__text", "__spans", "__n_words", "__items", "mix_shard", "mix_order", "__id", "__size", "__src", "__c", "__n"]


@pytest.fixture
def clashing(spark, docs):
    rows = [(*r, *range(100, 100 + len(CLASH))) for r in docs.collect()]
    return spark.createDataFrame(rows, docs.schema.jsonValue() and ", ".join(
        ["doc_id bigint", "text string", "lang string", "source string", "size int", *[f"`{c}` int" for c in CLASH]]))


def stages(labels, bench):
    return {"toxicity": lambda d: TX.drop_toxic(d, TX.train(d, labels)), "near_dedup": SH.near_dedup, "decontamination": lambda d: DC.decontaminate(d, bench),
            "spans": lambda d: DC.decontaminate(d, bench, mode="spans"), "mixing": MX.mixed_in_order}


@pytest.mark.parametrize("name", ["toxicity", "near_dedup", "decontamination", "spans", "mixing"])
def test_stages_keep_clashing_columns(clashing, labels, bench, name):
    run = stages(labels, bench)[name]
    got = run(clashing)
    assert got.columns == clashing.columns
    rows, before = got.collect(), {r.text for r in clashing.collect()}
    assert rows and all([r[c] for c in CLASH] == list(range(100, 100 + len(CLASH))) for r in rows)
    assert name == "spans" or {r.text for r in rows} <= before
    assert run(clashing.limit(0)).count() == 0


def test_decontamination_stage_drops_what_holds_a_passage(clashing, bench):
    kept = [r.doc_id or 0 for r in DC.decontaminate(clashing, bench).collect()]
    # 1, 2 (twice) and 6 hold the first passage, 7 the second; an item without an id has no windows.
    # Both windows of the first passage hold word5, which row 9 has not
    assert sorted(kept) == [0, 3, 4, 5, 8, 9, 10]


def test_mix_keeps_its_targets_and_limits(clashing):
    plan = MX.taken(MX.mix_plan(clashing)).collect()
    size = {}
    for r in clashing.collect():
        size[r.source] = size.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    order = sorted(size, key=lambda x: (x is None, x or ""))
    weight, target, free, left = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, {}, set(order), sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * size[s]}
        if not full:
            break
        for s in full:
            target[s] = 3.0 * size[s]
            left -= target[s]
        free -= full
    target |= share
    source = {(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))): r.source for r in clashing.collect()}
    for r in plan:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and r.taken <= 3 * r["size"]
        shards = r.mix_shard.split(",") if r.mix_shard else []
        assert r["size"] == 0 or r.taken == r["size"] * len(shards)
        assert all(0 <= int(x) < 16 for x in shards) and len(r.mix_order.split(",")) == max(len(shards), 1)


def test_mixed_rows_come_in_shard_order(clashing):
    mixed = MX.mix(clashing)
    want = Counter((r.doc_id, r["text"]) for r in mixed.collect())
    got = MX.mixed_in_order(clashing).collect()
    assert Counter((r.doc_id, r["text"]) for r in got) == want
    order = [(r.doc_id, r["text"]) for r in mixed.orderBy(mixed.columns[-2:]).collect()]
    assert [(r.doc_id, r["text"]) for r in got] == order


def test_more_words_make_more_shards():
    assert MX.tree_levels(0) == MX.tree_levels(10**8) == 4 and MX.tree_levels(10**12) == 17


def test_empty_corpus_passes_all_stages(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
