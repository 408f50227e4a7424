"""Operators against brute force and on awkward rows."""
import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from screenlake.llm import decontaminate as DC
from screenlake.llm import induced_sort as IS
from screenlake.llm import langid as LI
from screenlake.llm import line_dedup as LD
from screenlake.llm import mixing as MX
from screenlake.llm import order_minhash as OM
from screenlake.llm import paragraph_dedup as PD
from screenlake.llm import simhash as SH
from screenlake.llm import suffix_dedup as SD
from screenlake.llm import token_pack as TP
from screenlake.llm import toxicity as TX
from screenlake.llm.queries import VOCAB_SIZE, table, vocab_path

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", ["toxicity", "mixing", "suffix", "lines", "paragraphs", "omh", "simhash", "lang", "tokens", "bench"])
def test_awkward_and_empty_rows(docs, labels, bench, name):
    run = {"toxicity": lambda d: TX.toxicity(d, labels), "mixing": lambda d: MX.taken(MX.mix_plan(d)), "suffix": SD.remove_repeats,
           "lines": LD.line_report, "paragraphs": PD.paragraph_report, "omh": OM.edited_pairs, "simhash": SH.simhash_components,
           "lang": LI.identify, "tokens": lambda d: TP.token_files(d, vocab_path(), VOCAB_SIZE), "bench": lambda d: DC.contamination(d, bench)}[name]
    assert run(docs).count() == 12
    assert run(docs.limit(0)).count() == 0


def test_induced_sort_against_sorting():
    rng = np.random.default_rng(5)
    for _ in range(150):
        parts = [rng.integers(1, rng.integers(2, 5), rng.integers(1, 25)) for _ in range(rng.integers(1, 6))]
        t = np.concatenate([np.append(x, 0) for x in parts + parts[:1]]).astype(np.int16)
        n_sep, k, u = int((t == 0).sum()), 0, []
        for x in t.tolist():
            u.append(k if x == 0 else x + n_sep)
            k += x == 0
        assert IS.suffix_array(t).tolist() == sorted(range(len(u)), key=lambda i: u[i:])


@pytest.mark.parametrize("hot", [0, 2000])
def test_suffix_dedup_brute_force(spark, hot):
    docs = table(spark, SF, "documents").limit(120).cache()
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    seen = Counter(b[p:p + 200] for b in texts.values() for p in range(len(b) - 199))
    want = {}
    for i, b in texts.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want[i] = (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in SD.remove_repeats(docs, hot=hot).collect()}
    assert got == want


def test_simhash_brute_force(spark):
    docs = table(spark, SF, "documents").cache()
    fp = {}
    for r in docs.collect():
        w = r.text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fp[r.doc_id] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    comp = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            for b in fp:
                if comp[b] < comp[a] and (fp[a] ^ fp[b]).bit_count() <= 3:
                    comp[a], changed = comp[b], True
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in SH.simhash_components(docs).collect()}
    assert got == {i: (fp[i], comp[i]) for i in fp}


@pytest.mark.parametrize("bucket", [1, 2, 1024])
def test_simhash_links_at_any_bucket_size(spark, bucket):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 40)
    x = np.unique(np.concatenate([base, *[base ^ sum(1 << int(b) for b in rng.choice(62, k, False)) for k in (1, 2, 3, 4)]]))
    edges = {frozenset(e) for e in rows(SH.link_edges(spark.createDataFrame([(int(v),) for v in x], "fp bigint"), bucket=bucket))}
    root = {int(v): int(v) for v in x}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in (tuple(e) for e in edges if len(e) == 2):
        root[find(a)] = find(b)
    for i, a in enumerate(x.tolist()):
        for b in x[i + 1:].tolist():
            if (a ^ b).bit_count() <= 3:
                assert find(a) == find(b)


def test_tokens_equal_the_library(spark, tmp_path):
    from tokenizers import Tokenizer
    docs = table(spark, SF, "documents")
    tok, at = Tokenizer.from_file(vocab_path()), 0
    got = {r.doc_id: r for r in TP.token_files(docs, vocab_path(), VOCAB_SIZE, path=str(tmp_path / "ids")).collect()}
    import zlib
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = tok.encode(r.text, add_special_tokens=False).ids + [2]
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert TP.read_range(spark, str(tmp_path / "ids"), 100, 160).count() == 60


@pytest.mark.parametrize("width", [1, 5, 15, 16, 17, 31])
def test_packing_round_trip(width):
    ids = np.random.default_rng(1).integers(0, 1 << width, 1000).astype(np.uint32)
    raw = TP.pack(ids, width)
    assert (TP.unpack(raw, 1000, width) == ids).all() and (TP.unpack(raw, 77, width, 123) == ids[123:200]).all()


def test_line_dedup_one_edit(spark):
    a, b = "a line that is long enough to be compared", "another quite different line of some length"
    text = [(1, f"{a}\n{b}\nshort"), (2, f"{a}x\nshort\nshorT"), (3, a.replace("long", "lung")), (4, b[1:]), (5, "xx" + a)]
    got = {r.doc_id: r.removed for r in LD.line_report(spark.createDataFrame(text, "doc_id bigint, text string")).collect()}
    assert got == {1: [], 2: [0, 1], 3: [0], 4: [0], 5: []}


@pytest.mark.parametrize("bucket", [1, 256])
def test_paragraph_edges_connect_similar_sets(spark, bucket):
    sets = [(i, np.unique(np.array([j * 0x9E3779B97F4A7C15 % (1 << 63) for j in range(1, 101) if j != i + 1] + [10_000 + i], np.uint64)).tobytes()) for i in range(6)]
    edges = rows(PD.similar_edges(spark.createDataFrame(sets, "h1 bigint, shingles binary"), *PD.tune_bands(), bucket=bucket))
    assert len({v for e in edges for v in e}) == 6


def test_spans_are_cut():
    assert DC.remove_spans("One two, three four", [(1, 3)]) == "One  four"


def test_mix_meets_targets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    plan = MX.mix_plan(docs).cache()
    per = rows(plan.selectExpr("source", "source_size", "target", "size * size(copies) as t").groupBy("source", "source_size", "target").agg({"t": "sum"}))
    assert all(abs(t - target) <= 0.03 * target + 50 and target <= 3 * size for _, size, target, t in per)
    assert abs(sum(p[2] for p in per) - sum(p[1] for p in per)) < 1e-3
    assert rows(plan.selectExpr("doc_id", "copies").sort("doc_id")) == rows(MX.mix_plan(docs).selectExpr("doc_id", "copies").sort("doc_id"))


def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = LI.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.98 * got.count()


def test_run_table_drops_runs_and_ids_stay_right(monkeypatch):
    from tokenizers import Tokenizer

    from screenlake.llm import token_pack
    monkeypatch.setattr(token_pack, "KEPT_RUNS", 8)
    path = vocab_path()
    enc, tok = token_pack.RunEncoder(Tokenizer.from_file(path)), Tokenizer.from_file(path)
    texts = ["a b c d", "a b x y z", "", "a q w e r t", "one two three four five six seven eight nine ten a b", "a b a"]
    for t in texts * 2:
        raw = np.frombuffer(t.encode(), np.uint8)
        ids, n = enc.piece(raw, np.array([0, raw.size]))
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids and n.tolist() == [len(ids)]


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs, lab = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    held = docs.join(lab.select("doc_id", "toxic"), "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    return TX.train(docs, lab), held.select("doc_id", "text", "toxic").cache()


def test_toxicity_held_out_recall_and_false_positives(toxic_model):
    model, held = toxic_model
    got = TX.score(held, model).groupBy("toxic").agg(F.avg((F.col("toxicity") >= 0.5).cast("int")).alias("hit"))
    hit = {r.toxic: r.hit for r in got.collect()}
    assert hit[1] >= 0.85 and hit[0] <= 0.01


def test_long_clean_texts_are_not_toxic(spark, toxic_model):
    model, held = toxic_model
    clean = [r.text for r in held.filter("toxic = 0").orderBy("doc_id").collect()]
    rng = np.random.default_rng(1)
    long = [(k, "\n".join(clean[i] for i in rng.integers(0, len(clean), k))) for k in (20, 100, 400) for _ in range(5)]
    got = TX.score(spark.createDataFrame(long, "parts int, text string"), model)
    assert got.filter("toxicity >= 0.5").count() == 0


def test_joined_toxicity_table_gives_the_same(toxic_model):
    model, held = toxic_model
    some = held.limit(200).select("doc_id", "text").cache()
    a, b = (rows(TX.score(some, m).select("doc_id", F.round("toxicity", 9))) for m in (model, model | {"shared": None}))
    assert sorted(a) == sorted(b) and len(a) == some.count()


def test_near_dedup_brute_force_without_and_with_repeated_ids(spark):
    rng = np.random.default_rng(5)

    def text():
        return " ".join(f"w{x}" for x in rng.integers(0, 10**6, 60))
    a, b, c, d, e = (text() for _ in range(5))
    data = [(1, a), (1, b), (2, a), (2, c), (None, d), (None, e), (None, e), (None, b), (3, c), (4, None), (None, "")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    # different texts lie far apart, equal ones (and null with empty) in one component
    want = {}
    for i, t in data:
        want.setdefault(t or "", []).append(i)
    want = sorted((t, min((i is None, i or 0) for i in ids)) for t, ids in want.items())
    got = [(r.text or "", (r.doc_id is None, r.doc_id or 0)) for r in SH.near_dedup(docs).collect()]
    assert sorted(got) == want


def test_pipeline_run_keeps_rows_of_null_and_repeated_ids(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(4)]
    data = [(None, texts[0], "en", "a", 10), (None, texts[1], "en", "a", 10), (1, texts[2], "en", "a", 10), (1, texts[3], "en", "a", 10), (2, texts[3], "en", "a", 10)]
    spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = {}

    def written(df, name="stage", **kw):
        seen[name] = df.cache()
        return df
    monkeypatch.setattr(corpus_pipeline, "materialize", written)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert sorted(r.text for r in seen["pipeline-near_dedup"].collect()) == sorted(texts)


def test_paragraph_large_band_compares_every_pair(spark):
    rng = np.random.default_rng(11)
    base = rng.integers(1, 1 << 62, 60)
    sets = []
    for _ in range(150):                      # all over one template; pairs at 0.8 among them
        x = base.copy()
        x[rng.choice(60, 11, False)] = rng.integers(1, 1 << 62, 11)
        y = x.copy()
        y[rng.choice(60, 6, False)] = rng.integers(1, 1 << 62, 6)
        sets += [x, y]
    nodes = spark.createDataFrame([(i, np.unique(x).astype(np.uint64).tobytes()) for i, x in enumerate(sets)], "h1 bigint, shingles binary")
    edges = rows(PD.similar_edges(nodes, 1, 1, 0.8, bucket=8))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        assert PD.similar(frozenset(sets[a].tolist()), frozenset(sets[b].tolist()), 0.8)
        root[find(a)] = find(b)
    band = [int(k) for k in PD.band_keys(np.concatenate([np.unique(x).astype(np.uint64) for x in sets]), np.array([np.unique(x).size for x in sets]), 1, 1)[:, 0]]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if band[i] == band[j] and PD.similar(frozenset(sets[i].tolist()), frozenset(sets[j].tolist()), 0.8)]
    assert pairs and all(find(i) == find(j) for i, j in pairs)
