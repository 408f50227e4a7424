"""Runs of a piece are told apart by a hash table, and each is put together as the library encodes it."""
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from screenlake.llm import batches as B
from screenlake.llm import token_pack as TP


def test_repeated_runs_without_a_sort_of_all(monkeypatch):
    pytest.importorskip("public_tokenizers")
    from screenlake.llm.queries import vocab_path
    enc = TP.RunEncoder(TP.encoder(vocab_path()).tok)
    texts = ["the cat, the hat the cat", "", " \t", "hat the", "naïve 𝒳 the\ncat,", "z y x the a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t.encode()) for t in texts])
    monkeypatch.setattr(TP.np, "unique", None)          # sorted every run of a piece
    want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):                                  # the second time from the table
        ids, n = enc.piece(data, offs)
        assert n.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


def test_memory_of_many_different_runs(spark, monkeypatch):
    """A worker shares its executor's memory: few texts in the library at once, few temporaries beside the table."""
    made = []

    class Library:
        def encode_batch_fast(self, texts, add_special_tokens):
            made.append(len(texts))
            return [SimpleNamespace(ids=[len(t), *t.encode()[-3:]]) for t in texts]
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 400000, 300)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(TP, "encoder", lambda path, enc=TP.RunEncoder(Library()): enc)
    monkeypatch.setattr(TP, "map_batches", lambda df, run, schema: run)
    monkeypatch.setattr(TP, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run = TP.encode_blocks(spark.createDataFrame([], "doc_id bigint, text string"), "", 49408)
    for point in (0, 1):
        B.powers(1 << 22, point)                        # kept by the worker, not counted below
    tracemalloc.start()
    try:
        got = [np.frombuffer(b.column(7)[0].as_py(), "<u2") for b in run([batch])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.concatenate(got).tolist() == [i for t in texts for i in [*(x for w in t.split() for x in (len(w), *w.encode()[-3:])), TP.END_ID]]
    assert max(made) <= 1 << 12
    assert peak < 60e6, f"{peak / 1e6:.0f} MB"


def test_runs_share_a_text_of_the_library():
    """A text of its own for each run took two thirds of the worker's time."""
    pytest.importorskip("public_tokenizers")
    from screenlake.llm.queries import vocab_path
    tok, handed = TP.encoder(vocab_path()).tok, []

    class Spy:
        def encode_batch_fast(self, texts, add_special_tokens):
            handed.extend(texts)
            return tok.encode_batch_fast(texts, add_special_tokens=add_special_tokens)
    enc = TP.RunEncoder(Spy())
    rng = np.random.default_rng(11)
    plain = [" ".join(f"w{i} It's{i} été{i},".lstrip("w") for i in rng.integers(0, 10**6, 100)) for _ in range(20)]
    odd = ["\x01", "a\x01 b \x01\x01 !\x01", "\x00 \x1c \x1f\x7f", "   x ﻿ 　", "́e é E̱ Å", "İ ΑΣ ΣΑ ß",
           "한 한", "<|endoftext|> a<|startoftext|>b <|end oftext|> <|ENDOFTEXT|>", "'s 're''ll x's's", "𝒳👍🏽 0x1F ---!!", "</w> a</w>"]
    for texts in (plain, [*plain, *odd], odd, odd):
        raw = [t.encode() for t in texts]
        handed.clear()
        ids, n = enc.piece(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
        if texts is plain:
            assert 1 <= len(handed) <= 30, len(handed)       # some 6000 runs
        elif texts is odd:
            enc.clear()                                      # the second time with marks in the only group


@pytest.mark.parametrize("values", [np.full(100000, 255, np.uint8), np.full(70000, (1 << 64) - 1, np.uint64), np.full(70000, (1 << 61) - 2, np.uint64)])
@pytest.mark.parametrize("point", [0, 1])
def test_prefix_hash_of_the_largest_values(values, point):
    """Sums of a block are reduced once; the largest values over some blocks against Python integers."""
    p, x, want, power = int(B.P61), B.POINTS[point], [0], 1
    for v in values.tolist():
        want.append((want[-1] + (v % p + 1) * power) % p)
        power = power * x % p
    assert B.prefix_hash(values, point).tolist() == want
