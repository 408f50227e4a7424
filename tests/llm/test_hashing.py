"""Slice hashes: residues against Python integers, and strings that collide modulo 2**64."""
import numpy as np
import pytest

from screenlake.llm import batches as B
from screenlake.llm import line_dedup as LD
from screenlake.llm import paragraph_dedup as PD
from screenlake.llm import token_pack as TP
from screenlake.llm.queries import vocab_path


def thue_morse(n, a, b):
    return "".join(b if i.bit_count() & 1 else a for i in range(n))


def test_products_of_residues():
    rng = np.random.default_rng(1)
    a, b = (mod for mod in (B.mod61(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)) for _ in range(2)))
    p = int(B.P61)
    assert B.mul61(a, b).tolist() == [x * y % p for x, y in zip(a.tolist(), b.tolist())]
    assert B.sub61(a, b).tolist() == [(x - y) % p for x, y in zip(a.tolist(), b.tolist())]


@pytest.mark.parametrize("values", [(np.arange(700) % 251).astype(np.uint8), np.arange(700, dtype=np.uint32) * 99991, np.arange(700, dtype=np.uint64) * 0x9E3779B97F4A7C15])
@pytest.mark.parametrize("point", [0, 1])
def test_slices_do_not_depend_on_their_place(values, point):
    x = np.concatenate([values, values])
    pre, s = B.prefix_hash(x, point), np.arange(600)
    one, two = B.span_value(pre, s, s + 100, point), B.span_value(pre, s + 700, s + 800, point)
    assert (one == two).all() and np.unique(one).size == 600 - (349 if values.dtype == np.uint8 else 0)
    p, at = int(B.P61), B.POINTS[point]
    assert int(one[5]) == sum((int(v) + 1) * pow(at, i, p) for i, v in enumerate(values[5:105].tolist())) % p


def test_thue_morse_runs_get_their_own_ids():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocab_path())
    enc = TP.RunEncoder(tok)
    for n in (1024, 2048):
        for t in (thue_morse(n, "a", "b"), thue_morse(n, "b", "a"), thue_morse(n, "a", "b") + " " + thue_morse(n, "b", "a")):
            raw = np.frombuffer(t.encode(), np.uint8)
            assert enc.piece(raw, np.array([0, raw.size]))[0].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_thue_morse_lines_and_paragraphs_stay(spark):
    one, two = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    docs = spark.createDataFrame([(1, one), (2, two), (3, " ".join(one)), (4, " ".join(two))], "doc_id bigint, text string")
    assert {r.n_removed for r in LD.line_report(docs).collect()} == {0}
    lists = [np.frombuffer(t.encode(), np.uint8) for t in (" ".join(one), " ".join(two))]
    keys = []
    for raw in lists:
        _, _, first, size, word, _ = PD.piece_paragraphs(raw, np.array([0, raw.size]))
        keys.append(B.span_hash(B.prefix_hash(word), first, first + size)[0])
    assert keys[0] != keys[1]
