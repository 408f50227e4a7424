"""Toxicity by class-conditional Kneser-Ney models over words and pairs of words.

Words are maximal runs of letters, lower-cased; n-grams are counted by the documents
they occur in. The ordinary model discounts absolutely: pairs back off to words, words
to a Kneser-Ney model over character 3-grams (code points) of both classes, so a word
that ordinary documents never used is as likely as its spelling. The toxic model backs
off to the ordinary one. Its discount is what the lower order explains of a count: the
expected count, ``DEVIATIONS`` times its square root and one document, of a count no
larger than the number of words the expression is used behind. Only expressions
used beyond that have a likelihood ratio of their own; the table holds these, so it
grows with the expressions and not with the corpus, and is joined where it is large.

The evidence of a document is the log-likelihood ratio of its whole text, a word. A
logistic curve, fitted on learning rows kept out of the counts, turns it into a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.llm.batches import map_batches, mix, pieces, prefix_hash, span_hash
from screenlake.llm.key_filter import key_filter, may_hold
from screenlake.llm.names import column, free
from screenlake.session import materialize

DISCOUNT = 0.8
DEVIATIONS = 3.0
SHORTEST = 20          # a shorter text is normalised as if it had so many words
SCALE = 1 << 20        # values are summed as integers: sums don't depend on the batch
BINS = 1 << 16         # of the calibration histogram, over evidence -4 .. 4
LABEL_BYTES = 64 << 20
TABLE_BYTES = 64 << 20   # a larger table is joined, not broadcast
_CONTEXT = np.uint64(0x8CB92BA72F3D8DD7)
CHARS, WORDS, PAIRS, BEFORE = 0, 1, 2, 3

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def piece_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a piece (0 for what is no letter), then start, end, document and
    hash of each word."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    cp = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    letter = _letters()[cp]
    starts, ends = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1, np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    at = np.cumsum([0] + [len(t) + 1 for t in texts])          # boundary before each document
    sym = np.where(letter, cp, 0)
    return sym, starts, ends, np.searchsorted(at, starts, "right") - 1, span_hash(prefix_hash(sym), starts, ends)


def word_pairs(doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word with a next one in its document: its place, its key as a context,
    and the key of the pair."""
    i = np.flatnonzero(doc[1:] == doc[:-1])
    return i, mix(word[i] ^ _CONTEXT), span_hash(prefix_hash(word), i, i + 2)


def char_codes(sym: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character 3-grams of words, one word after another, and their number in each:
    three code points of 21 bits, 0 before and behind the word."""
    n = ends - starts + 1
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    x = sym.astype(np.int64)
    two = np.where(at == np.repeat(starts, n), 0, x[np.maximum(at - 2, 0)])
    return (two << 42) | (x[at - 1] << 21) | x[at], n


def crc_of_id(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string"))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``(fold, text, label)`` of labelled documents; rows with crc32 mod 5 = 0 are
    held out here, before anything is learned. Several labels of a document: the largest."""
    lab = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    lab = materialize(lab.filter(F.crc32(F.col("__id").cast("string")) % 5 != 0), "tox-labels")
    if lab.count() * 16 <= LABEL_BYTES:         # id and label: 16 bytes a row at most
        lab = F.broadcast(lab)
    return (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(lab, "__id")
            .select((F.crc32(F.col("__id").cast("string")) % 5).alias("fold"), "text", F.col("label").cast("int").alias("label")))


def gram_counts(rows: DataFrame, behind=None) -> DataFrame:
    """``(kind, ctx, key, next, c0, c1)``: documents of each class with each word and pair
    of words (``next`` is the hash of a toxic pair's second word), character 3-grams of
    each document's distinct words, and toxic word 3-grams (``ctx`` is the last two's key).
    With a bit table ``behind``, pairs of ordinary rows only behind contexts in it."""
    def first_of(doc, key):
        order = np.lexsort((key, doc))
        new = np.ones(order.size, bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        return order[new]

    def run(batches):
        def out(kind, y, key, ctx=None, nxt=None, weight=None):
            u, at, inv = np.unique(key, return_index=True, return_inverse=True)
            n = pa.array(np.bincount(inv, weights=weight, minlength=u.size).astype(np.int64))
            zero = pa.array(np.zeros(u.size, np.int64))
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(u.size, kind, np.int32)), zero if ctx is None else pa.array(ctx[at].view(np.int64)), pa.array(u.view(np.int64)),
                pa.nulls(u.size, pa.int64()) if nxt is None else pa.array(nxt[at].view(np.int64)), zero if y else n, n if y else zero],
                names=["kind", "ctx", "key", "next", "n0", "n1"])
        for batch in batches:
            for part, data, offs in pieces(batch):
                sym, starts, ends, doc, word = piece_words(data, offs)
                label = part.column(part.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
                i, ctx, pair = word_pairs(doc, word)
                own, both = first_of(doc, word), first_of(doc[i], pair)
                for y in (0, 1):
                    w = own[label[doc[own]] == y]
                    if w.size == 0:
                        continue
                    yield out(WORDS, y, word[w])
                    _, at, times = np.unique(word[w], return_index=True, return_counts=True)
                    code, n = char_codes(sym, starts[w[at]], ends[w[at]])
                    yield out(CHARS, y, code, weight=np.repeat(times, n))
                    b = both[label[doc[i[both]]] == y]
                    if y == 0 and behind is not None:
                        b = b[may_hold(behind.value, ctx[b])]
                    yield out(PAIRS, y, pair[b], ctx[b], word[i[b] + 1] if y else None)
                    if y:
                        b = np.flatnonzero((i > 0) & (doc[i - 1] == doc[i]) & (label[doc[i]] == 1))
                        yield out(BEFORE, y, span_hash(prefix_hash(word), i[b] - 1, i[b] + 2), pair[b])
    got = map_batches(rows.select("text", "label"), run, "kind int, ctx bigint, key bigint, next bigint, n0 bigint, n1 bigint")
    return got.groupBy("kind", "ctx", "key").agg(F.max("next").alias("next"), F.sum("n0").alias("c0"), F.sum("n1").alias("c1"))


def learning_counts(rows: DataFrame) -> DataFrame:
    """``gram_counts`` of all learning rows, in two scans. A pair that only one toxic document
    has, or only behind one word, never enters the table, so ordinary pairs matter only behind
    contexts of other pairs; these are known after a scan of the toxic rows."""
    toxic = materialize(gram_counts(rows.filter("label = 1")).filter(F.col("kind").isin(PAIRS, BEFORE)), "tox-pairs")
    contexts = materialize(toxic_pairs(toxic).select("ctx").distinct(), "tox-contexts")
    return materialize(gram_counts(rows, key_filter(contexts, "ctx")), "tox-counts")


def toxic_pairs(counts: DataFrame) -> DataFrame:
    """Pairs of ``counts`` that may enter the table, ``c1`` no larger than the number of words
    the pair stands behind."""
    before = counts.filter(F.col("kind") == BEFORE).groupBy(F.col("ctx").alias("key")).agg(F.count(F.lit(1)).alias("k"))
    pairs = counts.filter(F.col("kind") == PAIRS)
    return pairs.join(before.filter("k > 1"), "key").withColumn("c1", F.least("c1", "k")).filter("c1 > 1")


def spelling(rows: DataFrame, chars: DataFrame, wanted: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """``(key, spelt)``: log-probability of each wanted word of the toxic rows under the
    Kneser-Ney model of the character 3-grams ``chars (key, n)``."""
    shared = key_filter(wanted, "key")

    def run(batches):
        for batch in batches:
            for part, data, offs in pieces(batch):
                sym, starts, ends, _, word = piece_words(data, offs)
                u, at = np.unique(word, return_index=True)
                hit = may_hold(shared.value, u)
                code, n = char_codes(sym, starts[at[hit]], ends[at[hit]])
                border = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(u[hit].view(np.int64)), pa.ListArray.from_arrays(pa.array(border), pa.array(code))], names=["key", "codes"])
    codes = map_batches(rows.filter("label = 1").select("text"), run, "key bigint, codes array<bigint>")
    codes = codes.groupBy("key").agg(F.first("codes").alias("codes")).join(wanted.select("key"), "key", "left_semi")
    low = (1 << 42) - 1
    g = chars.select("key", "n", F.shiftright("key", 21).alias("ctx"), F.col("key").bitwiseAND(F.lit(low)).alias("two"))
    two = g.groupBy("two").agg(F.count(F.lit(1)).alias("k2"))
    two = two.select("two", "k2", F.shiftright("two", 21).alias("mid"), F.col("two").bitwiseAND(F.lit((1 << 21) - 1)).alias("one"))
    one = two.groupBy("one").agg(F.count(F.lit(1)).alias("k1"))
    total = one.agg(F.sum("k1").alias("t1"), F.count(F.lit(1)).alias("v"))
    one = one.crossJoin(F.broadcast(total)).select("one", (F.col("k1") / F.col("t1")).alias("p1"))
    mid = two.groupBy("mid").agg(F.sum("k2").alias("t2"), F.count(F.lit(1)).alias("v2"))
    back = two.join(mid, "mid").join(one, "one").select(
        "two", ((F.col("k2") - discount) / F.col("t2") + discount * F.col("v2") / F.col("t2") * F.col("p1")).alias("p2"))
    ctx = g.groupBy("ctx").agg(F.sum("n").alias("t3"), F.count(F.lit(1)).alias("v3"))
    p = g.join(ctx, "ctx").join(back, "two").select(
        F.col("key").alias("code"), F.round(SCALE * F.log((F.col("n") - discount) / F.col("t3") + discount * F.col("v3") / F.col("t3") * F.col("p2"))).cast("bigint").alias("logp"))
    return codes.select("key", F.explode("codes").alias("code")).join(p, "code").groupBy("key").agg((F.sum("logp") / SCALE).alias("spelt"))


def excess(count, expected):
    """What of a count the lower order doesn't explain; 0 where it explains it all."""
    return F.greatest(count - (1 + expected + DEVIATIONS * F.sqrt(expected)), F.lit(0.0))


def ratio_table(rows: DataFrame, counts: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, float]:
    """``(slot, value)`` of the toxic expressions, and the value of every word. A text's
    log-likelihood ratio is the sum of its words', pairs' and contexts' values."""
    whole = F.sum(F.col("c0")).alias("t0"), F.sum("c1").alias("t1"), F.count(F.when(F.col("c0") > 0, 1)).alias("n0")
    words, pairs = counts.filter(F.col("kind") == WORDS).select("key", "c0", "c1"), counts.filter(F.col("kind") == PAIRS)
    t = words.agg(*whole).head()
    t0, t1, n0 = t["t0"] or 0, t["t1"] or 0, t["n0"]
    # continuation counts: copies of a document use an expression behind the same word
    words = words.join(pairs.filter("next is not null").groupBy(F.col("next").alias("key")).agg(F.count(F.lit(1)).alias("k")), "key").withColumn("c1", F.least("c1", "k"))
    # one document is never more than the discount, so nothing else can be in the table
    words = materialize(words.filter("c1 > 1"), "tox-words")
    chars = counts.filter(F.col("kind") == CHARS).select("key", (F.col("c0") + F.col("c1")).alias("n"))
    own = F.greatest(F.col("c0") - discount, F.lit(0.0)) / max(t0, 1)
    words = words.join(spelling(rows, chars, words), "key").withColumn("p0", own + (discount * n0 / t0 if t0 else 1.0) * F.exp("spelt"))
    words = materialize(words.withColumn("x", excess(F.col("c1"), t1 * F.col("p0"))), "tox-words")
    used = words.agg(F.sum(F.round(F.col("x") * SCALE).cast("bigint"))).head()[0] or 0
    rest = 1 - used / SCALE / max(t1, 1)
    words = words.withColumn("r", F.lit(rest) + F.col("x") / (F.lit(max(t1, 1)) * F.col("p0")))
    some = materialize(toxic_pairs(counts), "tox-pairs")
    ctx = pairs.join(some.select("ctx").distinct(), "ctx", "left_semi").groupBy("ctx").agg(*whole)
    two = some.join(ctx, "ctx").join(words.select(F.col("key").alias("next"), "p0", "r"), "next")
    two = two.withColumn("p", F.when(F.col("t0") > 0, (F.greatest(F.col("c0") - discount, F.lit(0.0)) + discount * F.col("n0") * F.col("p0")) / F.col("t0")).otherwise(F.col("p0")))
    two = two.withColumn("x", excess(F.col("c1"), F.col("t1") * F.col("p") * F.col("r"))).filter("x > 0")
    two = materialize(two.select("ctx", "key", "t1", "p", "r", "x"), "tox-pairs")
    left = two.groupBy("ctx").agg((1 - F.sum(F.round(F.col("x") * SCALE).cast("bigint")) / SCALE / F.first("t1")).alias("left"))
    two = two.join(left, "ctx").withColumn("ratio", F.col("x") / (F.col("t1") * F.col("p")) + F.col("left") * F.col("r"))
    table = (words.filter("x > 0").select(F.col("key").alias("slot"), F.log(F.col("r") / rest).alias("value"))
             .union(two.select("key", F.log(F.col("ratio") / F.col("r") / F.col("left"))))
             .union(left.select("ctx", F.log("left"))))
    return materialize(table.select("slot", F.round(F.col("value") * SCALE).cast("bigint").alias("value")), "tox-table"), float(np.log(rest))


def piece_slots(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all words, pairs and contexts of a piece and their documents; words of each document."""
    _, _, _, doc, word = piece_words(data, offs)
    i, ctx, pair = word_pairs(doc, word)
    return np.concatenate([word, pair, ctx]), np.concatenate([doc, doc[i], doc[i]]), np.bincount(doc, minlength=offs.size - 1)


def per_word(total: np.ndarray, n: np.ndarray, base: int) -> np.ndarray:
    """Evidence from the sum of table values and the number of words."""
    return (total + n * base) / (SCALE * np.maximum(n, SHORTEST))


def evidence(data: np.ndarray, offs: np.ndarray, model: dict) -> np.ndarray:
    """Length-normalised log-likelihood ratio of each document's whole text."""
    slot, doc, n = piece_slots(data, offs)
    total = np.zeros(n.size, np.int64)
    if model["slot"].size and slot.size:
        at = np.minimum(np.searchsorted(model["slot"], slot), model["slot"].size - 1)
        hit = model["slot"][at] == slot
        np.add.at(total, doc[hit], model["value"][at[hit]])
    return per_word(total, n, model["base"])


def with_evidence(src: DataFrame, model: dict, text_col: str, out: str = "evidence") -> DataFrame:
    """``src`` without its text column, with ``out``, the evidence: the table is looked up in
    each task, or joined where it is too large for that. ``out`` is a name ``src`` has not."""
    shared, base = model["shared"], model["base"]
    fields = [f for f in src.schema.fields if f.name != text_col]
    schema = T.StructType([*fields, T.StructField(out, T.DoubleType())])
    (row_id,) = free(src, "__row")
    if shared is not None:
        def run(batches):
            for batch in batches:
                for part, data, offs in pieces(batch, text_col):
                    yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(f.name)) for f in fields], pa.array(evidence(data, offs, shared.value))], names=schema.names)
        return map_batches(src, run, schema)
    src = materialize(src.withColumn(row_id, F.monotonically_increasing_id()), "tox-rows")

    def slots(batches):
        for batch in batches:
            for part, data, offs in pieces(batch, text_col):
                slot, doc, n = piece_slots(data, offs)
                row = part.column(part.schema.get_field_index(row_id)).to_numpy(zero_copy_only=False)
                order = np.lexsort((slot, doc))
                slot, doc = slot[order], doc[order]
                new = np.ones(slot.size, bool)
                new[1:] = (slot[1:] != slot[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([pa.array(row[doc[at]]), pa.array(slot[at].view(np.int64)), pa.array(np.diff(np.append(at, slot.size)).astype(np.int64)),
                                                  pa.array(n[doc[at]].astype(np.int64))], names=["__row", "slot", "times", "n"])
    got = map_batches(src.select(row_id, column(text_col)), slots, "__row bigint, slot bigint, times bigint, n bigint")
    got = got.join(model["table"], "slot", "left").groupBy("__row").agg(F.sum(F.coalesce(F.col("value") * F.col("times"), F.lit(0))).alias("total"), F.max("n").alias("n"))
    got = got.select(F.col("__row").alias(row_id), ((F.col("total") + F.col("n") * base) / (F.lit(float(SCALE)) * F.greatest(F.col("n"), F.lit(SHORTEST)))).alias(out))
    return src.drop(text_col).join(got, row_id, "left").drop(row_id).withColumn(out, F.coalesce(out, F.lit(0.0)))


def fit_curve(ev: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on a histogram; with
    one class only, a fixed curve that calls nothing toxic without evidence."""
    if n.size == 0 or n[y == 1].sum() == 0 or n[y == 0].sum() == 0:
        return 8.0, -4.0
    x = np.stack([ev, np.ones_like(ev)], axis=1)
    w = np.zeros(2)

    def loss(v):
        return n @ np.logaddexp(0, (1 - 2 * y) * (x @ v)) + 5e-4 * (v @ v)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (n * (p - y)) + np.array([1e-3, 1e-3]) * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-3])
        step = np.linalg.solve(hess, grad)
        while loss(w - step) > loss(w) and np.abs(step).max() >= 1e-9:    # a full step may overshoot
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Model from labelled rows outside the held-out fold: counts from three fifths
    of all rows, the curve from another fifth. The driver holds the table while it is
    within ``TABLE_BYTES``, and the calibration histogram."""
    rows = labelled_texts(docs, labels, id_col, text_col, label_col)
    learn = rows.filter("fold <> 4")
    table, base = ratio_table(learn, learning_counts(learn))
    model = {"table": table, "base": round(base * SCALE), "shared": None}
    if table.count() * 16 <= TABLE_BYTES:
        got = table.toArrow()
        slot, value = got.column("slot").to_numpy().view(np.uint64), got.column("value").to_numpy()
        order = np.argsort(slot)
        model["shared"] = docs.sparkSession.sparkContext.broadcast({"slot": slot[order], "value": value[order], "base": model["base"]})
    hist = with_evidence(rows.filter("fold = 4").select("label", "text"), model, "text")
    place = F.floor((F.col("evidence") + 4) / 8 * BINS).cast("int")
    hist = hist.groupBy("label", F.greatest(F.least(place, F.lit(BINS - 1)), F.lit(0)).alias("bin")).count().collect()
    y = np.array([r["label"] for r in hist], float)
    ev = np.array([(r["bin"] + 0.5) / BINS * 8 - 4 for r in hist])
    model["curve"] = fit_curve(ev, y, np.array([r["count"] for r in hist], float))
    return model


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``out`` (0 to 1), a name it must not have yet. A null or empty
    text has no evidence and gets the curve's value at 0; rows are scored one by one, so
    equal texts score alike; other columns keep their names and values."""
    if out in docs.columns:
        raise ValueError(f"there is a column {out} already")
    a, b = model["curve"]
    text, found = free(docs, "text_", "evidence_")
    x = F.greatest(F.least(a * F.col(found) + b, F.lit(35.0)), F.lit(-35.0))
    scored = with_evidence(docs.withColumn(text, column(text_col)), model, text, found)
    return scored.withColumn(out, 1 / (1 + F.exp(-x))).drop(found)


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``cut``, with their columns as they are."""
    (out,) = free(docs, "toxicity")
    return score(docs, model, text_col, out).filter(F.col(out) < cut).select(*[column(c) for c in docs.columns])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Null and empty texts are scored like any text without evidence; a null doc_id is
    not held out; documents without a label are scored all the same; without labels
    of both classes a fixed curve is used; further columns are ignored."""
    model = train(docs, labels, id_col, text_col, label_col)
    out = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return out.select("doc_id", F.coalesce(crc_of_id() % 5 == 0, F.lit(False)).alias("held_out"),
                      F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
