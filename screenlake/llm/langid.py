"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts the n-grams (1 to 4 code points of the lower-cased text, every
run of other characters one blank) of all learning documents, hashed into a fixed
number of buckets: each task counts with numpy, Spark adds up. The smoothed
log-probability matrix has ``BUCKETS`` x languages entries; with at most
``max_langs`` languages its size has a bound, so it is broadcast. Prediction adds
up matrix rows per document, in pieces of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.llm.batches import map_batches, mix, pieces
from screenlake.session import materialize

BUCKETS = 1 << 15
SIZES = (1, 2, 3, 4)
ALPHA = 0.5
MAX_LANGS = 512
SCALE = 1 << 20         # log-probabilities are added up as integers: sums don't depend on the batch
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def letters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with blanks for runs of non-letters, and the borders of
    the documents in them; a document starts and ends with a blank."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    cp = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    is_letter = _letters()[cp]
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    keep = np.ones(cp.size, bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]
    keep[at] = True
    return np.where(is_letter, cp, 32)[keep], (np.cumsum(keep) - 1)[at]


def gram_buckets(sym: np.ndarray, borders: np.ndarray):
    """For each n-gram size: buckets of all grams, and where each document's start and end."""
    h = np.zeros(sym.size, np.uint64)
    for n in SIZES:
        size = sym.size - n + 1
        if size <= 0:
            return
        h = (h[:size] * np.uint64(0x100000001B3)) ^ sym[n - 1:].astype(np.uint64)
        first = borders[:-1]
        yield (mix(h + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64), first, np.maximum(borders[1:] + 2 - n, first)


def learning_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return src.filter("lang is not null and text is not null and coalesce(crc32(cast(id as string)) % 4, 0) <> 2")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_langs: int = MAX_LANGS) -> dict:
    """Counts of every learning row, none left out. More than ``max_langs`` languages
    raise: the matrix would outgrow its bound."""
    def run(batches):
        held: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            for rows, data, offs in pieces(batch):
                names = rows.column(rows.schema.get_field_index("lang")).dictionary_encode()
                code = names.indices.to_numpy(zero_copy_only=False)
                n_lang = len(names.dictionary)
                table = np.zeros((n_lang, BUCKETS), np.int64)
                sym, borders = letters(data, offs)
                for b, first, end in gram_buckets(sym, borders):
                    size = end - first
                    inside = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    table += np.bincount(np.repeat(code, size) * BUCKETS + b[inside], minlength=n_lang * BUCKETS).reshape(n_lang, BUCKETS)
                for i, lang in enumerate(names.dictionary.to_pylist()):
                    held[lang] = held.get(lang, 0) + table[i]
                    docs_of[lang] = docs_of.get(lang, 0) + int((code == i).sum())
        for lang, t in held.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (at.size + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(t[at], docs_of[lang]))], names=["lang", "bucket", "n"])
    rows = learning_rows(docs, id_col, text_col, lang_col).select("text", "lang")
    counts = materialize(map_batches(rows, run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "lang-counts")
    langs = [r["lang"] for r in counts.filter("bucket = -1").select("lang").limit(max_langs + 1).collect()]
    if len(langs) > max_langs:
        raise ValueError(f"more than max_langs={max_langs} languages")
    langs.sort()
    got = counts.toArrow()
    index = {x: i for i, x in enumerate(langs)}
    row = np.array([index[x] for x in got.column("lang").to_pylist()], np.int64)
    bucket, n = got.column("bucket").to_numpy().astype(np.int64), got.column("n").to_numpy().astype(float)
    table, prior = np.full((len(langs), BUCKETS), ALPHA), np.zeros(len(langs))
    grams = bucket >= 0
    table[row[grams], bucket[grams]] += n[grams]
    prior[row[~grams]] = n[~grams]
    logp = np.log(table) - np.log(table.sum(axis=1, keepdims=True))
    prior = np.log(prior) - np.log(prior.sum()) if langs else prior
    return {"langs": langs, "logp": np.round(logp * SCALE).astype(np.int32).T.copy(), "prior": np.round(prior * SCALE).astype(np.int64)}


def piece_languages(data: np.ndarray, offs: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Number of the likeliest language (-1: no letter) and its posterior probability."""
    sym, borders = letters(data, offs)
    total = np.tile(model["prior"], (offs.size - 1, 1))
    for b, first, end in gram_buckets(sym, borders):
        rows = np.flatnonzero(end > first)
        if rows.size == 0:
            continue
        for lang in range(total.shape[1]):
            run = np.concatenate([[0], np.cumsum(model["logp"][b, lang], dtype=np.int64)])
            total[rows, lang] += run[end[rows]] - run[first[rows]]
    has = np.concatenate([[0], np.cumsum(sym != 32)])
    known = has[borders[1:]] > has[borders[:-1]]
    if total.shape[1] == 0:
        return np.full(offs.size - 1, -1), np.zeros(offs.size - 1)
    best = total.argmax(axis=1)
    top = total.max(axis=1, keepdims=True)
    prob = 1 / np.exp((total - top) / SCALE).sum(axis=1)
    return np.where(known, best, -1), np.where(known, prob, 0.0)


def languages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        names = np.array([*shared.value["langs"], UNKNOWN], object)
        for batch in batches:
            for rows, data, offs in pieces(batch):
                best, prob = piece_languages(data, offs, shared.value)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names[best], pa.string()), pa.array(prob)], names=["doc_id", "lang_pred", "score"])
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(src, run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``; ``score`` is the posterior probability.

    A null text or one without a letter is ``und`` with score 0, and so is every text
    where nothing could be learned; a null doc_id is not held out; ties go to the
    language that sorts first; further columns are ignored."""
    model = train(docs, id_col, text_col, lang_col)
    out = languages(docs, model, id_col, text_col)
    return out.select("doc_id", F.expr("coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)").alias("held_out"), "lang_pred", "score")
