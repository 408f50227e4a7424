"""Phrase collocations: frequent word sequences, counted pair by pair in tiles.

Words become ids in order of their frequency. A phrase of k words is the pair of the two
phrases of k - 1 words it consists of (all but the last word, all but the first), so one
routine, applied again and again, counts all lengths: count adjacent pairs of ids, keep
the frequent ones, rank them by frequency into new ids, and relabel the sequences with
them. A phrase is frequent only if both its parts are, so nothing is lost by dropping the
rest; runs of dropped places shrink to one break.

Pairs are counted inside tasks by direct-address tiling: ids being ranks, the frequent
pairs crowd into the first tiles of ``TILE`` x ``TILE`` ids. A tile with many pairs is
counted by a dense ``bincount``; all others together as sorted coordinates with counts.
Tasks hand on partial counts, never occurrences; Spark adds them up by pair.

Sequences live in a written table of one row per portion of text. The table of frequent
pairs is handed to the tasks whole only up to ``bound`` bytes (checked); beyond that the
distinct pairs of each portion are joined with it.

Words are told apart by a 64-bit hash; the counting job shows whether two different words
share one, and then goes on with another seed.

Rules for awkward rows: a null lang is ``und`` (together with rows that say so), a null
or empty text has no words, repeated rows count each, ids play no part, phrases tied on
score and count rank by their bytes, extra columns are ignored, an empty table gives an
empty one. Very long texts stay in one portion, whose work is linear in its length.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.batches import map_batches, pieces
from screenlake.llm.names import column
from screenlake.session import materialize

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
TILE_BITS = 8
DENSE = 1 << 12         # pairs of a tile in one round that are worth a dense count
TILES = 64              # dense tiles a task holds (half a megabyte each)
SPARSE = 1 << 20        # sparse entries a task holds before it hands them on
CACHE = 1 << 16         # words of a language whose hash a task remembers
COUNTED = 1 << 17       # words a task counts before it hands the counts on
PORTION = 1 << 15       # bytes of text behind one row of the sequence tables (more only for one longer document)
BOUND = 64 << 20        # bytes of a table handed to every task
ID_BITS = 31            # an id of a phrase; two make a key

# A-Z to a-z, and all borders of pieces to one of them.
_FOLD = bytearray(range(256))
_FOLD[0x41:0x5B] = bytes(range(0x61, 0x7B))
for _b in b".,;:!?\x0a\x0b\x0c\x0d":
    _FOLD[_b] = 0x0A
_FOLD = bytes(_FOLD)


class _Hashes(dict):
    """Hash of a word of one language, never 0, remembered."""

    def __init__(self, lang: str, seed: int):
        super().__init__()
        self.lang, self.seed = lang.encode() + b"\0", seed

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(self.lang + word, self.seed)
        h = h - (1 << 64) if h >> 63 else h or 1
        if len(self) >= CACHE:
            self.clear()
        self[word] = h
        return h


def _texts(batches, seed: int):
    """Portions of text as lists of (hashes of the language, folded bytes)."""
    langs: dict[str, _Hashes] = {}
    for batch in batches:
        for rows, data, offs in pieces(batch, limit=PORTION):
            raw, cuts = data.tobytes().translate(_FOLD), offs.tolist()
            names = rows.column(rows.schema.get_field_index("lang")).to_pylist()
            yield [(langs.setdefault(n, _Hashes(n, seed)), raw[a:b]) for n, a, b in zip(names, cuts, cuts[1:])]


def _text_table(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(column(text_col).cast("string").alias("text"), F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"))


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """``(h, lang, word, c)`` for every word; two words that share a hash are two rows."""
    def task(batches):
        counts: dict[str, tuple[_Hashes, dict]] = {}

        def rows():
            out = ((hashes[w], lang, w, c) for lang, (hashes, n) in counts.items() for w, c in n.items())
            while some := list(islice(out, 1 << 14)):
                h, lang, w, c = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(lang, pa.string()), pa.array(w, pa.binary()).cast(pa.string()),
                                                  pa.array(c, pa.int64())], names=["h", "lang", "word", "c"])
        for portion in _texts(batches, seed):
            for hashes, text in portion:
                counts.setdefault(hashes.lang[:-1].decode(), (hashes, Counter()))[1].update(text.split())
            if sum(len(n) for _, n in counts.values()) > COUNTED:
                yield from rows()
                counts.clear()
        yield from rows()
    parts = map_batches(texts, task, "h bigint, lang string, word string, c bigint")
    return parts.repartition("h").groupBy("h", "lang", "word").agg(F.sum("c").alias("c"))


def word_sequences(texts: DataFrame, seed: int, shared=None) -> DataFrame:
    """``(seq)``: word hashes of a portion of text, 0 between pieces and documents; or, with
    a broadcast table, the ids of the words."""
    def task(batches):
        for portion in _texts(batches, seed):
            seq: list[int] = []
            for hashes, text in portion:
                for piece in text.split(b"\n"):
                    words = piece.split()
                    if words:
                        seq += map(hashes.__getitem__, words)
                        seq.append(0)
            out = np.array(seq, np.int64)
            yield _sequences([_relabelled(out, *shared.value) if shared else out])
    return map_batches(texts, task, "seq array<bigint>")


def _sequences(seqs: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([s.size for s in seqs])]).astype(np.int32)
    values = np.concatenate(seqs) if seqs else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))], names=["seq"])


def _rows_of(batch: pa.RecordBatch, name: str = "seq") -> list[np.ndarray]:
    lists = batch.column(batch.schema.get_field_index(name))
    offs = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offs, offs[1:])]


def _pair_keys(seq: np.ndarray) -> np.ndarray:
    """Key of each place and the next one; 0 where either is a break."""
    left, right = seq[:-1], seq[1:]
    return np.where((left > 0) & (right > 0), left << ID_BITS | right, 0)


def _relabelled(keys: np.ndarray, known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ids of the keys (``known`` sorted), 0 for others; a break of several places becomes one."""
    if known.size == 0:
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, keys), known.size - 1)
    out = np.where(known[at] == keys, ids[at], 0)
    keep = out > 0
    keep[1:] |= out[:-1] > 0
    return out[keep]


def share(table: DataFrame, bound: int = BOUND):
    """The written ``table (key, id)`` as sorted arrays in a broadcast; None beyond ``bound`` bytes."""
    if table.count() * 16 > bound:
        return None
    got = table.select("key", "id").toArrow()
    known, ids = (got.column(c).to_numpy() for c in ("key", "id"))
    order = np.argsort(known)
    return table.sparkSession.sparkContext.broadcast((known[order], ids[order]))


def relabel(seqs: DataFrame, table: DataFrame, pairs: bool, bound: int = BOUND) -> DataFrame:
    """``seqs`` with each word hash, or each adjacent pair of ids, replaced by its ``id`` in
    the written ``table (key, id)``, 0 if it has none."""
    def keys_of(seq):
        return _pair_keys(seq) if pairs else seq
    shared = share(table, bound)
    if shared:
        def task(batches):
            for batch in batches:
                yield _sequences([_relabelled(keys_of(s), *shared.value) for s in _rows_of(batch)])
        return map_batches(seqs, task, "seq array<bigint>")

    def distinct(batches):
        for batch in batches:
            sets = [np.unique(keys_of(s)) for s in _rows_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("part")), *_sequences(sets).columns], names=["part", "seq"])
    numbered = materialize(seqs.withColumn("part", F.expr("uuid()")), "phrase-parts")
    asked = map_batches(numbered, distinct, "part string, seq array<bigint>").select("part", F.explode("seq").alias("key")).filter("key <> 0")
    found = asked.join(table.select("key", "id"), "key").groupBy("part").agg(F.array_sort(F.collect_list(F.struct("key", "id"))).alias("found"))
    both = numbered.join(found, "part", "left").select("seq", F.coalesce(F.col("found.key"), F.expr("cast(array() as array<bigint>)")).alias("known"),
                                                       F.coalesce(F.col("found.id"), F.expr("cast(array() as array<bigint>)")).alias("ids"))

    def apply(batches):
        for batch in batches:
            yield _sequences([_relabelled(keys_of(s), k, i) for s, k, i in zip(*(_rows_of(batch, c) for c in ("seq", "known", "ids")))])
    return map_batches(both, apply, "seq array<bigint>")


def _sum_sorted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in order, each once, with the sum of its counts."""
    if keys.size == 0:
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class TiledCounts:
    """Counts of pairs of ids: dense tiles where pairs crowd, sorted coordinates elsewhere."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        left, right, low = keys >> ID_BITS, keys & ((1 << ID_BITS) - 1), (1 << TILE_BITS) - 1
        tile = (left >> TILE_BITS) << ID_BITS | right >> TILE_BITS
        order = np.argsort(tile, kind="stable")
        borders = np.flatnonzero(np.concatenate([[True], tile[order[1:]] != tile[order[:-1]], [True]])) if keys.size else np.zeros(1, np.int64)
        sparse = np.ones(keys.size, bool)
        for b in np.flatnonzero(np.diff(borders) >= DENSE).tolist():
            at = order[borders[b]:borders[b + 1]]
            t = int(tile[at[0]])
            if t not in self.dense:
                if len(self.dense) >= TILES:
                    continue
                self.dense[t] = np.zeros(1 << 2 * TILE_BITS, np.int64)
            self.dense[t] += np.bincount((left[at] & low) << TILE_BITS | right[at] & low, minlength=1 << 2 * TILE_BITS)
            sparse[at] = False
        rest = keys[sparse]
        self.keys, self.counts = _sum_sorted(np.concatenate([self.keys, rest]), np.concatenate([self.counts, np.ones(rest.size, np.int64)]))

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.keys, self.counts
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out

    def tiles(self):
        for t, counts in self.dense.items():
            at = np.flatnonzero(counts)
            left = (t >> ID_BITS << TILE_BITS) + (at >> TILE_BITS)
            right = ((t & ((1 << ID_BITS) - 1)) << TILE_BITS) + (at & ((1 << TILE_BITS) - 1))
            yield left << ID_BITS | right, counts[at]


def pair_counts(seqs: DataFrame) -> DataFrame:
    """``(key, c)`` of all adjacent pairs of ids."""
    def rows(keys, counts):
        for at in range(0, keys.size, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 16)], pa.int64()) for x in (keys, counts)], names=["key", "c"])

    def task(batches):
        counts, waiting = TiledCounts(), []
        for batch in batches:
            for s in _rows_of(batch):
                keys = _pair_keys(s)
                waiting.append(keys[keys > 0])
                if sum(x.size for x in waiting) >= SPARSE // 4:
                    counts.add(np.concatenate(waiting))
                    waiting = []
                    if counts.keys.size >= SPARSE:
                        yield from rows(*counts.sparse())
        if waiting:
            counts.add(np.concatenate(waiting))
        yield from rows(*counts.sparse())
        for keys, n in counts.tiles():
            yield from rows(keys, n)
    return map_batches(seqs, task, "key bigint, c bigint").groupBy("key").agg(F.sum("c").alias("c"))


def ranked(counts: DataFrame, name: str) -> DataFrame:
    """The written table ``counts`` with ``id``: 1 for the largest ``c``, ties by ``key``. One
    row per partition of the sorted table tells where its ids begin."""
    rows = materialize(counts.orderBy(F.desc("c"), "key").withColumn("__m", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("__part", F.shiftright("__m", 33))
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__start"))
    table = rows.join(F.broadcast(starts), "__part").withColumn("id", F.col("__start") + F.expr("__m & 8589934591L") + 1)
    table = materialize(table.drop("__m", "__part", "__start"), name)
    top = table.agg(F.max("id")).first()[0]
    if top is not None and top >> ID_BITS:
        raise OverflowError(f"{top} frequent phrases of one length do not fit {ID_BITS} bits")
    return table


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, bound: int = BOUND,
                     text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``max_words`` words that occur ``min_count`` times or more in the
    pieces of one language: ``(lang, phrase, size, c, pre, suf, longer)``, where ``pre[j]`` and
    ``suf[j]`` count the first j + 1 words and the rest, and ``longer`` is the count of the most
    frequent phrase one word longer around it (null: none). Second: ``(lang, n)``, all words."""
    texts, seed = _text_table(docs, text_col, lang_col), 0
    words = materialize(word_counts(texts, seed), "phrase-words")
    while not words.groupBy("h").count().filter("count > 1").isEmpty():
        seed += 1
        words = materialize(word_counts(texts, seed), "phrase-words")
    sizes = materialize(words.groupBy("lang").agg(F.sum("c").alias("n")), "phrase-sizes")
    first = ranked(words.filter(F.col("c") >= min_count).withColumnRenamed("h", "key"), "phrase-1")
    none = F.expr("cast(array() as array<bigint>)")
    level = first.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "c", none.alias("pre"), none.alias("suf"))
    shared = share(first, bound)
    seqs = word_sequences(texts, seed, shared)
    seqs = materialize(seqs if shared else relabel(seqs, first, False, bound), "phrase-seq-1")
    levels = []
    for k in range(2, max_words + 1):
        table = ranked(pair_counts(seqs).filter(F.col("c") >= min_count), f"phrase-{k}")
        table = table.withColumn("l", F.shiftright("key", ID_BITS)).withColumn("r", F.col("key").bitwiseAND((1 << ID_BITS) - 1))
        left = level.select(F.col("id").alias("l"), "lang", F.col("phrase").alias("lp"), F.col("c").alias("lc"), "pre")
        right = level.select(F.col("id").alias("r"), "last", F.col("c").alias("rc"), "suf")
        level = table.join(left, "l").join(right, "r").select(
            "id", "l", "r", "lang", F.concat_ws(" ", "lp", "last").alias("phrase"), "last", "c",
            F.concat("pre", F.array("lc")).alias("pre"), F.concat(F.array("rc"), "suf").alias("suf"))
        level = materialize(level, f"phrase-level-{k}")
        levels.append(level)
        if k < max_words:
            seqs = materialize(relabel(seqs, table, True, bound), f"phrase-seq-{k}")
    out = []
    for k, level in enumerate(levels):
        longer = F.lit(None).cast("bigint")
        if k + 1 < len(levels):
            up = levels[k + 1]
            around = up.select(F.col("l").alias("id"), "c").union(up.select(F.col("r").alias("id"), "c"))
            level = level.join(around.groupBy("id").agg(F.max("c").alias("longer")), "id", "left")
            longer = F.col("longer")
        out.append(level.select("lang", "phrase", F.lit(k + 2).alias("size"), "c", "pre", "suf", longer.alias("longer")))
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return found, sizes


def top_rows(rows: DataFrame, by: str, order: list, n: int, salt: str) -> DataFrame:
    """The first ``n`` rows per ``by`` with their ``rank``. While a group has more than 16 n
    rows, it is dealt into parts of about that many and each part keeps its first n."""
    while True:
        most = rows.groupBy(by).count().agg(F.max("count")).first()[0] or 0
        if most <= 16 * n:
            break
        parts = -(-most // (16 * n))
        part = Window.partitionBy(by, F.pmod(F.xxhash64(salt), F.lit(parts))).orderBy(*order)
        rows = materialize(rows.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= n).drop("rank"), "phrase-top")
    ranked_rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("bigint"))
    return ranked_rows.filter(F.col("rank") <= n)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, bound: int = BOUND,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language by score: ``lang, rank, phrase, a, l, r, n,
    score``. The score is the least, over all cuts in two, of 1000 a n / (l r), floored; a
    phrase that always stands inside one and the same longer phrase is left to that one
    (a phrase of its length plus one then has its count too, as counts only fall with length)."""
    found, sizes = frequent_phrases(docs, min_count, max_words, bound, text_col, lang_col)
    own = found.filter("longer is null or longer < c").join(sizes, "lang")
    exact = "cast({} as decimal(18, 0))".format
    score = f"transform(arrays_zip(pre, suf), z -> ({exact('1000 * c')} * {exact('n')}) div ({exact('z.pre')} * {exact('z.suf')}))"
    own = own.withColumn("scores", F.expr(score)).withColumn("score", F.array_min("scores"))
    own = own.withColumn("cut", F.expr("cast(array_position(scores, score) as int) - 1"))
    own = materialize(own.select("lang", "phrase", F.col("c").alias("a"), F.expr("pre[cut]").alias("l"), F.expr("suf[cut]").alias("r"), "n", "score"), "phrase-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return top_rows(own, "lang", order, top, "phrase").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
