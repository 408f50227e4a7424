"""Exact substring dedup with suffix arrays: bytes covered by a repeated string.

Every string of ``LENGTH`` bytes that starts at two places of the corpus is removed
at all of them. Strings that occur once must not cost a suffix array over the corpus,
so each window of ``LENGTH`` bytes picks an anchor, the leftmost smallest hash among
its ``GRAM``-byte strings: equal windows pick equal anchors. Neighbouring windows
share an anchor; such a run of windows with its bytes is a context.

1. A scan counts anchors. A bit table of those that occur twice goes into a second
   scan, which emits the contexts of these anchors.
2. Equal contexts become one with a weight. Contexts of one anchor are one shard item:
   a task takes whole anchors up to about ``SHARD_BYTES``, builds their suffix array by
   induced sorting, and the permuted common prefixes tell which windows are repeated:
   a neighbour shares ``LENGTH`` bytes, or the context itself has a weight above one.
3. An anchor with more than ``HOT`` different contexts would not fit a task. Its contexts
   are cut into blocks of ``BLOCK`` windows; the bytes that all windows of a block have in
   common join the key, and the parts go through step 2 again. Where even those are too
   many, their windows are counted one by one by a 128-bit hash, in any number of tasks.
4. The repeated windows of a context are one interval (any two of them overlap); the
   intervals of a document are joined and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.llm.batches import PIECE_BYTES, map_batches, mix, pieces, prefix_hash, span_hash
from screenlake.llm.induced_sort import common_prefixes, suffix_array
from screenlake.llm.key_filter import key_filter, may_hold
from screenlake.session import materialize

LENGTH = 200
GRAM = 32
SHARD_BYTES = 1 << 20
HOT = 2000
BLOCK = 16
BROADCAST_BYTES = 64 << 20


def parts(batch: pa.RecordBatch, length: int):
    """Pieces of a batch; a document beyond two pieces comes in overlapping parts, so
    that every window lies in one: ``(rows, bytes, offs, place of the first byte)``."""
    for rows, data, offs in pieces(batch):
        if rows.num_rows > 1 or data.size <= 2 * PIECE_BYTES:
            yield rows, data, offs, 0
            continue
        for lo in range(0, data.size - length + 1, PIECE_BYTES):
            cut = data[lo:lo + PIECE_BYTES + length - 1]
            yield rows, cut, np.array([0, cut.size]), lo


def anchors(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: anchor key, document, first and last window
    start, place of the anchor after the first; and the prefix sums of the bytes."""
    none = np.zeros(0, np.int64)
    pre = prefix_hash(data)
    if data.size < length:
        return np.zeros(0, np.uint64), none, none, none, none, pre
    i = np.arange(data.size - gram + 1)
    h = span_hash(pre, i, i + gram)
    low = (h & ~np.uint64(0xFFFFFFFF)) | i.astype(np.uint64)      # leftmost of equal ones
    have, need = 1, length - gram + 1
    while have < need:                                            # sliding minimum by doubling
        step = min(have, need - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.searchsorted(offs, np.arange(at.size), "right") - 1
    inside = np.arange(at.size) + length <= offs[doc + 1]
    p = np.flatnonzero(inside)
    if p.size == 0:
        return np.zeros(0, np.uint64), none, none, none, none, pre
    new = np.r_[True, (at[p][1:] != at[p][:-1]) | (p[1:] != p[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], p.size) - 1
    a = at[p[first]]
    return h[a], doc[p[first]], p[first], p[last], a - p[first], pre


def _anchor_counts(src: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, data, offs, _ in parts(batch, length):
                key, n = np.unique(anchors(data, offs, length, gram)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])
    return map_batches(src.select("doc_id", "text"), run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def _contexts(src: DataFrame, kind: T.DataType, shared, length: int, gram: int) -> DataFrame:
    """``(key, h1, h2, rel, doc_id, th, start, bytes)``: occurrences of contexts, ``rel``
    the anchor's place; the bytes come with the first of equal ones in a piece."""
    def run(batches):
        for batch in batches:
            for rows, data, offs, base in parts(batch, length):
                key, doc, first, last, rel, pre = anchors(data, offs, length, gram)
                hit = np.flatnonzero(may_hold(shared.value, key))
                key, doc, first, stop = key[hit], doc[hit], first[hit], last[hit] + length
                h1 = span_hash(pre, first, stop)
                h2 = span_hash(prefix_hash(data, 1), first, stop, 1)
                fresh = np.zeros(hit.size, bool)
                fresh[np.unique(np.stack([key, h1, h2], axis=1), axis=0, return_index=True)[1]] = True
                raw = data.tobytes()
                text = [raw[a:b] if f else None for a, b, f in zip(first.tolist(), stop.tolist(), fresh.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(rel[hit].astype(np.int32)),
                    rows.column(0).take(pa.array(doc)), rows.column(1).take(pa.array(doc)),
                    pa.array(first - offs[doc] + base), pa.array(text, pa.binary())], names=["key", "h1", "h2", "rel", "doc_id", "th", "start", "bytes"])
    long = T.LongType()
    schema = T.StructType([T.StructField("key", long), T.StructField("h1", long), T.StructField("h2", long), T.StructField("rel", T.IntegerType()), T.StructField("doc_id", kind),
                           T.StructField("th", long), T.StructField("start", long), T.StructField("bytes", T.BinaryType())])
    return map_batches(src.select("doc_id", "th", "text"), run, schema)


def shard_intervals(contexts: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last repeated window of each context (-1: none) by the suffix array
    of all of them."""
    size = np.array([len(c) for c in contexts], np.int64)
    t = np.frombuffer(b"".join(c + b"\0" for c in contexts), np.uint8).astype(np.int16) + 1
    ends = np.cumsum(size + 1) - 1
    t[ends] = 0
    sa = suffix_array(t)
    shared = common_prefixes(t, sa) >= length
    hit = shared.copy()
    hit[sa[:-1]] |= shared[sa[1:]]                # the suffix before a shared one
    hit |= np.repeat(weights > 1, size + 1)
    start = ends - size
    place = np.arange(t.size) - np.repeat(start, size + 1)
    hit &= place <= np.repeat(size - length, size + 1)
    first, last = np.full(size.size, -1, np.int64), np.full(size.size, -1, np.int64)
    at = np.flatnonzero(hit)
    of = np.searchsorted(ends, at, "left")
    if at.size:
        cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        first[of[cut]] = place[at[cut]]
        last[of[cut]] = place[at[np.append(cut[1:], at.size) - 1]]
    return first, last


def _by_suffix_array(rows: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Shards of whole anchors, streamed: at most ``shard_bytes`` and one anchor more."""
    def run(batches):
        held, size, key = [], 0, None

        def done():
            first, last = shard_intervals([r[4] for r in held], np.array([r[3] for r in held]), length)
            ok = np.flatnonzero(first >= 0)
            k = [np.array([r[c] for r in held], np.int64)[ok] for c in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (*k, first[ok], last[ok])], names=["key", "h1", "h2", "first", "last"])
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if r[0] != key and size >= shard_bytes:
                    yield done()
                    held, size = [], 0
                key = r[0]
                held.append(r)
                size += len(r[4])
        if held:
            yield done()
    by_key = rows.repartition("key").sortWithinPartitions("key", "h1").select("key", "h1", "h2", "n", "bytes")
    return map_batches(by_key, run, "key bigint, h1 bigint, h2 bigint, first bigint, last bigint")


def _blocks(rows: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """Contexts cut into blocks of windows: ``(key, h1, h2, n, bytes, k, s1, s2, off)``
    with the part's bytes, its own key ``k``, hashes and place in the context."""
    def run(batches):
        for batch in batches:
            for part, data, offs in pieces(batch, "bytes", 1 << 18):
                rel = part.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
                n = np.diff(offs) - length + 1
                high = rel // block                                   # of the first window
                low = np.maximum(rel - (n - 1), 0) // block           # of the last one
                count = high - low + 1
                which = np.repeat(np.arange(n.size), count)
                j = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + low[which]
                a = np.maximum(rel[which] - block * j - block + 1, 0)
                b = np.minimum(rel[which] - block * j, n[which] - 1) + length
                base = offs[:-1][which]
                pre = prefix_hash(data)
                common = base + rel[which] - block * j
                key = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)[which]
                k = mix(span_hash(pre, common, common + length - block + 1) ^ (key + j.astype(np.uint64)))
                s1 = span_hash(pre, base + a, base + b)
                s2 = span_hash(prefix_hash(data, 1), base + a, base + b, 1)
                raw, at = data.tobytes(), pa.array(which)
                text = [raw[x:y] for x, y in zip((base + a).tolist(), (base + b).tolist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in range(4)), pa.array(text, pa.binary()),
                                                  *(pa.array(x.view(np.int64)) for x in (k, s1, s2)), pa.array(a)],
                                                 names=["key", "h1", "h2", "n", "bytes", "k", "s1", "s2", "off"])
    src = rows.select("key", "h1", "h2", "n", "rel", "bytes")
    return map_batches(src, run, "key bigint, h1 bigint, h2 bigint, n bigint, bytes binary, k bigint, s1 bigint, s2 bigint, off bigint")


def _hot_intervals(rows: DataFrame, length: int, hot: int, shard_bytes: int) -> DataFrame:
    """Intervals of contexts whose anchors have too many of them for a task."""
    sub = materialize(_blocks(rows, length), "suffix-blocks")
    ctx = sub.groupBy(F.col("k").alias("key"), F.col("s1").alias("h1"), F.col("s2").alias("h2")).agg(F.sum("n").alias("n"), F.min("bytes").alias("bytes"))
    per_key = ctx.groupBy("key").agg(F.sum("n").alias("of"), F.count(F.lit(1)).alias("kinds")).filter("of > 1")
    hits = _by_suffix_array(ctx.join(per_key.filter(F.col("kinds") <= hot).select("key"), "key"), length, shard_bytes)
    many = materialize(per_key.filter(F.col("kinds") > hot).select("key"), "suffix-hot")
    if not many.isEmpty():
        hits = hits.union(_by_window(ctx.join(many, "key"), length))
    hits = hits.select(F.col("key").alias("k"), F.col("h1").alias("s1"), F.col("h2").alias("s2"), "first", "last")
    back = sub.select("key", "h1", "h2", "k", "s1", "s2", "off").join(hits, ["k", "s1", "s2"])
    return back.groupBy("key", "h1", "h2").agg(F.min(F.col("off") + F.col("first")).alias("first"), F.max(F.col("off") + F.col("last")).alias("last"))


def _by_window(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many contexts: windows counted by hash."""
    def run(batches):
        for batch in batches:
            for part, data, offs in pieces(batch, "bytes", 1 << 18):
                n = np.diff(offs) - length + 1
                which = np.repeat(np.arange(n.size), n)
                place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                a = offs[:-1][which] + place
                w1 = span_hash(prefix_hash(data), a, a + length)
                w2 = span_hash(prefix_hash(data, 1), a, a + length, 1)
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in range(4)), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(place)],
                                                 names=["key", "h1", "h2", "n", "w1", "w2", "place"])
    src = rows.select("key", "h1", "h2", "n", "bytes")
    wins = map_batches(src, run, "key bigint, h1 bigint, h2 bigint, n bigint, w1 bigint, w2 bigint, place bigint")
    seen = wins.groupBy("w1", "w2").agg(F.sum("n").alias("times")).filter("times > 1").select("w1", "w2")
    return wins.join(seen, ["w1", "w2"]).groupBy("key", "h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, th, spans)``: maximal byte ranges to remove, ascending, of every
    document that has any; ``th`` is the text's 64-bit hash."""
    if length < gram + 1:
        raise ValueError("length must exceed gram")
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).filter(F.octet_length("text") >= length)
    kind = src.schema["doc_id"].dataType
    counts = _anchor_counts(src, length, gram).filter("n > 1")
    shared = key_filter(counts, "key", 27)
    found = materialize(_contexts(src, kind, shared, length, gram), "suffix-contexts")
    ctx = found.groupBy("key", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("rel").alias("rel"), F.min("bytes").alias("bytes"))
    ctx = materialize(ctx, "suffix-distinct")
    per_key = ctx.groupBy("key").agg(F.sum("n").alias("of"), F.count(F.lit(1)).alias("kinds")).filter("of > 1")
    some = per_key.filter(F.col("kinds") <= hot).select("key")
    many = materialize(per_key.filter(F.col("kinds") > hot).select("key"), "suffix-hot")
    hits = _by_suffix_array(ctx.join(some, "key"), length, shard_bytes)
    if not many.isEmpty():
        hits = hits.union(_hot_intervals(ctx.join(many, "key"), length, hot, shard_bytes))
    at = found.select("key", "h1", "h2", "doc_id", "th", "start").join(hits, ["key", "h1", "h2"])
    at = at.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct((F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last") + length).alias("b")))).alias("s"))
    merge = ("aggregate(s, cast(array() as array<struct<a:bigint,b:bigint>>), (acc, x) -> if(size(acc) > 0 and element_at(acc, -1).b >= x.a, "
             "concat(slice(acc, 1, size(acc) - 1), array(named_struct('a', element_at(acc, -1).a, 'b', greatest(element_at(acc, -1).b, x.b)))), "
             "concat(acc, array(x))))")
    return at.select("doc_id", "th", F.expr(merge).alias("spans"))


def cut_documents(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and
    ``kept``, the remaining bytes (null where nothing is removed: the text itself)."""
    n = spans.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("spans")).alias("s")).head()
    side = spans.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "spans")
    if 48 * n["n"] + 16 * (n["s"] or 0) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.join(side, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th")), "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in batches:
            n_bytes, removed, count, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw, s = batch.column(1)[i].as_buffer(), batch.column(2)[i].as_py()
                n_bytes.append(raw.size if raw is not None else 0)
                if not s:
                    removed.append(0)
                    count.append(0)
                    kept.append(None)
                    continue
                view = memoryview(raw)
                marks = [0, *(x for p in s for x in (p["a"], p["b"])), raw.size]
                kept.append(b"".join(view[a:b] for a, b in zip(marks[::2], marks[1::2])))
                removed.append(raw.size - len(kept[-1]))
                count.append(len(s))
            sha = [hashlib.sha256(k if k is not None else memoryview(b) if (b := batch.column(1)[i].as_buffer()) is not None else b"").hexdigest() for i, k in enumerate(kept)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, count)), pa.array(sha), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    long = T.LongType()
    return map_batches(src, run, T.StructType([src.schema["doc_id"], T.StructField("n_bytes", long), T.StructField("n_removed", long), T.StructField("n_spans", long),
                                               T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Repeated strings of ``length`` bytes cut out of every document.

    Null texts count as empty; texts shorter than the length keep all bytes; equal
    texts and repeated rows of at least that length vanish whole; a null doc_id is
    an id like others; an empty table gives an empty one; further columns are ignored."""
    spans = materialize(repeated_spans(docs, id_col, text_col, **options), "suffix-spans")
    return cut_documents(docs, spans, id_col, text_col)
