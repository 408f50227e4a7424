"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Words are runs of ASCII digits, letters (A-Z lower-cased) and code points from
U+0080 on. A window is ``n`` consecutive words of a benchmark item; a shorter
item is one window. The hashes of all windows are broadcast; each task scans the
word windows of its documents with numpy, and every hash hit is compared word
for word before it counts.

The benchmark is cut in tasks: each item becomes segments of at most
``SEGMENT_WINDOWS`` windows with their hashes, written as a table. The broadcast is
bounded: segments are packed into blocks of at most ``block_bytes`` bytes, held as flat
arrays, one block and one scan of the documents at a time. A test suite is one block; a
larger query set costs more scans, never more memory.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.llm.batches import ALNUM, lower_ascii, map_batches, pieces, prefix_hash, span_hash, words
from screenlake.llm.names import column, free
from screenlake.session import materialize

WINDOW = 10
SEGMENT_WINDOWS = 1 << 15
BLOCK_BYTES = 48 << 20      # words, hashes and places of a block's windows
WINDOW_BYTES = 16           # hash, start and end of a window
BUCKETS = 16                # parts that a block is packed from
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def item_segments(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW,
                  segment_windows: int = SEGMENT_WINDOWS) -> DataFrame:
    """``(item, size, words, hashes, starts, ends)``: the windows of each item in segments.
    ``words`` are the segment's lower-cased words joined by blanks; per window there is its
    hash (uint64) and its place in them (int32). Items without words, a null id or text
    have none. Ids other than bigint become strings."""
    kind = "bigint" if benchmark.schema[id_col].dataType.simpleString() == "bigint" else "string"
    src = benchmark.select(column(id_col).cast(kind).alias("item"), column(text_col).alias("text"))
    src = src.filter("item is not null and text is not null")

    def run(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch):
                low = lower_ascii(data)
                first, last, of = words(low, offs, ALNUM)
                pre = prefix_hash(span_hash(prefix_hash(low), first, last))
                border = np.searchsorted(of, np.arange(rows.num_rows + 1))
                ids = rows.column(0)
                for i, (a, b) in enumerate(zip(border[:-1].tolist(), border[1:].tolist())):
                    size = min(n, b - a)
                    for lo in range(a, b - size + 1 if size else a, segment_windows):
                        at = np.arange(lo, min(lo + segment_windows, b - size + 1))
                        end = int(at[-1]) + size
                        text = b" ".join(low[x:y].tobytes() for x, y in zip(first[lo:end].tolist(), last[lo:end].tolist()))
                        stop = np.cumsum(last[lo:end] - first[lo:end] + 1) - 1
                        start = np.append(0, stop[:-1] + 1)
                        yield pa.RecordBatch.from_arrays(
                            [ids.slice(i, 1), pa.array([size], pa.int32()), pa.array([text], pa.binary()),
                             pa.array([span_hash(pre, at, at + size).tobytes()], pa.binary()),
                             pa.array([start[at - lo].astype(np.int32).tobytes()], pa.binary()),
                             pa.array([stop[at - lo + size - 1].astype(np.int32).tobytes()], pa.binary())],
                            names=["item", "size", "words", "hashes", "starts", "ends"])
    return map_batches(src, run, f"item {kind}, size int, words binary, hashes binary, starts binary, ends binary")


def window_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """Segments of the benchmark, packed into blocks of at most ``block_bytes`` bytes. The
    driver sees sizes only: ``BUCKETS`` numbers a block."""
    segments = materialize(item_segments(benchmark, id_col, text_col, n, min(SEGMENT_WINDOWS, max(1, block_bytes // (BUCKETS * WINDOW_BYTES)))), "benchmark-windows")
    weight = F.octet_length("words") + F.octet_length("hashes") * (WINDOW_BYTES // 8)
    total = segments.agg(F.sum(weight)).first()[0] or 0
    parts = BUCKETS * -(-total // block_bytes)
    if parts <= BUCKETS:
        return [segments] if total else []
    bucket = F.pmod(F.xxhash64("item", "hashes"), F.lit(parts))
    blocks, size, lo = [], 0, 0
    for b, w in sorted((r[0], r[1]) for r in segments.groupBy(bucket).agg(F.sum(weight)).collect()):
        if size and size + w > block_bytes:
            blocks.append((lo, b))
            size, lo = 0, b
        size += w
    return [segments.filter((bucket >= a) & (bucket < b)) for a, b in [*blocks, (lo, parts)]]


def window_table(block: DataFrame) -> dict:
    """A block in the driver, as flat arrays. ``items`` are its ids, ``words`` all its
    words. Per window length: the sorted distinct ``hashes``; windows of hash k are rows
    ``at[k]`` to ``at[k + 1]`` of ``item`` (number in ``items``), ``start`` and ``end`` (place
    in ``words``); ``same[k]`` tells that they are equal word for word."""
    got = block.toArrow()
    text = got.column("words").to_pylist()
    base = np.cumsum([0, *map(len, text)])
    raw, sizes, by_size = b"".join(text), got.column("size").to_numpy(), {}
    read = {c: [np.frombuffer(x, d) for x in got.column(c).to_pylist()] for c, d in (("hashes", np.uint64), ("starts", np.int32), ("ends", np.int32))}
    for size in np.unique(sizes).tolist():
        of = np.flatnonzero(sizes == size).tolist()
        h = np.concatenate([read["hashes"][i] for i in of])
        order = np.argsort(h, kind="stable")
        start, end = (np.concatenate([read[c][i] + base[i] for i in of])[order] for c in ("starts", "ends"))
        item = np.repeat(np.array(of, np.int32), [read["hashes"][i].size for i in of])[order]
        hashes, at = np.unique(h[order], return_index=True)
        at = np.append(at, h.size)
        same = np.ones(hashes.size, bool)
        for k in np.flatnonzero(np.diff(at) > 1).tolist():
            one = raw[start[at[k]]:end[at[k]]]
            same[k] = all(raw[start[j]:end[j]] == one for j in range(at[k] + 1, at[k + 1]))
        by_size[size] = {"hashes": hashes, "at": at, "item": item, "start": start, "end": end, "same": same}
    return {"items": got.column("item").to_pylist(), "words": raw, "sizes": by_size}


def items_with(table: dict, size: int, k: int, text: bytes) -> np.ndarray:
    """Numbers of the items that have the window ``text`` under the k-th hash."""
    t, raw = table["sizes"][size], table["words"]
    a, b = int(t["at"][k]), int(t["at"][k + 1])
    if t["same"][k]:
        return t["item"][a:b] if raw[t["start"][a]:t["end"][a]] == text else t["item"][:0]
    return t["item"][[j for j in range(a, b) if raw[t["start"][j]:t["end"][j]] == text]]


def scan_piece(data: np.ndarray, offs: np.ndarray, table: dict):
    """Per document: number of words, hit word ranges (word numbers inside the
    document, end exclusive) and ids of items found."""
    low = lower_ascii(data)
    starts, ends, doc = words(low, offs, ALNUM)
    n_docs = offs.size - 1
    n_words = np.bincount(doc, minlength=n_docs) if doc.size else np.zeros(n_docs, np.int64)
    first = np.cumsum(n_words) - n_words
    ranges: dict[int, list[tuple[int, int]]] = {}
    windows: dict[int, dict[tuple[int, int, bytes], np.ndarray]] = {}
    if starts.size and table["sizes"]:
        pre = prefix_hash(span_hash(prefix_hash(low), starts, ends))
        raw = low.tobytes()
        for size, t in table["sizes"].items():
            if starts.size < size:
                continue
            a = np.arange(starts.size - size + 1)
            h = span_hash(pre, a, a + size)
            at = np.minimum(np.searchsorted(t["hashes"], h), t["hashes"].size - 1)
            for i in np.flatnonzero((t["hashes"][at] == h) & (doc[a] == doc[a + size - 1])).tolist():
                text = b" ".join(raw[starts[j]:ends[j]] for j in range(i, i + size))
                found = items_with(table, size, int(at[i]), text)
                if found.size:
                    d = int(doc[i])
                    w = i - int(first[d])
                    ranges.setdefault(d, []).append((w, w + size))
                    windows.setdefault(d, {})[size, int(at[i]), text] = found
    items = {d: {table["items"][i] for i in np.unique(np.concatenate(list(w.values()))).tolist()} for d, w in windows.items()}
    return n_words, ranges, items


def merged(ranges: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _scan(docs: DataFrame, shared, item_kind: str, text_col: str = "__text", names=("__n_words", "__spans", "__items")) -> DataFrame:
    long, item = T.LongType(), T.LongType() if item_kind == "bigint" else T.StringType()
    span = T.StructType([T.StructField("a", long), T.StructField("b", long)])
    n_words_col, spans_col, items_col = names
    schema = T.StructType([*docs.schema.fields, T.StructField(n_words_col, long), T.StructField(spans_col, T.ArrayType(span)), T.StructField(items_col, T.ArrayType(item))])

    def run(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch, text_col):
                n_words, ranges, items = scan_piece(data, offs, shared.value)
                n = rows.num_rows
                span = [[{"a": a, "b": b} for a, b in merged(ranges.get(i, []))] for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(n_words.astype(np.int64)),
                     pa.array(span, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                     pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.int64() if item_kind == "bigint" else pa.string()))],
                    names=[*rows.schema.names, *names])
    return map_batches(docs, run, schema)


NO_WINDOWS = {"items": [], "words": b"", "sizes": {}}


def _item_kind(benchmark: DataFrame, item_col: str) -> str:
    return "bigint" if benchmark.schema[item_col].dataType.simpleString() == "bigint" else "string"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", n: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_words, spans, items)``, one row per row of ``docs``: ``spans`` are
    the hit word ranges, ``items`` the distinct ids of items with a window there.

    A null text has no words; an item with null id or text has no windows; equal
    items all count; repeated rows each give a row; an empty table of either kind
    gives no hits or no rows; very long texts are scanned whole; further columns are
    ignored. With more than one block each scan is written before the next begins."""
    src = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("__text"))
    sc, kind = docs.sparkSession.sparkContext, _item_kind(benchmark, item_col)
    blocks = window_blocks(benchmark, item_col, item_text, n, block_bytes)
    cols = [F.col("__n_words").alias("n_words"), F.col("__spans").alias("spans"), F.col("__items").alias("items")]
    if len(blocks) < 2:
        return _scan(src, sc.broadcast(window_table(blocks[0]) if blocks else NO_WINDOWS), kind).select("doc_id", *cols)
    told_apart = src.withColumn("__row", F.xxhash64("doc_id", "__text"))
    every = None
    for block in blocks:                    # the first scan has all rows, later ones those with hits
        shared = sc.broadcast(window_table(block))
        part = _scan(told_apart, shared, kind).select("doc_id", "__row", *cols)
        part = part if every is None else part.filter(F.size("spans") > 0)
        part = part.groupBy("doc_id", "__row").agg(*[F.first(c).alias(c) for c in ("n_words", "spans", "items")], F.count(F.lit(1)).alias("copies"))
        part = materialize(part, "benchmark-hits")
        shared.destroy()
        every = part if every is None else every.union(part)
    return (every.groupBy("doc_id", "__row")
            .agg(F.first("n_words").alias("n_words"), F.max("copies").alias("copies"),
                 F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .select("doc_id", "n_words", "spans", "items"))


def span_words(spans: str = "spans"):
    """Number of distinct words covered by (possibly overlapping) spans."""
    step = ("struct(acc.n + greatest(0L, x.b - greatest(x.a, acc.e)) as n, greatest(acc.e, x.b) as e)")
    return F.expr(f"aggregate(array_sort({spans}), struct(0L as n, 0L as e), (acc, x) -> {step}, acc -> acc.n)")


def remove_spans(text: str | None, spans: list) -> str | None:
    """Text without the words of the spans; each removed run of words takes the
    separators inside it along."""
    if not text or not spans:
        return text
    found = [m.span() for m in WORD.finditer(ascii_lower(text))]
    out, at = [], 0
    for a, b in merged([tuple(s) for s in spans]):
        out.append(text[at:found[a][0]])
        at = found[b - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  mode: str = "documents", n: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without benchmark passages, same columns. ``mode="documents"`` drops
    each row with a hit; ``mode="spans"`` cuts the hit words out of its text. Spans are
    judged on the text that earlier blocks left.

    Null and empty texts and null ids stay; repeated rows are judged alike; very long texts
    are scanned whole; an empty table of either kind changes nothing; other columns stay,
    whatever their names."""
    if mode not in ("documents", "spans"):
        raise ValueError("mode must be 'documents' or 'spans'")
    sc, kind = docs.sparkSession.sparkContext, _item_kind(benchmark, "item_id")
    cols = docs.columns
    text, *names = free(docs, "__text", "__n_words", "__spans", "__items")
    spans, src = names[1], docs.withColumn(text, column(text_col))
    blocks = window_blocks(benchmark, "item_id", "text", n, block_bytes)
    for block in blocks:
        shared = sc.broadcast(window_table(block))
        hit = _scan(src, shared, kind, text, names)
        if mode == "documents":
            src = hit.filter(F.size(spans) == 0)
        else:
            cut = F.udf(remove_spans, "string")
            src = hit.withColumn(text_col, F.when(F.size(spans) > 0, cut(text, spans)).otherwise(column(text_col)))
            src = src.withColumn(text, column(text_col))
        src = src.select(*[column(c) for c in cols], text)
        if len(blocks) > 1:
            src = materialize(src, "decontaminated")
            shared.destroy()
    return src.select(*[column(c) for c in cols])


def item_digest(items: str = "items"):
    listed = F.array_sort(F.transform(F.col(items), lambda x: x.cast("string")))
    return F.sha2(F.array_join(listed, ","), 256)
