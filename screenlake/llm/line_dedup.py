"""Line dedup: a deletion-neighbourhood join within one edit.

A line is removed if an equal line, or one within edit distance 1 (code points;
lines of at least ``FUZZY_FROM`` code points), stands before it: in a document
with a smaller id or earlier in its own. Blank lines stay.

Two lines within one edit share a deletion variant: both without the character at
one place (substitution; all lines under one such key are within one edit of each
other), or the longer without one character and the shorter whole (insertion). So
each key needs its earliest line only and no pairs are formed: rows stay linear in
the text however many lines share a key. The claims found are verified with the
edit distance of the texts.

Variants are emitted only for lines that can have a partner: of two lines within
one edit, cut at the middle of the shorter, the first halves or the second halves
are equal. A first scan emits the hashes of those halves, a bit table of the
halves that several different lines share picks the lines in a second scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.batches import map_batches, mix, mod61, mul61, pieces, powers, prefix_hash, span_hash, sub61
from screenlake.llm.key_filter import key_filter, may_hold
from screenlake.llm.names import column, free
from screenlake.operators.ordering import positions
from screenlake.session import materialize

FUZZY_FROM = 16
RANKED = 1 << 13         # candidate lines one task puts in order
LINE_PIECE = 1 << 19     # code points and two prefix sums take some 60 bytes a byte


def piece_lines(data: np.ndarray, offs: np.ndarray):
    """Code points of a piece, and of each line: start, end, document, number in it."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(cp == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = np.cumsum([len(t) + 1 for t in texts]) - 1                  # the line end after each document
    doc = np.searchsorted(last, ends, "left")
    number = np.arange(ends.size) - np.searchsorted(ends, np.concatenate([[-1], last[:-1]]), "right")[doc]
    blank = np.concatenate([[0], np.cumsum(~np.isin(cp, [9, 11, 12, 13, 32, 10]))])
    return cp, starts, ends, doc, number, blank[ends] == blank[starts]


def line_hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits of XXH3 of each line, as two columns."""
    view, four = memoryview(cp.tobytes()), zip((starts * 4).tolist(), (ends * 4).tolist())
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[a:b]) for a, b in four), np.uint64).reshape(-1, 2)


def half_keys(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per line four keys: first and second half, cut for its own length and for one less."""
    view, keys = memoryview(cp.tobytes()), []
    for a, b in zip((starts * 4).tolist(), (ends * 4).tolist()):
        for m in ((b - a) // 4, (b - a) // 4 - 1):
            keys.append(xxhash.xxh3_64_intdigest(view[a:a + m // 2 * 4]))
            keys.append(xxhash.xxh3_64_intdigest(view[b - (m - m // 2) * 4:b], 1))
    return np.array(keys, np.uint64).reshape(-1, 4)


def row_key(id_col: str, text_col: str):
    """A row by its id and the hash of its text: rows of one id with different texts are
    told apart, rows equal in both count as one document."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(row_key(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))


def _lines(src: DataFrame, kind: str) -> DataFrame:
    """``(doc_id, n_lines, line_no, h1, h2, halves)`` of every line that is not blank;
    a document without such lines has one row with line_no -1."""
    def run(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch, limit=LINE_PIECE):
                cp, a, b, doc, number, blank = piece_lines(data, offs)
                n_lines = np.bincount(doc, minlength=rows.num_rows)
                keep = np.flatnonzero(~blank)
                h1, h2 = np.ascontiguousarray(line_hashes(cp, a[keep], b[keep]).T)
                none = np.setdiff1d(np.arange(rows.num_rows), doc[keep])
                who = np.concatenate([doc[keep], none])
                fuzzy = b[keep] - a[keep] >= FUZZY_FROM
                size, flat = np.where(fuzzy, 4, 0), half_keys(cp, a[keep[fuzzy]], b[keep[fuzzy]]).ravel()
                ends = np.concatenate([[0], np.cumsum(size), np.full(none.size, size.sum())]).astype(np.int32)
                z = np.zeros(none.size, np.uint64)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(pa.array(who)), pa.array(n_lines[who]),
                    pa.array(np.concatenate([number[keep], np.full(none.size, -1)]).astype(np.int32)),
                    pa.array(np.concatenate([h1, z]).view(np.int64)), pa.array(np.concatenate([h2, z]).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
                    names=["doc_id", "n_lines", "line_no", "h1", "h2", "halves"])
    return map_batches(src, run, f"doc_id {kind}, n_lines bigint, line_no int, h1 bigint, h2 bigint, halves array<bigint>")


def _candidates(src: DataFrame, kind: str, shared) -> DataFrame:
    """Lines one of whose halves may be shared by different lines, with their text."""
    def run(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch, limit=LINE_PIECE):
                cp, a, b, doc, number, blank = piece_lines(data, offs)
                keep = np.flatnonzero(~blank & (b - a >= FUZZY_FROM))
                hit = may_hold(shared.value, half_keys(cp, a[keep], b[keep]).ravel()).reshape(-1, 4).any(axis=1)
                at = keep[hit]
                h1, h2 = np.ascontiguousarray(line_hashes(cp, a[at], b[at]).T)
                text = [cp[x:y].tobytes().decode("utf-32-le") for x, y in zip(a[at].tolist(), b[at].tolist())]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(pa.array(doc[at])), pa.array(number[at].astype(np.int32)), pa.array(h1.view(np.int64)),
                    pa.array(h2.view(np.int64)), pa.array(text, pa.string())], names=["doc_id", "line_no", "h1", "h2", "line"])
    return map_batches(src, run, f"doc_id {kind}, line_no int, h1 bigint, h2 bigint, line string")


def variant_keys(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Deletion variants of each line: line number, key and role (0: substitution at a
    place, 1: the line is the longer of an insertion, 2: the shorter, its own hash)."""
    pre = prefix_hash(cp)
    size = ends - starts
    line = np.repeat(np.arange(starts.size), size)
    j = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    s, e = starts[line], ends[line]
    _, q = powers(pre.size + 1)
    rest = mod61(sub61(pre[s + j], pre[s]) + mul61(sub61(pre[e], pre[s + j + 1]), q[1]))
    without = mix(mul61(rest, q[s]) + (e - s - 1).astype(np.uint64))      # equals span_hash of the shorter line
    same = np.zeros(j.size, bool)
    same[1:] = (cp[(s + j)[1:]] == cp[(s + j)[:-1]]) & (j[1:] > 0)
    sub = mix(without ^ mix(j.astype(np.uint64) + np.uint64(1)))
    own = span_hash(pre, starts, ends)
    return (np.concatenate([line, line[~same], np.arange(starts.size)]), np.concatenate([sub, without[~same], own]),
            np.concatenate([np.zeros(line.size, np.int8), np.ones(int((~same).sum()), np.int8), np.full(starts.size, 2, np.int8)]))


def _variants(lines: DataFrame) -> DataFrame:
    """``(key, role, rank)`` of all deletion variants of ``lines (rank, line)``."""
    def run(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch, "line", 1 << 18):
                cp, a, b, doc, number, _ = piece_lines(data, offs)
                line, key, role = variant_keys(cp, a, b)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(role), rows.column(0).take(pa.array(line))], names=["key", "role", "rank"])
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))       # few rows in, many out
    return map_batches(lines.select("rank", "line").repartition(n, "rank"), run, "key bigint, role tinyint, rank bigint")


def near_claims(lines: DataFrame) -> DataFrame:
    """``(h1, near_id)``: line ``h1`` has an earlier line, of document ``near_id``, within one
    edit. ``lines`` has one row per distinct line: doc_id, line_no, h1, line."""
    # one number says which of two lines is earlier
    lines = materialize(positions(lines.withColumn("__at", F.struct("doc_id", "line_no", "h1")), "__at", "rank", limit=RANKED).select("rank", "h1", "doc_id", "line"), "line-ranks")
    v = _variants(lines)
    # earliest line of each role under a key; a key with one line makes no claim
    per_key = v.groupBy("key").agg(*[F.min(F.when(F.col("role") == r, F.col("rank"))).alias(f"m{r}") for r in (0, 1, 2)],
                                   F.max(F.when(F.col("role") == 0, F.col("rank"))).alias("x0"))
    per_key = per_key.filter("m0 < x0 or (m1 is not null and m2 is not null)")
    live = materialize(per_key.select("key", "m0", "m1", "m2"), "line-keys")
    hit = v.join(live, "key")
    by = F.when(F.col("role") == 0, F.col("m0")).when(F.col("role") == 1, F.col("m2")).otherwise(F.col("m1"))
    claims = hit.withColumn("by", by).filter("by < rank").select("rank", "by").distinct()
    both = claims.join(lines.select("rank", "h1", F.col("line").alias("a")), "rank").join(lines.select(F.col("rank").alias("by"), "doc_id", F.col("line").alias("b")), "by")
    ok = F.expr("levenshtein(a, b, 1)").between(0, 1)
    return both.filter(ok).groupBy("h1").agg(F.min_by("doc_id", "by").alias("near_id"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed (line numbers
    from 0, ascending), keepers (ids of the documents whose lines stay in their place).

    A null text counts as empty, which is one blank line; rows of one id
    with different texts are documents of their own, in the order of their text hashes,
    rows equal in id and text are one; a null id sorts first and is named as keeper; an empty table gives an empty one; further
    columns are ignored."""
    src = _source(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = materialize(_lines(src, kind), "lines")
    lines = rows.filter("line_no >= 0")
    halves = lines.select("h1", F.explode("halves").alias("half")).groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
    shared = key_filter(halves.filter("lo <> hi"), "half")
    found = _candidates(src, kind, shared)
    first = F.min(F.struct("doc_id", "line_no", "line"))
    distinct = materialize(found.groupBy("h1", "h2").agg(first.alias("f")).select("f.doc_id", "f.line_no", "h1", "f.line"), "line-candidates")
    claims = near_claims(distinct).select(F.col("h1").alias("__h"), "near_id", F.lit(True).alias("near"))
    same = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("f"), F.count(F.lit(1)).alias("n"))
    same = same.join(claims, F.col("h1") == F.col("__h"), "left").filter("n > 1 or near").select("h1", "h2", "f", "near", "near_id")
    gone = lines.select("doc_id", "line_no", "h1", "h2").join(same, ["h1", "h2"])
    later = ~F.struct("doc_id", "line_no").eqNullSafe(F.col("f"))
    gone = gone.filter(later | F.col("near")).select("doc_id", "line_no", F.when(F.col("near"), F.col("near_id")).otherwise(F.col("f.doc_id")).alias("keeper"))
    return removal_report(docs, id_col, text_col, rows, gone)


def removal_report(docs: DataFrame, id_col: str, text_col: str, rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Per row of ``docs`` what ``gone (doc_id, line_no, keeper)`` removes of it; ``rows``
    has (doc_id, n_lines) of every document; all by ``row_key``."""
    kind = rows.schema["doc_id"].dataType["id"].dataType.simpleString()
    gone = gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("removed"), F.array_sort(F.collect_set("keeper")).alias("keepers"))
    every = rows.groupBy("doc_id").agg(F.max("n_lines").alias("n_lines"))
    out = every.join(gone, "doc_id", "left")
    out = out.select("doc_id", "n_lines", F.coalesce("removed", F.expr("cast(array() as array<int>)")).alias("removed"),
                     F.coalesce(F.array_distinct(F.col("keepers.id")), F.expr(f"cast(array() as array<{kind}>)")).alias("keepers"))
    ids = docs.select(row_key(id_col, text_col).alias("doc_id"))
    out = ids.join(out, "doc_id")
    return out.select("doc_id.id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), "removed", "keepers", F.col("doc_id.text").alias("text_hash")).withColumnRenamed("id", "doc_id")


def drop_lines(docs: DataFrame, report: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of the lines that stay after ``report``; same rows and columns."""
    key, gone = free(docs, "row_", "gone_")
    cuts = report.filter("n_removed > 0").select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("text")).alias(key), F.col("removed").alias(gone)).distinct()
    text = F.expr(f"array_join(transform(filter(transform(split(`{text_col}`, '\\n', -1), (x, i) -> struct(i as i, x as x)), "
                  f"z -> not array_contains({gone}, z.i)), z -> z.x), '\\n')")
    out = docs.withColumn(key, row_key(id_col, text_col)).join(cuts, key, "left")
    return out.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(text)).select(*[column(c) for c in docs.columns])
