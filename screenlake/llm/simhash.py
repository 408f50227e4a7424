"""SimHash near-dedup: 64-bit fingerprints linked at a few differing bits.

Fingerprints: words of the lower-cased text, word shingles (repeats included),
each shingle hashed with XXH64, a bit set where over half the hashes have it.

Links (pigeonring principle): cut the 64 bits into ``max_bits + 1`` segments on
a ring. If two fingerprints differ in at most ``max_bits`` bits, then from some
segment on every chain of ``l`` consecutive segments differs in at most
``l * max_bits / segments`` bits. The first segment of such a chain is equal, so
it is the key of the candidate search. Where a key holds many fingerprints the
chain is made one segment longer instead of comparing them all: the next
segment may differ in one bit, so it enters the key with each single bit masked
in turn, and where that is still not enough, the third with each pair of bits.
Every step is exact. Candidates that share a key must pass all chain budgets
before the full Hamming check.

Equal fingerprints are one node of the graph, so groups of exact copies never
meet in a task; within a key only a spanning forest is emitted.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.batches import NOT_SPACE, lower_ascii, map_batches, pieces, words
from screenlake.llm.components import connected_components
from screenlake.llm.names import column, free
from screenlake.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BUCKET = 1024          # fingerprints compared within one key before the chain is lengthened


def piece_fingerprints(data: np.ndarray, offs: np.ndarray, k: int) -> np.ndarray:
    """uint64 fingerprint of each document of a piece."""
    n_docs = offs.size - 1
    out = np.zeros(n_docs, np.uint64)
    starts, ends, doc = words(data, offs, NOT_SPACE)
    if starts.size == 0:
        return out
    lens = ends - starts
    at = np.cumsum(lens + 1) - (lens + 1)          # place of each word in the space-joined copy
    joined = np.full(int(at[-1] + lens[-1] + 1), 0x20, np.uint8)
    src = np.flatnonzero(NOT_SPACE[data])
    joined[np.arange(src.size) + np.repeat(np.arange(starts.size), lens)] = lower_ascii(data)[src]
    n_words = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(n_words) - n_words
    n_sh = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    sh_first = np.cumsum(n_sh) - n_sh
    total = int(n_sh.sum())
    sh_doc = np.repeat(np.arange(n_docs), n_sh)
    a = np.arange(total) - sh_first[sh_doc] + first[sh_doc]
    b = a + np.minimum(k, n_words[sh_doc]) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[x:y], SEED) for x, y in zip(at[a].tolist(), (at[b] + lens[b]).tolist())),
                         np.uint64, total)
    full = np.flatnonzero(n_sh)
    for lo in range(0, full.size, 512):             # bits of a few documents at a time
        d = full[lo:lo + 512]
        s, e = sh_first[d[0]], sh_first[d[-1]] + n_sh[d[-1]]
        bits = np.unpackbits(hashes[s:e].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, sh_first[d] - s, axis=0, dtype=np.int64)
        out[d] = np.packbits(2 * ones > n_sh[d][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp bigint)``, one row per row of ``docs``. Null, empty and blank
    texts have fingerprint 0; fewer than ``k`` words are one shingle."""
    def run(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(piece_fingerprints(data, offs, k).view(np.int64))], names=["doc_id", "fp"])
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, fp bigint")


def _segment(fp: Column, i: int, n_seg: int) -> Column:
    lo, hi = 64 * (i % n_seg) // n_seg, 64 * (i % n_seg + 1) // n_seg
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def chain_budgets(max_bits: int) -> list[int]:
    return [max_bits * (l + 1) // (max_bits + 1) for l in range(max_bits + 1)]


def bucket_forest(key: np.ndarray, fp: np.ndarray, start: np.ndarray, max_bits: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by key: within each key, edges (fp, smallest fp reached) of the
    components under the chain budgets and the Hamming bound."""
    n_seg, budgets = max_bits + 1, chain_budgets(max_bits)
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[cuts, key.size])
    left, right = [], []
    for c, size in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        x = np.unique(fp[c:c + size])
        if x.size < 2:
            continue
        diff = x[:, None] ^ x[None, :]
        ok, total = np.ones(diff.shape, bool), np.zeros(diff.shape, np.uint8)
        for l in range(n_seg):
            i = (int(start[c]) + l) % n_seg
            lo, hi = 64 * i // n_seg, 64 * (i + 1) // n_seg
            total += np.bitwise_count((diff >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1))
            ok &= total <= budgets[l]
        label = np.arange(x.size)
        np.fill_diagonal(ok, False)
        if not ok.any():
            continue
        while True:                                  # smallest index reached, by doubling
            best = np.minimum(label, np.where(ok, label[None, :], x.size).min(axis=1))
            best = best[best]
            if (best == label).all():
                break
            label = best
        moved = label != np.arange(x.size)
        left.append(x[moved])
        right.append(x[label[moved]])
    if not left:
        z = np.zeros(0, np.uint64)
        return z, z
    return np.concatenate(left), np.concatenate(right)


def _within_keys(rows: DataFrame, max_bits: int) -> DataFrame:
    def run(batches):
        held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]

        def emit(part):
            a, b = bucket_forest(part[0], part[1], part[2], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
        for batch in batches:
            new = [batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64),
                   batch.column(2).to_numpy(zero_copy_only=False)]
            held = [np.concatenate(p) for p in zip(held, new)]
            cut = int(np.searchsorted(held[0], held[0][-1], "left")) if held[0].size else 0
            if cut:                                   # the last key may go on in the next batch
                yield emit([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if held[0].size > 1:
            yield emit(held)
    by_key = rows.repartition("key").sortWithinPartitions("key").select("key", "fp", F.col("start").cast("bigint"))
    return map_batches(by_key, run, "a bigint, b bigint")


def link_edges(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints, enough to connect every
    pair within ``max_bits`` bits. ``fps`` has one row per distinct ``fp``."""
    n_seg = max_bits + 1
    if not 1 <= max_bits <= 7:
        raise ValueError("max_bits must be 1 to 7")
    fp = F.col("fp")
    width = 64 // n_seg
    one = fps.select("fp", F.explode(F.array([
        F.struct(F.lit(i).alias("start"), F.shiftleft(F.lit(i).cast("bigint"), 40).bitwiseOR(_segment(fp, i, n_seg)).alias("key"))
        for i in range(n_seg)])).alias("s")).select("fp", "s.start", "s.key")
    # at most (max_bits + 1) * 2**ceil(64 / (max_bits + 1)) keys: bounded whatever the input
    sizes = one.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.filter(F.col("n") > bucket).select("key"), "simhash-large")
    if large.isEmpty():
        return _within_keys(one, max_bits)
    big = F.broadcast(large) if 64 % n_seg == 0 and width <= 16 else large
    edges = _within_keys(one.join(big, "key", "left_anti"), max_bits)
    budgets = chain_budgets(max_bits)
    rows, keys = one.join(big, "key", "left_semi"), None
    seg_no = 1
    while True:
        masks = [sum(1 << b for b in c) for c in combinations(range(-(-64 // n_seg)), min(budgets[seg_no], 2))]
        per_start = [_segment(fp, i + seg_no, n_seg) for i in range(n_seg)]
        nxt = F.element_at(F.array(*per_start), F.col("start") + 1)
        wider = rows.select("fp", "start", "key", nxt.alias("nxt"), F.explode(F.array([F.lit(m).cast("bigint") for m in masks])).alias("mask"))
        rows = wider.select("fp", "start", F.xxhash64("key", "mask", F.col("nxt").bitwiseAND(F.bitwise_not(F.col("mask")))).alias("key"))
        if seg_no == 2 or seg_no + 1 >= n_seg or budgets[seg_no + 1] > 2:
            return edges.union(_within_keys(rows, max_bits))   # few free bits are left: groups are bounded
        rows = materialize(rows, "simhash-rows")
        keys = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("key"), "simhash-large")
        if keys.isEmpty():
            return edges.union(_within_keys(rows, max_bits))
        edges = edges.union(_within_keys(rows.join(keys, "key", "left_anti"), max_bits))
        rows = rows.join(keys, "key", "left_semi")
        seg_no += 1


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``; the component
    is the smallest doc_id reachable over links.

    Null and empty texts have fingerprint 0 and are linked like any other; equal
    texts and repeated rows fall into one component; an empty table gives an
    empty one; further columns of ``docs`` are ignored."""
    rows = materialize(fingerprints(docs, id_col, text_col, k), "simhash-fp")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = materialize(link_edges(fps.select("fp"), max_bits), "simhash-edges")
    if edges.isEmpty():
        return rows.join(fps, "fp").select("doc_id", "fp", F.col("first_id").alias("component_id"))
    member = connected_components(edges).select(F.col("node").alias("fp"), "component")
    fps = materialize(fps.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "simhash-nodes")
    root = fps.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return (rows.join(fps.join(root, "component").select("fp", "component_id"), "fp")
            .select("doc_id", "fp", "component_id"))


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` that stay, with their columns: of each component one row, with the
    smallest doc_id (rows without an id come last). Of several rows with that id the one
    with the smallest hashes of text and columns stays, of equal rows one."""
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(F.lit(1), F.col(text_col)).alias("text"),
                   F.xxhash64(F.lit(2), *[x for c in docs.columns for x in (F.col(c).isNull(), F.col(c))]).alias("all"))
    row, keep_col, rank = free(docs, "__row", "__keep", "__rank")
    src = docs.withColumn(row, key)
    parts = materialize(simhash_components(src, row, text_col, k, max_bits), "simhash-parts")
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    roots = parts.filter(same).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    keep = roots.select(F.col("doc_id").alias(keep_col))
    kept = src.join(keep, F.col(row).eqNullSafe(F.col(keep_col)), "left_semi")
    if roots.filter("n > 1").isEmpty():
        return kept.drop(row)
    order = Window.partitionBy(row).orderBy(*[column(c).asc_nulls_first() for c in docs.columns])
    return kept.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank, row)
