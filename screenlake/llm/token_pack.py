"""Token ids in fixed-width bit-packed blocks.

Documents are range-partitioned by id and sorted, so the shards follow the id
order. A shard is a sequence of blocks of about ``BLOCK_IDS`` ids (whole
documents; a longer document is a block of its own). Every id takes the least
number of bits that holds the vocabulary; a block stores its offset in the
shard, its document ids, where each document ends, and the packed payload, so a
reader can find a range of positions from the offsets and unpack it with numpy.

File format: Parquet rows (shard, block, offset, n_ids, width, doc_ids, ends,
payload), payload = ids, little-endian bit order, padded to whole bytes.

Encoding: this tokenizer drops white space before it splits words, so runs
between ASCII white space are encoded independently of each other. Each
worker encodes different runs with the library, ``ENCODE_TEXTS`` at a time as one text, in which
the id of ``MARK`` ends each run (one by one where their ids hold that id too), and keeps them in
a table, which holds at most ``KEPT_RUNS`` runs (about 25 MB), drops those not met again when it
is full, and outlives a task; documents are put together with numpy. Runs are found
by hash and compared byte for byte with each other in a piece, and by a second hash at
another point (122 bits together) with the table; if two differ under one hash, the library
encodes those texts whole.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.llm.batches import NOT_SPACE, map_batches, pieces, prefix_hash, span_hash, words
from screenlake.session import shared_dir

END_ID = 2
BLOCK_IDS = 1 << 16
KEPT_RUNS = 1 << 19
ENCODE_TEXTS = 1 << 8      # the library holds about 1 kB for a text that it has encoded
MARK = b" \x01 "            # between runs a word of its own


def id_width(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """ids below 2**width in ``width`` bits each."""
    if ids.size and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit {width} bits")
    if width == 16:
        return ids.astype("<u2").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, n: int, width: int, start: int = 0) -> np.ndarray:
    """``n`` ids from number ``start`` on, without reading what lies before."""
    lo, hi = start * width // 8, -(-(start + n) * width // 8)
    raw = np.frombuffer(payload, np.uint8)[lo:hi]
    if width == 16:
        return raw.view("<u2").astype(np.uint32)
    skip = start * width - lo * 8
    bits = np.unpackbits(raw, bitorder="little")[skip:skip + n * width].reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


class RunEncoder:
    """Encodes pieces of text run by run with a table of runs already encoded."""

    def __init__(self, tokenizer):
        self.tok = tokenizer
        self.mark = self._ids([MARK])[0]
        self.clear()

    def clear(self):
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.len = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(0, np.uint32), np.zeros(0, bool)

    def _keep_used(self):
        """Drop the runs not met again since the last call; all of them where that is not half."""
        kept = np.flatnonzero(self.used)
        if kept.size > KEPT_RUNS // 2:
            return self.clear()
        n = self.len[kept]
        at = np.cumsum(n, dtype=np.int64) - n
        self.ids = self.ids[np.repeat(self.at[kept] - at, n) + np.arange(int(n.sum()))]
        self.key, self.check, self.at, self.len = self.key[kept], self.check[kept], at, n
        self.used = np.zeros(kept.size, bool)

    def _ids(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, n = [], []
        for lo in range(0, len(texts), ENCODE_TEXTS):
            some = texts[lo:lo + ENCODE_TEXTS]
            if len(self.mark) == 1:                       # a text costs the library more than a word does
                out = self._ids([MARK.join(some) + MARK])[0]
                flat = np.fromiter(out, np.uint32, len(out))
                at = np.flatnonzero(flat == self.mark[0])
                if at.size == len(some):                  # else a text gives that id itself
                    ids.append(np.delete(flat, at))
                    n.append(np.diff(at, prepend=-1) - 1)
                    continue
            out = self._ids(some)
            n.append(np.fromiter(map(len, out), np.int64, len(out)))
            ids.append(np.fromiter(chain.from_iterable(out), np.uint32, int(n[-1].sum())))
        return np.concatenate(ids), np.concatenate(n)

    def piece(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all documents of a piece, and how many each has."""
        n_docs = offs.size - 1
        starts, ends, doc = words(data, offs, NOT_SPACE)
        if starts.size == 0:
            return np.zeros(0, np.uint32), np.zeros(n_docs, np.int64)
        h = span_hash(prefix_hash(data), starts, ends)
        inv, u = pd.factorize(h)                                # by hash table; only the different ones are sorted
        order = np.argsort(u)
        place = np.empty(u.size, np.int64)
        place[order] = np.arange(u.size)
        u, inv, first = u[order], place[inv], np.empty(u.size, np.int64)
        first[inv] = np.arange(h.size)
        raw, lens = data.tobytes(), ends - starts
        rep = first[inv]
        same = np.array_equal(lens, lens[rep])
        if same:
            again = np.flatnonzero(rep != np.arange(rep.size))      # each with the run that stands for it
            size = lens[again]
            place = np.repeat(starts[again] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            same = np.array_equal(data[place], data[place + np.repeat(starts[rep[again]] - starts[again], size)])
        check = span_hash(prefix_hash(data, 1), starts[first], ends[first], 1)
        known = np.minimum(np.searchsorted(self.key, u), max(self.key.size - 1, 0))
        hit = self.key[known] == u if self.key.size else np.zeros(u.size, bool)
        if not same or (hit & (self.check[known] != check if self.key.size else hit)).any():
            ids, n = self._encode([raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())])
            return ids, n
        new = np.flatnonzero(~hit)
        if new.size:
            if self.key.size + new.size > KEPT_RUNS and self.key.size:
                self.used[known[hit]] = True
                if hit.sum() + new.size > KEPT_RUNS:      # one piece would fill the table
                    self.clear()
                else:
                    self._keep_used()
                return self.piece(data, offs)
            f = first[new]
            ids, n = self._encode([raw[a:b] for a, b in zip(starts[f].tolist(), ends[f].tolist())])
            at = self.ids.size + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, ids])
            to = np.searchsorted(self.key, u[new])              # one array of the table at a time is copied
            self.key, self.check = np.insert(self.key, to, u[new]), np.insert(self.check, to, check[new])
            self.at, self.len = np.insert(self.at, to, at), np.insert(self.len, to, n)
            self.used = np.insert(self.used, to, False)
            known = np.searchsorted(self.key, u)
        self.used[known[hit]] = True
        run = known[inv]
        n = self.len[run]
        out = self.ids[np.repeat(self.at[run] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return out, np.bincount(doc, weights=n, minlength=n_docs).astype(np.int64)


_ENCODERS: dict[str, RunEncoder] = {}


def encoder(path: str) -> RunEncoder:
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks already fill the cores
        from tokenizers import Tokenizer
        _ENCODERS[path] = RunEncoder(Tokenizer.from_file(path))
    return _ENCODERS[path]


BLOCK_FIELDS = [("shard", T.IntegerType()), ("block", T.IntegerType()), ("offset", T.LongType()),
                ("n_ids", T.LongType()), ("width", T.IntegerType())]


def block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([*(T.StructField(n, t) for n, t in BLOCK_FIELDS), T.StructField("doc_ids", T.ArrayType(id_type)),
                         T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])


def encode_blocks(docs: DataFrame, tokenizer: str, vocab_size: int, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Packed blocks of ``docs`` in ascending id order (null ids first; rows of one id
    in the order of their text hash). ``tokenizer`` is the path of its file on the
    executors. A null or empty text is the end id alone."""
    width = id_width(max(vocab_size, end_id + 1))
    schema = block_schema(docs.schema[id_col].dataType)

    def run(batches):
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        block, offset, ids, names, ends = 0, 0, [], [], []

        def flush():
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([offset], pa.int64()),
                pa.array([flat.size], pa.int64()), pa.array([width], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, sum(map(len, names))], pa.int32()), pa.concat_arrays(names)),
                pa.array([np.concatenate(ends)], pa.list_(pa.int64())), pa.array([pack(flat, width)], pa.binary())],
                names=schema.names)
        for batch in batches:
            for rows, data, offs in pieces(batch):
                flat, n = enc.piece(data, offs)
                stop = np.cumsum(n)
                flat = np.insert(flat, stop, end_id)                       # the end id after each document
                stop = stop + np.arange(1, n.size + 1)
                lo = 0
                while lo < n.size:
                    base, held = (stop[lo - 1] if lo else 0), sum(map(len, ids))
                    hi = max(lo + 1, int(np.searchsorted(stop, base + block_ids - held, "right")))
                    if held and stop[hi - 1] - base + held > block_ids:
                        yield flush()
                        block, offset, ids, names, ends = block + 1, offset + held, [], [], []
                        continue
                    ids.append(flat[base:stop[hi - 1]])
                    names.append(rows.column(0).slice(lo, hi - lo))
                    ends.append(stop[lo:hi] - base + held)
                    lo = hi
        if ids:
            yield flush()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = src.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return map_batches(ordered, run, schema)


def write_ids(docs: DataFrame, path: str, tokenizer: str, vocab_size: int, **options) -> None:
    encode_blocks(docs, tokenizer, vocab_size, **options).write.mode("overwrite").parquet(path)


def located_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``, the number of ids in all shards and blocks before. Only
    one row per shard is totalled in one task."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    return blocks.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("offset")).drop("base")


def read_range(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """``(position, id)`` for positions lo <= p < hi: only the blocks that overlap the
    range are unpacked, and of them only that part."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                a, b = max(lo, r["start"]), min(hi, r["start"] + r["n_ids"])
                ids = unpack(r["payload"], b - a, r["width"], a - r["start"])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, b)), pa.array(ids.astype(np.int64))], names=["position", "id"])
    found = located_blocks(spark, path).filter((F.col("start") < hi) & (F.col("start") + F.col("n_ids") > lo))
    return map_batches(found.select("start", "n_ids", "width", "payload"), run, "position bigint, id bigint")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    blocks = located_blocks(spark, path).select("start", "n_ids", "width", "doc_ids", "ends", "payload")
    id_type = blocks.schema["doc_ids"].dataType.elementType

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start, n, width = (batch.column(k)[i].as_py() for k in range(3))
                ends = np.asarray(batch.column(4)[i].values, np.int64)
                ids = unpack(batch.column(5)[i].as_py(), n, width).astype("<u4")
                first = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(first.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(3)[i].values, pa.array(start + first), pa.array(ends - first), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])
    long = T.LongType()
    return map_batches(blocks, run, T.StructType([T.StructField("doc_id", id_type), T.StructField("start", long),
                                                T.StructField("n_tokens", long), T.StructField("ids_crc32", long)]))


def token_files(docs: DataFrame, tokenizer: str, vocab_size: int, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to files (a fresh folder of the shared one by default) and read
    them back, one row per row of ``docs``. An empty table gives no rows; further
    columns are ignored."""
    path = path or shared_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, vocab_size, **options)
    return read_documents(docs.sparkSession, path)
