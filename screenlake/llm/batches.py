"""Arrow batches as flat UTF-8 byte arrays, cut into pieces of bounded size.

Python stages of this subpackage read the text column of an Arrow batch without
making Python strings: one ``uint8`` array holds the bytes of several documents,
``offs`` their borders. Whole documents stay together, so a piece is larger than
``PIECE_BYTES`` only where a single document is.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_BYTES = 1 << 19
BATCH_ROWS = 1000        # rows of an Arrow batch: texts are long, the default of 10000 holds too much
GIVE_BACK_BATCHES = 16
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and what its
    allocators hold on to is missing to the executor's other work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package: by this folder where driver and
    workers share it, else as shipped with the job (``--py-files``). Workers give freed
    memory back after every ``GIVE_BACK_BATCHES`` batches and at the end of a task."""
    def task(batches):
        for i, out in enumerate(run(batches)):
            yield out
            if i % GIVE_BACK_BATCHES == GIVE_BACK_BATCHES - 1:
                give_back()
        give_back()
    env = df.sparkSession.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, env.get("PYTHONPATH", "")]))
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(task, schema)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Yield ``(rows, bytes, offs)``; a null text has no bytes."""
    if batch.num_rows == 0:
        return
    text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).fill_null(b"")
    text = pa.concat_arrays([text])
    n = len(text)
    offs = np.frombuffer(text.buffers()[1], np.int64, n + 1 + text.offset)[text.offset:]
    buf = text.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


# Word bytes of the two word patterns used here; every byte of a non-ASCII code point is >= 0x80.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words(data: np.ndarray, offs: np.ndarray, member: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes inside each document: starts, ends, document number."""
    if data.size == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = member[data]
    before, after = np.zeros(data.size, bool), np.zeros(data.size, bool)
    before[1:], after[:-1] = w[:-1], w[1:]
    inner = offs[(offs > 0) & (offs < data.size)]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; ``x`` is uint64 and is not changed."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# Hashes of slices are polynomials modulo the prime 2**61 - 1 at one of two fixed random
# points, so different slices of one length agree with a chance of length / 2**61. (Modulo
# 2**64 some strings agree at every point.)
P61 = np.uint64((1 << 61) - 1)
HASH_BLOCK = 1 << 15
POINTS = (170528681114438561, 1957470946349857656)


def mod61(x: np.ndarray) -> np.ndarray:
    """``x`` (any uint64) modulo the prime."""
    x = (x & P61) + (x >> np.uint64(61))
    return np.minimum(x, x - P61)           # a difference below zero is over 2**63


def mul61(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of residues, from halves of 30 and 31 bits."""
    au, ad, bu, bd = a >> np.uint64(31), a & np.uint64(0x7FFFFFFF), b >> np.uint64(31), b & np.uint64(0x7FFFFFFF)
    mid = ad * bu + au * bd
    return mod61((au * bu << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & np.uint64(0x3FFFFFFF)) << np.uint64(31)) + ad * bd)


def sub61(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mod61(a + (P61 - b))


def _shifted(x: np.ndarray, k: int) -> np.ndarray:
    """A residue times 2**k: a rotation of its 61 bits."""
    return (x << np.uint64(k)) & P61 | x >> np.uint64(61 - k)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, point: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """x**i and x**-i for i < n at one of the points, kept per worker."""
    if point not in _POW or _POW[point][0].size < n:
        x, size = POINTS[point], max(n, PIECE_BYTES + 2)
        both = []
        for y in (x, pow(x, -1, int(P61))):
            a = np.ones(1, np.uint64)
            while a.size < size:
                a = np.concatenate([a, mul61(a[:size - a.size], np.uint64(pow(y, a.size, int(P61))))])
            both.append(a)
        _POW[point] = both[0], both[1]
    return _POW[point][0][:n], _POW[point][1][:n]


def prefix_hash(values: np.ndarray, point: int = 0) -> np.ndarray:
    """Prefix sums of (value + 1) * x**i; ``span_hash`` turns them into hashes of any slice.
    Worked on block by block, so that no temporary is larger than a block."""
    p, _ = powers(values.size, point)
    out = np.zeros(values.size + 1, np.uint64)
    for lo in range(0, values.size, HASH_BLOCK):
        v, x = values[lo:lo + HASH_BLOCK].astype(np.uint64), p[lo:lo + HASH_BLOCK]
        if values.dtype.itemsize == 1:          # sums of the products with either half stay below 2**56
            v += np.uint64(1)
            low, high, half = np.cumsum(v * (x & np.uint64(0xFFFFFFFF))), np.cumsum(v * (x >> np.uint64(32))), 32
        else:
            t = mul61(mod61(v) + np.uint64(1), x)
            low, high, half = np.cumsum(t & np.uint64(0x3FFFFFFF)), np.cumsum(t >> np.uint64(30)), 30
        out[lo + 1:lo + 1 + v.size] = mod61(low + _shifted(high, half) + out[lo])     # three terms below 2**63 in all
    return out


def span_value(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, point: int = 0) -> np.ndarray:
    """The polynomial of each slice [start, end), wherever it lies."""
    _, q = powers(prefix.size, point)
    out = np.empty(starts.size, np.uint64)
    for lo in range(0, starts.size, HASH_BLOCK):
        at = slice(lo, lo + HASH_BLOCK)
        out[at] = mul61(sub61(prefix[ends[at]], prefix[starts[at]]), q[starts[at]])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, point: int = 0) -> np.ndarray:
    """Position-independent hash of each slice [start, end)."""
    return mix(span_value(prefix, starts, ends, point) + (ends - starts).astype(np.uint64))
