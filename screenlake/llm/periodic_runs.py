"""Periodic runs of words: every maximal stretch that repeats with a small period.

A run is a stretch of consecutive words with smallest period q, of at least
``max(least, 3 * q)`` words, that no neighbouring word extends. Two steps find all:

Harmonic grid. A run with period p holds a stretch of at least ``S = max(least, 3p) - p``
places i with ``w[i] == w[i + p]``. Grid points ``h = S // 2`` apart therefore hit it
twice in a row, and h grows with p, so a text of n words has some n log n grid points.
A point stays a candidate where it, the next one and the place between them match.

Common extensions. Each candidate is extended to both sides by one longest common
extension of (i, i + p). Only suffixes at places of a difference cover modulo ``V`` are
sorted: blocks of V words are named in word order, names are doubled, and neighbours'
common prefixes go into a sparse table. Any pair of places compares V words; if all are
equal, some shift below V takes both to sampled suffixes, and the least common prefix
between their ranks, one lookup of two overlapping spans, completes the answer.

By Fine and Wilf all periods of one stretch of three periods are multiples of its
smallest, so the smallest period found for a (start, end) is its period.

Whole documents are worked on in tasks, many short ones at once with a separator of its
own after each. Nothing is shuffled; a very long text costs n log n time and memory
proportional to n in its own task. Null, empty and blank texts have no words and no
runs; equal texts have equal runs; repeated rows give a row each; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.llm.batches import map_batches, pieces
from screenlake.llm.names import column

LEAST = 24              # words of the shortest run
PROBES = 1 << 20        # grid points looked at together
QUERIES = 1 << 17       # extensions computed together

# A perfect difference set; every residue modulo V is a difference of two of COVER.
V, COVER = 13, (0, 1, 3, 9)
_SHIFT = np.zeros(V, np.int64)
for _a in COVER:
    for _b in COVER:
        _SHIFT[(_b - _a) % V] = _a
_SLOT = np.full(V, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))


class CommonExtension:
    """Longest common extensions to the right in ``w``, whose entries are above 0."""

    def __init__(self, w: np.ndarray):
        self.w = np.concatenate([w, np.zeros(2 * V, w.dtype)])
        step = len(COVER)
        n_blocks = -(-w.size // V)
        places = (np.arange(n_blocks)[:, None] * V + np.array(COVER)).ravel()
        places = places[places < w.size]                    # sample number i is place V * (i // step) + COVER[i % step]
        m = self.m = places.size
        names = self._block_names(places)
        levels, jump = [names], step
        while jump < m and int(names.max()) < m:
            ahead = np.zeros(m, np.int64)
            ahead[:-jump] = names[jump:]
            names = np.unique(names * (m + 1) + ahead, return_inverse=True)[1].astype(np.int64) + 1
            levels.append(names)
            jump *= 2
        order = np.argsort(names, kind="stable")
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.table = [self._neighbour_prefixes(places, order, levels)]
        while (1 << len(self.table)) < m:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _block_names(self, places: np.ndarray) -> np.ndarray:
        """Ranks from 1 of the V words at each place, in word order."""
        order = np.arange(places.size)
        for t in range(V - 1, -1, -1):
            order = order[np.argsort(self.w[places[order] + t], kind="stable")]
        new = np.zeros(places.size, bool)
        for t in range(V):
            x = self.w[places[order] + t]
            new[1:] |= x[1:] != x[:-1]
        names = np.empty(places.size, np.int64)
        names[order] = np.cumsum(new) + 1
        return names

    def _neighbour_prefixes(self, places: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix with the next in rank order."""
        a, b = order[:-1].copy(), order[1:].copy()
        length = np.zeros(a.size, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            names, blocks = np.append(levels[k], 0), 1 << k
            x, y = np.minimum(a, self.m), np.minimum(b, self.m)
            same = (names[x] == names[y]) & (names[x] > 0)
            a[same] += blocks * len(COVER)
            b[same] += blocks * len(COVER)
            length[same] += blocks * V
        p, q = places[order[:-1]] + length, places[order[1:]] + length
        open_ = np.ones(a.size, bool)
        for t in range(V):
            open_ &= self.w[np.minimum(p + t, self.w.size - 1)] == self.w[np.minimum(q + t, self.w.size - 1)]
            length += open_
        return length

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For i < j: how many words from i on equal those from j on."""
        out = np.full(i.size, -1, np.int64)
        for t in range(V):
            todo = np.flatnonzero(out < 0)
            if todo.size == 0:
                return out
            differ = self.w[i[todo] + t] != self.w[j[todo] + t]
            out[todo[differ]] = t
        todo = np.flatnonzero(out < 0)
        i, j = i[todo], j[todo]
        shift = (_SHIFT[(j - i) % V] - i) % V
        r, s = (self.rank[(x + shift) // V * len(COVER) + _SLOT[(x + shift) % V]] for x in (i, j))
        lo, hi = np.minimum(r, s), np.maximum(r, s)
        k = np.log2((hi - lo).astype(np.float64)).astype(np.int64)
        common = np.empty(todo.size, np.int64)
        for level in np.unique(k).tolist():
            at = np.flatnonzero(k == level)
            common[at] = np.minimum(self.table[level][lo[at]], self.table[level][hi[at] - (1 << level)])
        out[todo] = shift + common
        return out


def _candidates(w: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int):
    """``(place, period)`` of grid points that may lie in a run, in bounded portions."""
    top = np.where(sizes >= least, sizes // 3, 0)
    doc = np.repeat(np.arange(sizes.size), top)
    period = np.arange(doc.size) - np.repeat(np.cumsum(top) - top, top) + 1
    step = (np.maximum(least, 3 * period) - period) // 2
    n_points = np.maximum((sizes[doc] - 1 - period - step) // step + 1, 0)
    ends = np.cumsum(n_points)
    lo = 0
    while lo < doc.size:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + PROBES, "right")))
        count = n_points[lo:hi]
        p, h = np.repeat(period[lo:hi], count), np.repeat(step[lo:hi], count)
        nth = np.arange(p.size) - np.repeat(np.cumsum(count) - count, count)
        i = np.repeat(starts[doc[lo:hi]], count) + nth * h
        hit = np.flatnonzero(w[i] == w[i + p])
        i, p, h = i[hit], p[hit], h[hit]
        keep = (w[i + h] == w[i + h + p]) & (w[i + h // 2] == w[i + h // 2 + p])
        yield i[keep], p[keep]
        lo = hi


def find_runs(w: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period. ``w`` holds documents,
    each followed by a separator that occurs nowhere else; entries are above 0."""
    found = [np.stack(c) for c in _candidates(w, starts, sizes, least)]
    cand = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    if cand.shape[1] == 0:
        return np.zeros((0, 3), np.int64)
    # only the documents with candidates are sorted
    doc = np.unique(np.searchsorted(starts, cand[0], "right") - 1)
    take = np.concatenate([np.arange(starts[d], starts[d] + sizes[d] + 1) for d in doc])
    part, local = w[take], np.searchsorted(take, cand[0])
    right, left = CommonExtension(part), CommonExtension(part[::-1].copy())
    runs, n = [], part.size
    for lo in range(0, local.size, QUERIES):
        i, p = local[lo:lo + QUERIES], cand[1, lo:lo + QUERIES]
        start = i + 1 - left(n - 1 - i - p, n - 1 - i)
        end = i + p + right(i, i + p)
        long = end - start >= np.maximum(least, 3 * p)
        runs.append(np.unique(np.stack([take[start[long]], take[end[long] - 1] + 1, p[long]], axis=1), axis=0))
    runs = np.unique(np.concatenate(runs), axis=0)
    first = np.ones(len(runs), bool)                        # the smallest period of each (start, end)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _piece_runs(texts: list[bytes], least: int):
    """Words of each text, the border of its runs in ``runs``, and ``runs`` with starts
    counted within the text."""
    words = [t.split() for t in texts]                      # bytes split at exactly \\x20 and \\x09-\\x0D
    sizes = np.array([len(x) for x in words], np.int64)
    ids: dict[bytes, int] = {}
    numbered = [ids.setdefault(x, len(ids) + 1) for text in words for x in text]
    starts = np.cumsum(sizes + 1) - sizes - 1
    w = np.empty(int(sizes.sum()) + sizes.size, np.int64)
    separators = starts + sizes
    word_at = np.ones(w.size, bool)
    word_at[separators] = False
    w[word_at] = numbered
    w[separators] = len(ids) + 1 + np.arange(sizes.size)
    runs = find_runs(w, starts, sizes, least)
    borders = np.searchsorted(runs[:, 0], np.append(starts, w.size))
    gone = np.zeros(w.size + 1, np.int64)                   # words after a run's first period
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    gone = np.cumsum(gone) > 0
    collapsed = []
    for d, text in enumerate(words):
        if borders[d] < borders[d + 1]:
            text = [x for x, out in zip(text, gone[starts[d]:starts[d] + sizes[d]].tolist()) if not out]
        collapsed.append(b" ".join(text))
    doc = np.searchsorted(starts, runs[:, 0], "right") - 1
    local = np.stack([runs[:, 0] - starts[doc], runs[:, 1] - runs[:, 0], runs[:, 2]]) if len(runs) else np.zeros((3, 0), np.int64)
    return sizes, borders, local, collapsed


RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row: ``runs`` in order of start and
    period, ``collapsed`` the words outside of any run's repeats, joined by one space."""
    if least < 3:
        raise ValueError("a run has three words at least")
    src = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    run_type = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def task(batches):
        for batch in batches:
            for rows, data, offs in pieces(batch):
                raw = data.tobytes()
                cuts = offs.tolist()
                sizes, borders, local, collapsed = _piece_runs([raw[a:b] for a, b in zip(cuts, cuts[1:])], least)
                structs = pa.StructArray.from_arrays([pa.array(x) for x in local], fields=list(run_type))
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), structs)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes), lists, pa.array(collapsed, pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "n_words", "runs", "collapsed"])
    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return map_batches(src, task, schema)


def run_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``periodic_runs``: the run with the greatest exact length /
    period (ties: least start, then period; no run: nulls), and hashes of all runs and of
    the collapsed text."""
    best = F.expr("aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), "
                  "(b, x) -> if(b is null or x.length * b.period > b.length * x.period, x, b))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    out = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
