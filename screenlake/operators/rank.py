"""Deterministic pseudo-random rank, and global position by key.

A plain ``row_number() over (partition by stratum order by hash)`` sends every
row of a stratum to one task; with three groups and a 0.5% positive rate that
is a third of the table in one sort. ``random_rank`` is *two-level*:

1. an order-preserving bucket ``b`` of the sort key (a hex prefix of the hash)
   splits each stratum into many pieces;
2. a small table of counts per (stratum, b) gets prefix sums -> bucket offsets;
3. ``offset + row_number() over (partition by stratum, b order by ...)`` is the
   exact rank, computed by many tasks in parallel.

The result is identical to the plain window (tested). The offsets table is at
most strata x 16^prefix rows; it is joined with an ordinary join so AQE can
turn it into a broadcast after measuring it, and keep a shuffle join otherwise.
Keys that are not hashes are unevenly spread: ``key_position`` takes its ranges
from ``ordering``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.functions.hashing import hex_prefix, keyhash
from screenlake.operators.ordering import ROWS_PER_RANGE, join_null_safe, nth_key, positions

_H, _B, _OFF, _N = "__sl_h", "__sl_b", "__sl_off", "__sl_n"


def _bucket_offsets(x: DataFrame, parts: list[str]) -> DataFrame:
    counts = x.groupBy(*parts, _B).agg(F.count(F.lit(1)).alias(_N))
    w = (Window.partitionBy(*parts).orderBy(_B)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn(_OFF, F.sum(_N).over(w) - F.col(_N))


def rank_buckets(df: DataFrame, partition_by: list[str] | tuple = (), key: str = "key",
                 seed: int = 42, prefix: int = 3) -> tuple[DataFrame, DataFrame]:
    """First level of :func:`random_rank`: the rows with hash and bucket columns,
    and the small offsets table ``(P..., bucket, __sl_n, __sl_off)``."""
    parts = list(partition_by)
    x = df.withColumn(_H, keyhash(key, seed)).withColumn(_B, hex_prefix(F.col(_H), prefix))
    return x, _bucket_offsets(x.select(*parts, _B), parts)


def rank_finish(x: DataFrame, offs: DataFrame, partition_by: list[str] | tuple = (),
                key: str = "key", out: str = "rn") -> DataFrame:
    """Second level: exact rank = bucket offset + row number inside the bucket.
    Rows of buckets missing from ``offs`` (pruned) are dropped."""
    parts = list(partition_by)
    x = join_null_safe(x, offs.drop(_N), parts + [_B])
    w = Window.partitionBy(*parts, _B).orderBy(_H, key)
    return (x.withColumn(out, (F.col(_OFF) + F.row_number().over(w)).cast("bigint"))
            .drop(_H, _B, _OFF))


def random_rank(df: DataFrame, partition_by: list[str] | tuple = (), key: str = "key",
                seed: int = 42, out: str = "rn", prefix: int = 3,
                limit: Column | int | None = None) -> DataFrame:
    """Two-level ``row_number() over (partition by P order by md5(seed:key), key)``.

    ``key`` must be unique within the partition for the rank to be deterministic.
    With ``limit`` (an int, or a Column over ``partition_by``) buckets whose
    offset already reaches it are pruned before the shuffle and sort; the
    caller still applies the exact ``rn <= limit`` filter.
    """
    parts = list(partition_by)
    x, offs = rank_buckets(df, parts, key, seed, prefix)
    if limit is not None:
        lim = F.lit(limit) if isinstance(limit, int) else limit
        offs = offs.where(F.col(_OFF) < lim)
    return rank_finish(x, offs, parts, key, out)


def random_rank_plain(df: DataFrame, partition_by: list[str] | tuple = (), key: str = "key",
                      seed: int = 42, out: str = "rn") -> DataFrame:
    """Single-window form of :func:`random_rank`; reference for tests only."""
    w = Window.partitionBy(*partition_by).orderBy(keyhash(key, seed), F.col(key))
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def key_position(df: DataFrame, key: str, out: str = "pos", n_buckets: int | None = None,
                 partition_by: list[str] | tuple = (), limit: int | None = None) -> DataFrame:
    """``row_number() over (partition by P order by key)`` for a unique key of any orderable
    type, from ranges with sampled borders (``ordering.positions``). ``n_buckets`` asks for
    at least so many ranges. With ``limit`` only the rows up to that position are
    kept, found before any row is shuffled (without ``partition_by``)."""
    parts = list(partition_by)
    if limit is not None and not parts:
        last = nth_key(df, key, limit)
        df = df.where(F.col(key) <= F.lit(last)) if last is not None else df.limit(0)
    size = ROWS_PER_RANGE if n_buckets is None else max(2, 2 * df.count() // n_buckets)
    out_rows = positions(df, key, out, parts, size)
    return out_rows if limit is None else out_rows.where(F.col(out) <= limit)
