"""Joins and decisions that hold up when a key has a large share of the rows.

``salted_join`` finds the heavy keys by a counting pass. Their rows on the large side get a
salt, their rows on the other side are copied once per salt; all other rows are joined
plainly. A key can only be heavy if it has ``1 / (SHARES * partitions)`` of the rows, so the
list of heavy keys is bounded whatever the data.

``encode_decision`` decides which columns have few distinct values by mergeable sketches in
one pass, and counts exactly only where a sketch is too close to the threshold to tell.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 4              # a key with over 1 / SHARES of an even partition is heavy
LG_K = 14               # sketches of 2 ** LG_K registers
SIGMAS = 6              # standard errors within which a sketch decides nothing

SALT = "__sl_salt"


def heavy_keys(df: DataFrame, key: str, partitions: int) -> tuple[DataFrame, int]:
    """``(key, n)`` of the keys with more than their share of rows, at most SHARES *
    ``partitions`` of them, and the number of rows of ``df``. Counts combine in the tasks first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull())
    total = df.count()
    return counts.where(F.col("n") * SHARES * partitions > total), total


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", partitions: int | None = None) -> DataFrame:
    """Equi-join of the large ``left`` with ``right`` on ``key`` (``inner`` or ``left``), as
    ``left.join(right, key, how)`` gives it, with the rows of a heavy key spread over the
    partitions by a hash of the whole row (so a task that runs again deals them alike; only
    rows equal in all columns stay together)."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join takes inner and left joins")
    n = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found, total = heavy_keys(left, key, n)
    salts = {r[0]: min(n, math.ceil(r.n * SHARES * n / total)) for r in found.collect()}
    if not salts:
        return left.join(right, key, how)
    listed = left.sparkSession.createDataFrame(list(salts.items()), f"`{key}` {left.schema[key].dataType.simpleString()}, __salts int")
    sizes = F.broadcast(listed)             # at most SHARES * n rows
    hashed = [f.name for f in left.schema if f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*hashed), F.col("__salts"))
    salted = left.join(sizes, key, "left").withColumn(SALT, F.coalesce(spread, F.lit(0)).cast("int")).drop("__salts")
    copies = right.join(sizes, key, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    return salted.join(copies, [key, SALT], how).drop(SALT).select(*left.columns, *[c for c in right.columns if c != key])


def encode_decision(df: DataFrame, cols: list[str], threshold: float = 0.5, lg_k: int = LG_K) -> DataFrame:
    """``(column_name, encode)``: whether the distinct non-null values of a column are fewer
    than ``threshold`` times the rows. One pass with a sketch per column (a few kilobytes a
    task); a column whose estimate lies within ``SIGMAS`` standard errors of the threshold is
    counted exactly, so every decision is that of the exact count."""
    sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), lg_k)).alias(c) for c in cols]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *sketches).first()
    n, error = max(row["__n"], 1), SIGMAS * 1.04 / math.sqrt(1 << lg_k)
    close = [c for c in cols if abs((row[c] or 0) / n - threshold) <= error * max((row[c] or 0) / n, threshold)]
    exact = {c: df.select(c).where(F.col(c).isNotNull()).distinct().count() for c in close}
    out = [(c, exact.get(c, row[c] or 0) / n < threshold) for c in cols]
    return df.sparkSession.createDataFrame(out, "column_name string, encode boolean")
