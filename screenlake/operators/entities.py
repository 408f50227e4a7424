"""Rows made of building blocks: diversity sampling, features per block, balanced folds.

A row (an assembled entity) names its blocks in one or more columns. Three operators use
that structure; a frequent block is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.functions.hashing import keyhash
from screenlake.operators.features import grams, hash_bucket
from screenlake.operators.ordering import cumulate
from screenlake.operators.rank import random_rank
from screenlake.operators.skew import salted_join
from screenlake.session import materialize

HEAVY_SHARES = 20       # a group above 1 / (HEAVY_SHARES * folds) of the rows is placed one by one


# ------------------------------------------------------------------ diversity sampling

def water_level(sizes: DataFrame, total: int) -> tuple[int | None, int]:
    """From ``sizes (n, blocks)``, how many blocks have n rows: the largest level L with
    sum(min(n, L)) <= total, and how many blocks above L can get one row more. (None, 0) if
    all rows fit. One row per distinct size is accumulated; one row reaches the driver."""
    s = sizes.withColumn("rows", F.col("n") * F.col("blocks"))
    s = cumulate(s, [], "n", ["rows", "blocks"])
    every = F.sum("blocks").over(Window.partitionBy())
    # taken if the level stood at n: everything up to n, and n from each larger block
    s = s.withColumn("__larger", every - F.col("cum_blocks")).withColumn("taken", F.col("cum_rows") + F.col("n") * F.col("__larger"))
    if s.where(F.col("taken") > total).isEmpty():
        return None, 0
    first = s.where(F.col("taken") > total).orderBy("n").first()      # the level lies below this size
    below_rows, above = first.cum_rows - first.rows, first["__larger"] + first.blocks
    level = (total - below_rows) // above
    return level, total - below_rows - level * above


def diversity_sample(df: DataFrame, block: str, total: int, key: str = "key", seed: int = 42) -> DataFrame:
    """``total`` rows (all, if there are no more) spread over the values of ``block`` as evenly
    as their sizes allow: each block gives min(size, L) rows, and the first blocks by hash of
    those larger than L one row more, until the total is met exactly. Rows of a block are drawn
    by the two-level hash rank, so a block with a third of the rows is no single task. Rows
    without a block are left out."""
    rows = df.where(F.col(block).isNotNull())
    blocks = materialize(rows.groupBy(block).agg(F.count(F.lit(1)).alias("__n")), "block-sizes")
    level, extra = water_level(blocks.groupBy(F.col("__n").alias("n")).agg(F.count(F.lit(1)).alias("blocks")), total)
    if level is None:
        return rows
    more = random_rank(blocks.where(F.col("__n") > level), [], block, seed, "__r", limit=extra).where(F.col("__r") <= extra).select(block, F.lit(1).alias("__more"))
    quota = blocks.join(more, block, "left").select(block, (F.least("__n", F.lit(level)) + F.coalesce("__more", F.lit(0))).alias("__quota"))
    ranked = random_rank(rows, [block], key, seed, "__rn", limit=level + (extra > 0))
    return salted_join(ranked, quota.where(F.col("__quota") > 0), block).where(F.col("__rn") <= F.col("__quota")).drop("__rn", "__quota").select(*df.columns)


# ------------------------------------------------------------------ features of blocks

def block_features(df: DataFrame, columns: list[str], key: str = "key", nbits: int = 512) -> DataFrame:
    """``(key, feature_idx, value)``: for each of the block columns the hashed substring counts
    of its text at ``i * nbits ..``. All columns share one dictionary of distinct texts, each
    featurised once: texts of all columns are stacked, made distinct, and joined back with
    salts for the texts that many rows share."""
    stacked = df.select(key, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("text")) for i, c in enumerate(columns)])).alias("b"))
    stacked = stacked.select(key, "b.i", F.md5("b.text").alias("__t"), "b.text").where(F.col("text").isNotNull())
    texts = stacked.select("__t", "text").distinct()
    bits = texts.select("__t", F.explode(grams("text")).alias("g")).groupBy("__t", hash_bucket("g", nbits).alias("bit")).agg(F.count(F.lit(1)).alias("value"))
    packed = bits.groupBy("__t").agg(F.collect_list(F.struct("bit", "value")).alias("__f"))      # nbits entries at most
    joined = salted_join(stacked.drop("text"), packed, "__t")
    return joined.select(key, "i", F.explode("__f").alias("f")).select(
        key, (F.col("i") * nbits + F.col("f.bit")).cast("int").alias("feature_idx"), F.col("f.value").cast("double").alias("value"))


# ------------------------------------------------------------------ balanced disjoint folds

def balanced_group_folds(df: DataFrame, group_key: str, label: str = "label", n_folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds that no group straddles, balanced in rows and in positives (``label == 1``).

    Label counts per group are aggregated first. Groups above 1 / (HEAVY_SHARES * n_folds) of
    the rows, at most HEAVY_SHARES * n_folds of them, are placed on the driver, largest first,
    each where the larger of its fold's shares of rows and of positives stays least. All other
    groups fall by hash, with chances in proportion to the room each fold has left. So a fold
    exceeds an even share of the rows by no more than the largest group, plus the spread of
    hashing groups that are each small. A null group key is a group like any other."""
    per = materialize(df.groupBy(group_key).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(label) == 1, 1)).alias("p")), "group-labels")
    rows, pos = per.agg(F.sum("n"), F.sum("p")).first()
    if rows is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    h = keyhash(F.coalesce(F.col(group_key).cast("string"), F.lit("")), seed)
    heavy = per.where(F.col("n") * HEAVY_SHARES * n_folds > rows).withColumn("h", h).orderBy(F.desc("n"), "h").collect()
    load = [[0, 0] for _ in range(n_folds)]
    placed = []
    for g in heavy:
        best = min(range(n_folds), key=lambda f: (max((load[f][0] + g.n) / rows, (load[f][1] + g.p) / max(pos, 1)), f))
        load[best][0] += g.n
        load[best][1] += g.p
        placed.append((g[0], best))
    room = [max(0.0, rows / n_folds - x[0]) for x in load]
    width = sum(room) or 1.0
    unit = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(1 << 32)
    tail = F.lit(n_folds - 1)
    for f in range(n_folds - 2, -1, -1):
        tail = F.when(unit < sum(room[:f + 1]) / width, F.lit(f)).otherwise(tail)
    fold = tail
    for value, f in placed:
        fold = F.when(F.col(group_key).eqNullSafe(F.lit(value)), F.lit(f)).otherwise(fold)
    return df.withColumn(out, fold.cast("int"))
