"""Down-sampling of very imbalanced labelled tables.

Random draws are md5 ranks (R1), so a sample is reproducible across cluster
sizes and executor loss, and the SQL oracle can recompute it. Quotas come from
small count tables; buckets of the rank that cannot reach a quota are pruned
before any row is shuffled (most negatives never leave the scan task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.functions.hashing import keyhash
from screenlake.operators.ordering import join_null_safe
from screenlake.operators.rank import _N, _OFF, key_position, random_rank, rank_buckets, rank_finish
from screenlake.session import materialize

# Fixed values from the reference configuration.
NEGATIVE_RATIO = 5
MAX_POSITIVE_SAMPLES = 150_000
MAX_TOTAL_SAMPLES = 1_500_000
RANDOM_SEED = 42
DATA_CHUNK_SIZE = 2_000_000
MERGE_INTERVAL = 5


def stratified_sample(df: DataFrame, group: str = "grp", label: str = "label", key: str = "key",
                      negative_ratio: int = NEGATIVE_RATIO,
                      max_positive: int | None = MAX_POSITIVE_SAMPLES,
                      seed: int = RANDOM_SEED, groups: list[str] | None = None,
                      prefix: int = 3) -> DataFrame:
    """Per group keep positives up to ``max_positive`` (all when None), then
    ``min(n_neg, ratio * kept positives)`` negatives of that group.

    Positives are ``label == 1`` and negatives ``label == 0``; other labels are
    dropped. With ``groups`` only those groups are sampled (F5).
    Output: input columns plus ``rn`` (rank inside the (group, label) stratum).
    """
    base = df.where(F.col(label).isin(0, 1))
    base = base.where(F.col(group).isin(groups)) if groups is not None else \
        base.where(F.col(group).isNotNull())
    parts = [group, label]
    x, offs = rank_buckets(base, parts, key, seed, prefix)
    offs = materialize(offs, "sample-offsets")      # read three times: totals, quotas, ranks
    # quotas from the small offsets table: one row per (group, label)
    tot = offs.groupBy(*parts).agg(F.sum(_N).alias("__tot"))
    cap = F.col("__tot") if max_positive is None else F.least(F.col("__tot"), F.lit(max_positive))
    kept_pos = tot.where(F.col(label) == 1).select(group, cap.alias("__kp"))
    quota = (tot.join(kept_pos, group, "left")
             .select(*parts, F.when(F.col(label) == 1, F.col("__kp"))
                     .otherwise(F.least(F.col("__tot"),
                                        F.lit(negative_ratio) * F.coalesce("__kp", F.lit(0))))
                     .alias("__quota")))
    offs = join_null_safe(offs, quota, parts).where(F.col(_OFF) < F.col("__quota"))
    out = rank_finish(x, offs, parts, key, "rn")
    return out.where(F.col("rn") <= F.col("__quota")).drop("__quota")


def chunk_ids(df: DataFrame, key: str = "key", chunk_size: int = DATA_CHUNK_SIZE,
              out: str = "chunk_id") -> DataFrame:
    """Chunk of each row when the table is read in key order, ``chunk_size`` rows
    at a time (0-based); also keeps the 1-based position ``pos``."""
    return (key_position(df, key, "pos")
            .withColumn(out, F.floor((F.col("pos") - 1) / F.lit(chunk_size)).cast("bigint")))


def chunk_sample(df: DataFrame, label: str = "label", key: str = "key",
                 chunk_size: int = DATA_CHUNK_SIZE, negative_ratio: int = NEGATIVE_RATIO,
                 seed: int = RANDOM_SEED, negatives: str = "not_positive") -> DataFrame:
    """Inside each chunk keep every positive and ``ratio * positives of
    the chunk`` negatives (all of them when fewer); a chunk without positives
    keeps no negatives. Groups are pooled.

    ``negatives='not_positive'`` treats every row with label != 1 (null too) as
    negative, like the chunk loader; ``'zero'`` keeps only ``label == 0``, like
    the validator. Output: input columns plus ``pos``, ``chunk_id``, ``is_pos``.
    """
    is_pos = F.coalesce(F.col(label) == 1, F.lit(False))
    x = chunk_ids(df, key, chunk_size).withColumn("is_pos", is_pos)
    if negatives == "zero":
        x = x.where(F.col("is_pos") | (F.col(label) == 0))
    # a chunk has chunk_size rows at most: plain windows, and one shuffle serves both
    n_pos = F.count(F.when(F.col("is_pos"), 1)).over(Window.partitionBy("chunk_id"))
    rank = F.row_number().over(Window.partitionBy("chunk_id", "is_pos").orderBy(keyhash(key, seed), key))
    x = x.withColumn("__np", n_pos).withColumn("__rn", rank)
    return x.where(F.col("is_pos") | (F.col("__rn") <= negative_ratio * F.col("__np"))).drop("__np", "__rn")


def window_positive_cap(sampled: DataFrame, group: str = "grp", key: str = "key",
                        max_per_group: int = MAX_POSITIVE_SAMPLES,
                        merge_interval: int = MERGE_INTERVAL, seed: int = RANDOM_SEED,
                        groups: list[str] | None = None) -> DataFrame:
    """Positives are capped per group inside each merge window of
    ``merge_interval`` chunks; negatives pass. With ``groups``, rows of other
    groups are dropped from both classes (the reference keeps their negatives).
    Output adds ``window_id``."""
    x = sampled.withColumn("window_id", F.floor(F.col("chunk_id") / F.lit(merge_interval))
                           .cast("bigint"))
    if groups is not None:
        x = x.where(F.col(group).isin(groups))
    # a window has merge_interval chunks' rows at most: a plain window inside it
    rank = F.row_number().over(Window.partitionBy("window_id", group, "is_pos").orderBy(keyhash(key, seed), key))
    x = x.withColumn("__rn", F.when(F.col("is_pos"), rank).otherwise(0))
    return x.where(F.col("__rn") <= max_per_group).drop("__rn")


def early_stop_windows(capped: DataFrame, max_total: int = MAX_TOTAL_SAMPLES) -> DataFrame:
    """The scan stops at the first merge window after which the kept total
    reaches ``max_total``: keep windows whose *preceding* total is below it.
    The running sum runs over the small per-window count table."""
    per_win = capped.groupBy("window_id").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("window_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keep = (per_win.withColumn("__before", F.sum("__n").over(w) - F.col("__n"))
            .where(F.col("__before") < F.lit(max_total)).select("window_id"))
    return capped.join(keep, "window_id", "left_semi")


def shuffled_order(df: DataFrame, key: str = "key", seed: int = RANDOM_SEED,
                   out: str = "shuffle_pos") -> DataFrame:
    """The position of each row after a seeded full shuffle, as a column
    (a DataFrame has no order; sinks sort by it)."""
    return random_rank(df, [], key, seed, out)


def truncate_to_cap(df: DataFrame, max_total: int = MAX_TOTAL_SAMPLES, key: str = "key",
                    seed: int = RANDOM_SEED) -> DataFrame:
    """Keep the first ``max_total`` rows of the seeded shuffle. Uses the
    pruned two-level rank instead of a driver-side top-k merge."""
    r = random_rank(df, [], key, seed, "shuffle_pos", limit=max_total)
    return r.where(F.col("shuffle_pos") <= max_total)


def prefix_batches(df: DataFrame, n_rows: int, batch_size: int, key: str = "key") -> DataFrame:
    """Read whole batches of ``batch_size`` rows in key order until at least
    ``n_rows`` are read: the first ``ceil(n/batch) * batch`` rows."""
    n_keep = -(-n_rows // batch_size) * batch_size
    x = key_position(df, key, "pos", limit=n_keep)
    return x.where(F.col("pos") <= n_keep)


def chunked_sample(df: DataFrame, group: str = "grp", label: str = "label", key: str = "key",
                   negative_ratio: int = NEGATIVE_RATIO,
                   max_positive_per_group: int = MAX_POSITIVE_SAMPLES,
                   max_total: int = MAX_TOTAL_SAMPLES, chunk_size: int = DATA_CHUNK_SIZE,
                   merge_interval: int = MERGE_INTERVAL, seed: int = RANDOM_SEED,
                   groups: list[str] | None = None) -> DataFrame:
    """The chunked loader: W2 -> W3 -> W4 -> W6. Each stage reads its input
    twice (counts, then ranks), so stage outputs (already reduced by sampling)
    are written to the shared folder instead of recomputed. Pass the narrow
    (key, group, label) projection and fetch wide columns by key afterwards."""
    s = chunk_sample(df, label, key, chunk_size, negative_ratio, seed)
    s = materialize(window_positive_cap(s, group, key, max_positive_per_group, merge_interval,
                                        seed, groups), "window-capped")
    s = materialize(early_stop_windows(s, max_total), "early-stopped")
    return truncate_to_cap(s, max_total, key, seed)
