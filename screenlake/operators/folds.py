"""Fold assignment (W7, X1, J6) and a group-disjoint variant.

Folds are a column, not index lists: ``fold = (rank in stratum - 1) % k`` with
the two-level md5 rank, so every (group, label) stratum is spread over the k
folds with sizes differing by at most one, reproducibly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.functions.hashing import keyhash
from screenlake.operators.rank import random_rank

N_FOLDS = 5


def stratum_key(group: str, label: str) -> Column:
    """The composite stratum label ``<group>_<label>``."""
    return F.concat_ws("_", F.col(group).cast("string"), F.col(label).cast("string"))


def stratified_folds(df: DataFrame, group: str = "grp", label: str = "label", key: str = "key",
                     n_folds: int = N_FOLDS, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified K-fold over the ``group_label`` strata (any label values,
    nulls form their own stratum)."""
    r = random_rank(df, [group, label], key, seed, "__rn")
    return r.withColumn(out, ((F.col("__rn") - 1) % F.lit(n_folds)).cast("int")).drop("__rn")


def group_disjoint_folds(df: DataFrame, group_key: str, n_folds: int = N_FOLDS, seed: int = 42,
                         out: str = "fold") -> DataFrame:
    """All rows sharing ``group_key`` land in one fold (no straddling), so a model
    is validated on entities it never saw. A pure projection: no shuffle."""
    h = F.conv(F.substring(keyhash(group_key, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out, F.pmod(h, F.lit(n_folds)).cast("int"))


def split_fold(df: DataFrame, k: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train, valid) rows for fold ``k``."""
    return df.where(F.col(fold) != k), df.where(F.col(fold) == k)


def fold_split_counts(folded: DataFrame, label: str = "label", fold: str = "fold") -> DataFrame:
    """Per fold and label, rows in the validation part and in the training
    part (total minus validation), from one aggregate."""
    per = folded.groupBy(fold, label).agg(F.count(F.lit(1)).alias("n_valid"))
    tot = folded.groupBy(label).agg(F.count(F.lit(1)).alias("__tot"))
    return (per.join(tot, label, "inner")
            .select(fold, label, F.col("n_valid").cast("bigint"),
                    (F.col("__tot") - F.col("n_valid")).cast("bigint").alias("n_train")))
