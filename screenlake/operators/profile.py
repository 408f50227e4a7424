"""Profiles and guards of labelled tables.

All are single-pass aggregates with map-side partial aggregation; grouped and
overall levels come from one ROLLUP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.functions.scores import is_missing

MIN_POSITIVES = 50


def _label_aggs(label: str):
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint")
    return [F.count(F.lit(1)).cast("bigint").alias("n_rows"), pos.alias("n_pos")]


def _finish(df: DataFrame, *keep: str) -> DataFrame:
    neg = (F.col("n_rows") - F.col("n_pos")).cast("bigint")
    pct = F.try_divide(F.lit(100.0) * F.col("n_pos").cast("double"), F.col("n_rows").cast("double"))
    ratio = F.when(F.col("n_pos") > 0, neg.cast("double") / F.col("n_pos").cast("double")) \
        .otherwise(F.lit(float("inf")))
    return df.select(*keep, "n_rows", "n_pos", neg.alias("n_neg"), pct.alias("pct_pos"),
                     ratio.alias("neg_per_pos"))


def label_profile(df: DataFrame, label: str = "label") -> DataFrame:
    """A1: rows, positives (label == 1), the rest, percent positive and the
    1:x ratio (infinite without positives)."""
    return _finish(df.agg(*_label_aggs(label)))


def group_label_profile(df: DataFrame, group: str = "grp", label: str = "label") -> DataFrame:
    """A2: A1 per group (groups without rows simply do not appear)."""
    return _finish(df.groupBy(group).agg(*_label_aggs(label)), group)


def profile_rollup(df: DataFrame, group: str = "grp", label: str = "label") -> DataFrame:
    """A3: overall and per-group profile in one pass; ``level`` is 1 for the total."""
    r = df.rollup(group).agg(*_label_aggs(label), F.grouping(group).alias("level"))
    return _finish(r.withColumn("level", F.col("level").cast("int")), group, "level")


def cardinality_ratio(df: DataFrame, cols: list[str], exact: bool = True,
                      threshold: float = 0.5) -> DataFrame:
    """A5/T3 decision: distinct count / rows per column and whether it is below
    ``threshold`` (then dictionary encoding pays). ``exact=False`` uses HLL."""
    cnt = F.count_distinct if exact else F.approx_count_distinct
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[cnt(c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', cast(`{c}` as bigint)" for c in cols)
    long = row.selectExpr("__n", f"stack({len(cols)}, {stack}) as (column_name, n_distinct)")
    ratio = F.col("n_distinct").cast("double") / F.greatest(F.col("__n"), F.lit(1)).cast("double")
    return long.select("column_name", F.col("__n").cast("bigint").alias("n_rows"),
                       F.col("n_distinct").cast("bigint"), ratio.alias("ratio"),
                       (ratio < F.lit(threshold)).alias("encode"))


def split_label(df: DataFrame, label: str = "label") -> DataFrame:
    """F2/F3 in one pass: rows with label == 1, with ``not (label == 1)`` (chunk
    loader, null counts as negative) and with label == 0 (sampler)."""
    is1 = F.coalesce(F.col(label) == 1, F.lit(False))
    return df.agg(
        F.sum(F.when(is1, 1).otherwise(0)).cast("bigint").alias("n_pos"),
        F.sum(F.when(~is1, 1).otherwise(0)).cast("bigint").alias("n_rest"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("bigint").alias("n_zero"))


def known_groups(df: DataFrame, groups: list[str], group: str = "grp") -> DataFrame:
    """rows of configured groups only, as a semi join to the (driver-given,
    hence size-bounded) group dimension, broadcast."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(g,) for g in groups], f"{group} string")
    return df.join(F.broadcast(dim), group, "left_semi")


def require_min_positives(df: DataFrame, label: str = "label",
                          minimum: int = MIN_POSITIVES) -> int:
    """stop when there are fewer than ``minimum`` positives (one scalar to the driver)."""
    n = df.where(F.col(label) == 1).count()
    if n < minimum:
        raise ValueError(f"only {n} positives, need at least {minimum}")
    return n


def min_positives_check(df: DataFrame, label: str = "label", minimum: int = MIN_POSITIVES) -> DataFrame:
    """F10 as a table: the count and the verdict."""
    return df.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("n_pos")) \
        .withColumn("ok", F.col("n_pos") >= F.lit(minimum))


def coverage(df: DataFrame, score: str, by: list[str] | None = None) -> DataFrame:
    """Rows with a usable score, rows without, total."""
    miss = is_missing(score)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_total"),
        F.sum(F.when(miss, 0).otherwise(1)).cast("bigint").alias("n_valid"),
        F.sum(F.when(miss, 1).otherwise(0)).cast("bigint").alias("n_missing"))


def running_totals(sampled_chunks: DataFrame, scanned_chunks: DataFrame,
                   label: str = "label") -> DataFrame:
    """Per chunk the rows scanned, positives found and rows kept, with
    running totals. The window runs over the small per-chunk table."""
    scanned = scanned_chunks.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("rows_scanned"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos_found"))
    kept = sampled_chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows_kept"))
    t = scanned.join(kept, "chunk_id", "left").fillna(0, ["rows_kept"])
    w = Window.orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.select("chunk_id", *[F.col(c).cast("bigint") for c in
                                  ("rows_scanned", "pos_found", "rows_kept")],
                    *[F.sum(c).over(w).cast("bigint").alias(f"total_{c}") for c in
                      ("rows_scanned", "pos_found", "rows_kept")])


def invalid_text_rate(df: DataFrame, text: str = "text", by: list[str] | None = None) -> DataFrame:
    """Texts that cannot be featurized (null, blank, or with unbalanced
    brackets / parentheses, the structural part of a line-notation parse)."""
    from screenlake.operators.features import text_is_valid
    bad = ~text_is_valid(text)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias("n_invalid")) \
        .withColumn("pct_invalid", F.try_divide(F.lit(100.0) * F.col("n_invalid").cast("double"),
                                                F.col("n_rows").cast("double")))
