"""Exact ranking metrics per group: ROC-AUC (mid-ranks for ties), average
precision, threshold metrics, macro means and cross-validation summaries.

Scale plan. Nothing here windows over raw rows of a group (a group can be a
third of the table). Rows are first collapsed map-side to
``(group, score) -> (pos, neg)``; cumulative counts along the score order come
from ranges of bounded size whose borders are sampled from the collapsed scores
(``ordering.cumulate``), so scores crowded near zero share no range. The AUC
numerator is an exact integer, so the only rounding is one final division;
no operator rounds its result.

Missing scores (null / NaN) and labels other than 0/1 are left out, as the
reference drops missing predictions before scoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenlake.functions.scores import is_missing, threshold_class
from screenlake.operators.ordering import ROWS_PER_RANGE, cumulate
from screenlake.session import materialize


def _as_list(g) -> list[str]:
    if g is None:
        return []
    return [g] if isinstance(g, str) else list(g)


def score_counts(df: DataFrame, group, label: str, score: str) -> DataFrame:
    """``(group..., score, pos, neg)``: one row per distinct score per group."""
    gs = _as_list(group)
    clean = df.where(F.col(label).isin(0, 1) & ~is_missing(score))
    for g in gs:
        clean = clean.where(F.col(g).isNotNull())
    return clean.groupBy(*gs, score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("bigint").alias("neg"))


def _group_dim(spark: SparkSession, group: str, groups: list[str]) -> DataFrame:
    # A driver-supplied list: its size is known, so broadcasting it is safe.
    rows = [(g, i) for i, g in enumerate(groups)]
    return F.broadcast(spark.createDataFrame(rows, f"{group} string, group_idx int"))


def group_auc(df: DataFrame, group="grp", label: str = "label", score: str = "score",
              groups: list[str] | None = None,
              limit: int = ROWS_PER_RANGE) -> DataFrame:
    """Exact ROC-AUC per group, ties counted as one half.

    ``AUC = sum_s pos(s) * (neg_below(s) + neg(s)/2) / (n_pos * n_neg)``; null
    when a group has one class only. With ``groups`` every configured group
    gets a row, absent ones with zero counts and a null AUC.

    Output: ``group..., n_pos, n_neg, auc``.
    """
    gs = _as_list(group)
    # the collapsed counts feed two branches (bucket totals, per-score ranks):
    # write them once so the input (often model scoring) is evaluated once
    cnt = materialize(score_counts(df, gs, label, score), "score-counts")
    cum = cumulate(cnt, gs, score, ["neg"], limit=limit)
    per = cum.groupBy(*gs).agg(
        F.sum("pos").cast("bigint").alias("n_pos"),
        F.sum("neg").cast("bigint").alias("n_neg"),
        # 2 * numerator, exact: pos * (2 * neg_below + neg) outgrows 64 bits at billions of rows
        F.sum((F.col("pos").cast("decimal(19,0)")
               * (2 * (F.col("cum_neg") - F.col("neg")) + F.col("neg")).cast("decimal(19,0)")).cast("decimal(38,0)"))
        .alias("__num2"))
    if groups is not None:
        assert len(gs) == 1, "a configured group list needs one group column"
        dim = _group_dim(df.sparkSession, gs[0], groups)
        per = (dim.join(per, gs[0], "left")
               .select(gs[0], F.coalesce("n_pos", F.lit(0)).cast("bigint").alias("n_pos"),
                       F.coalesce("n_neg", F.lit(0)).cast("bigint").alias("n_neg"), "__num2"))
    denom = F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * F.lit(2.0)
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("__num2").cast("double") / denom)
    return per.select(*gs, "n_pos", "n_neg", auc.alias("auc"))


def macro_mean(per_group: DataFrame, value: str = "auc", by=None,
               out: str = "mean_auc") -> DataFrame:
    """Mean over groups of a per-group metric, skipping null (NaN never enters)."""
    bs = _as_list(by)
    return per_group.groupBy(*bs).agg(
        F.avg(value).alias(out),
        F.count(value).cast("bigint").alias("n_groups"))


def average_precision(df: DataFrame, group="grp", label: str = "label",
                      score: str = "score", limit: int = ROWS_PER_RANGE) -> DataFrame:
    """Average precision, step form over distinct thresholds (descending):
    ``sum_s pos(s)/n_pos * cum_pos(s)/cum_n(s)``. Null without positives."""
    gs = _as_list(group)
    cnt = materialize(score_counts(df, gs, label, score), "score-counts") \
        .withColumn("n", F.col("pos") + F.col("neg"))
    cum = cumulate(cnt, gs, score, ["pos", "n"], descending=True, limit=limit)
    term = F.col("pos").cast("double") * F.col("cum_pos").cast("double") / F.col("cum_n").cast("double")
    per = cum.groupBy(*gs).agg(F.sum("pos").cast("bigint").alias("n_pos"),
                               F.sum("n").cast("bigint").alias("n_rows"),
                               F.sum(term).alias("__s"))
    ap = F.when(F.col("n_pos") > 0, F.col("__s") / F.col("n_pos"))
    return per.select(*gs, "n_pos", "n_rows", ap.alias("average_precision"))


def threshold_metrics(df: DataFrame, group="grp", label: str = "label", score: str = "score",
                      threshold: float = 0.5, overall: bool = True) -> DataFrame:
    """Precision, recall and F1 of ``score >= threshold``; 0 on zero division.

    With ``overall`` a pooled row (group = ``'__all__'``) is added via ROLLUP,
    so both levels come from one pass.
    """
    gs = _as_list(group)
    assert len(gs) == 1
    g = gs[0]
    pred = threshold_class(score, threshold)
    y = F.col(label)
    base = df.where(y.isin(0, 1) & ~is_missing(score))
    aggs = [F.sum(F.when((pred == 1) & (y == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
            F.sum(F.when((pred == 1) & (y == 0), 1).otherwise(0)).cast("bigint").alias("fp"),
            F.sum(F.when((pred == 0) & (y == 1), 1).otherwise(0)).cast("bigint").alias("fn"),
            F.sum(F.when((pred == 0) & (y == 0), 1).otherwise(0)).cast("bigint").alias("tn")]
    if overall:
        agg = (base.rollup(g).agg(*aggs, F.grouping(g).alias("__gi"))
               .withColumn(g, F.when(F.col("__gi") == 1, F.lit("__all__")).otherwise(F.col(g)))
               .drop("__gi"))
    else:
        agg = base.groupBy(g).agg(*aggs)

    def ratio(num, den):
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return agg.select(g, "tp", "fp", "fn", "tn",
                      ratio(tp, tp + fp).alias("precision"),
                      ratio(tp, tp + fn).alias("recall"),
                      ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def metrics_long(per_group: DataFrame, group: str = "grp", value: str = "auc",
                 by=None, suffix: str = "_auc", mean_name: str = "mean_auc") -> DataFrame:
    """``(by..., metric, value)``: ``<group><suffix>`` rows plus the macro mean."""
    bs = _as_list(by)
    per = per_group.select(*bs, F.concat(F.col(group), F.lit(suffix)).alias("metric"),
                           F.col(value).alias("value"))
    mean = macro_mean(per_group, value, bs, "value").select(*bs, F.lit(mean_name).alias("metric"),
                                                             "value")
    return per.unionByName(mean)


def cv_summary(fold_metrics: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Mean / population std / min / max of each metric over folds, NaN and
    null skipped; a metric with no value anywhere gets nulls."""
    v = F.when(F.isnan(value), None).otherwise(F.col(value))
    return (fold_metrics.withColumn("__v", v).groupBy(metric).agg(
        F.avg("__v").alias("mean"),
        F.stddev_pop("__v").alias("std"),
        F.min("__v").alias("min"),
        F.max("__v").alias("max"),
        F.count("__v").cast("bigint").alias("n_folds")))


def score_stats(df: DataFrame, by="model", score: str = "score") -> DataFrame:
    """Min / max / mean of scores per model (NaN/null skipped)."""
    bs = _as_list(by)
    v = F.when(F.isnan(score), None).otherwise(F.col(score))
    return (df.withColumn("__v", v).groupBy(*bs).agg(
        F.count("__v").cast("bigint").alias("n"),
        F.min("__v").alias("min_score"),
        F.max("__v").alias("max_score"),
        F.avg("__v").alias("mean_score")))
