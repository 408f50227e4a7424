"""Out-of-fold collection, model averaging, blending and the keyed submission
join (A15-A17, J1, J2, F6, F11, F12).

The reference aligns predictions by array position; here every prediction is
carried with its key and joined, so row order never matters and a missing or
extra key is detected instead of silently shifting values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.functions.scores import clip_score, is_missing
from screenlake.operators import metrics as M


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union-all by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def stack_scores(df: DataFrame, key: str, cols: list[str], model: str = "model",
                 score: str = "score") -> DataFrame:
    """Wide model columns -> long ``(key, model, score)`` (a projection, no shuffle)."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    return df.selectExpr(f"`{key}`", f"stack({len(cols)}, {pairs}) as (`{model}`, `{score}`)")


def ensemble_mean(long: DataFrame, key: str = "key", score: str = "score",
                  out: str = "ensemble") -> DataFrame:
    """Mean over the K models of each row; long input ``(key, model, score)``.
    Partial aggregation keeps the shuffle at one row per key and map task."""
    return long.groupBy(key).agg(F.avg(score).alias(out),
                                 F.count(score).cast("bigint").alias("n_models"))


def row_mean(cols: list[str]):
    """A16 for wide input: the mean as a projection."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols]) / F.lit(float(len(cols)))


def weighted_blend(long: DataFrame, weights: dict[str, float] | None, key: str = "key",
                   model: str = "model", score: str = "score", out: str = "blend") -> DataFrame:
    """``sum(w * p) / sum(w)`` per key over the models with a score for it (equal
    weights when None); models without a weight are left out. The weight table has one row per model (driver-given), so it is
    broadcast."""
    spark = long.sparkSession
    if weights is None:
        models = [r[0] for r in long.select(model).distinct().collect()]
        weights = {m: 1.0 for m in models}
    total = float(sum(weights.values()))
    wt = spark.createDataFrame([(m, float(w) / total) for m, w in weights.items()],
                               f"`{model}` string, __w double")
    j = long.join(F.broadcast(wt), model)
    return j.groupBy(key).agg((F.sum(F.when(F.col(score).isNotNull(), F.col("__w") * F.col(score)))
                                  / F.sum(F.when(F.col(score).isNotNull(), F.col("__w")))).alias(out))


def attach_oof(table: DataFrame, fold_predictions: list[DataFrame] | DataFrame,
               key: str = "key", pred: str = "pred", out: str = "oof_pred",
               clip: bool = True) -> DataFrame:
    """Out-of-fold predictions (one DataFrame per fold, or already unioned)
    joined back onto the table by key; rows no fold scored get null."""
    preds = union_all(fold_predictions) if isinstance(fold_predictions, list) else fold_predictions
    preds = preds.select(key, F.col(pred).alias(out))
    j = table.join(preds, key, "left")
    return j.withColumn(out, clip_score(out)) if clip else j


def oof_group_auc(oof: DataFrame, group: str = "grp", label: str = "label",
                  pred: str = "oof_pred", groups: list[str] | None = None) -> DataFrame:
    """Drop missing predictions (F6), per-group AUC (A6) and macro mean
    as a long ``(metric, value)`` table."""
    valid = oof.where(~is_missing(pred))
    per = M.group_auc(valid, group, label, pred, groups=groups)
    return M.metrics_long(per, group, "auc")


def template_key_check(template: DataFrame, preds: DataFrame, key: str = "id") -> DataFrame:
    """template ids without a prediction, predicted ids outside the
    template, and predicted ids that occur more than once; one row of counts."""
    t = template.select(key).distinct()
    p = preds.groupBy(key).agg(F.count(F.lit(1)).alias("__c"))
    j = t.withColumn("__t", F.lit(1)).join(p, key, "full_outer")
    return j.agg(
        F.sum(F.when(F.col("__t").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_template"),
        F.sum(F.coalesce("__c", F.lit(0))).cast("bigint").alias("n_predictions"),
        F.sum(F.when(F.col("__c").isNull(), 1).otherwise(0)).cast("bigint").alias("n_missing"),
        F.sum(F.when(F.col("__t").isNull(), 1).otherwise(0)).cast("bigint").alias("n_extra"),
        F.sum(F.when(F.col("__c") > 1, 1).otherwise(0)).cast("bigint").alias("n_duplicate"))


def create_submission(template: DataFrame, preds: DataFrame, key: str = "id",
                      pred: str = "pred", out: str = "binds", strict: bool = True) -> DataFrame:
    """Predictions onto the template by key, clipped, typed like the
    template (float). With ``strict`` the key sets must agree exactly
    (one small aggregate decides, as the reference's row-count guard does)."""
    if strict:
        c = template_key_check(template, preds, key).first()
        if c["n_missing"] or c["n_extra"] or c["n_duplicate"]:
            raise ValueError(f"template/prediction keys disagree: {c.asDict()}")
    p = preds.select(key, clip_score(pred).alias("__p"))
    return (template.select(key).join(p, key, "left")
            .select(key, F.col("__p").cast("float").alias(out)))
