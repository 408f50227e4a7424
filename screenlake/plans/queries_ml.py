"""Registered model queries (rows-only checks: model fits are iterative and
have no SQL twin). They train on the labelled documents of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.operators import ensemble as E
from screenlake.operators import folds as FO
from screenlake.operators import metrics as M
from screenlake.operators import train as T
from screenlake.plans import views as V
from screenlake.plans.catalog import register
from screenlake.plans.screen import (SMALL_TRAINER, ScreenConfig, materialize, run_screen,
                                     small_validation, write_template)
from screenlake.session import shared_dir

N_FOLDS = 5
# The whole presets (1000 rounds, with patience) run in the three queries that fit and score one
# model, some two minutes each on a thousand documents; README gives the times of the others.
FULL_TRAINER = T.TrainerConfig()
ALT_TRAINER = T.TrainerConfig("deep")


def _features(spark, sf):
    # the features read these rows several times: rank them once
    d = materialize(FO.stratified_folds(V.docs(spark, sf), n_folds=N_FOLDS), "docs-folds")
    f = T.ml_features(d, V.DOC_GROUPS).select("key", "grp", "label", "fold", "features")
    return materialize(f, "docs-features", sort_within=["key"])


def _fit0(spark, sf, cfg=SMALL_TRAINER):
    f = _features(spark, sf)
    tr, va = FO.split_fold(f, 0)
    return T.fit(tr, cfg, va), va


@register("gbt_train_score")
def q_gbt_train_score(spark, sf):
    m, va = _fit0(spark, sf, FULL_TRAINER)
    return T.predict_proba(m, va).select("key", "grp", "label", "pred")


@register("learning_curve")
def q_learning_curve(spark, sf):
    m, va = _fit0(spark, sf, FULL_TRAINER)
    return T.learning_curve(m, va, FULL_TRAINER)


@register("feature_importance")
def q_feature_importance(spark, sf):
    m, _ = _fit0(spark, sf)
    return T.feature_importance(m, T.model_names(512, V.DOC_GROUPS), k=20, spark=spark)


@register("alt_trainer")
def q_alt_trainer(spark, sf):
    m, va = _fit0(spark, sf, ALT_TRAINER)
    return T.predict_proba(m, va).select("key", "grp", "label", "pred")


@register("param_search")
def q_param_search(spark, sf):
    f = _features(spark, sf)
    tr, va = FO.split_fold(f, 0)
    return T.param_search(tr, va, SMALL_TRAINER, n_trials=3, max_iter=5, parallelism=3)


@register("cv_oof")
def q_cv_oof(spark, sf):
    f = _features(spark, sf)
    _, preds = T.cross_validate(f, SMALL_TRAINER, N_FOLDS, parallelism=N_FOLDS)
    return E.attach_oof(f.select("key", "grp", "label", "fold"), preds.select("key", "pred"))


@register("cv_fold_metrics")
def q_cv_fold_metrics(spark, sf):
    oof = q_cv_oof(spark, sf)
    per = M.group_auc(oof, ["fold", "grp"], "label", "oof_pred")
    return M.cv_summary(M.metrics_long(per, "grp", "auc", by="fold"))


@register("ensemble_score")
def q_ensemble_score(spark, sf):
    f = _features(spark, sf)
    models, _ = T.cross_validate(f, SMALL_TRAINER, N_FOLDS, parallelism=N_FOLDS)
    u = V.unlabelled(spark, sf)
    test = T.ml_features(u, V.DOC_GROUPS).select("key", "features")
    # the strict key check reads the scores too: score once
    ens = materialize(E.ensemble_mean(T.ensemble_scores(models, test)), "ensemble")
    tmpl = write_template(spark, u)
    return E.create_submission(tmpl, ens.select(F.col("key").cast("bigint").alias("id"),
                                                F.col("ensemble").alias("pred")), "id", "pred")


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    m, va = _fit0(spark, sf)
    path = T.save_model(m, shared_dir(spark, "model-fold0"))
    again = T.load_model(path)
    a = T.predict_proba(m, va).select("key", "pred")
    b = T.predict_proba(again, va).select("key", F.col("pred").alias("pred_loaded"))
    return a.join(b, "key").withColumn("same", F.col("pred") == F.col("pred_loaded"))


@register("run_screen")
def q_run_screen(spark, sf):
    cfg = ScreenConfig(n_folds=N_FOLDS, trainer=SMALL_TRAINER, negative_ratio=5, max_positive=None, parallelism=N_FOLDS)
    u = V.unlabelled(spark, sf)
    out = run_screen(V.docs(spark, sf), u, cfg, write_template(spark, u))
    return out["oof_auc"]


@register("small_validation")
def q_small_validation(spark, sf):
    # batches of 100 documents in key order over the whole labelled table
    return small_validation(V.docs(spark, sf), V.DOC_GROUPS, n_rows=2_000_000, batch_size=100,
                          negative_ratio=20, n_folds=N_FOLDS, trainer=SMALL_TRAINER)


@register("quick_screen")
def q_quick_screen(spark, sf):
    # quick mode: labelled rows as header CSV read back with declared types,
    # no sampling, its first 50 rows (by key) as the mock test set (smoke only:
    # those rows were also trained on), submission built from the test keys
    from screenlake.sources import files as SF
    d = V.docs(spark, sf).select("key", "grp", "label", "text")
    path = SF.write_csv(d, shared_dir(spark, "quick-csv"), one_line=True)
    schema = "key BIGINT, grp STRING, label TINYINT, text STRING"
    train = SF.read_small_csv(spark, path, schema, one_line=True)
    test = SF.read_small_csv(spark, path, schema, first_n=50, order_by="key", one_line=True).drop("label")
    cfg = ScreenConfig(n_folds=N_FOLDS, trainer=SMALL_TRAINER, sample=False, parallelism=N_FOLDS)
    return run_screen(train, test, cfg)["submission"]


@register("run_screen_options")
def q_run_screen_options(spark, sf):
    # the chunked loader, both fingerprints, label codes, a search whose best parameters
    # serve all folds, models saved per fold and scored from the files
    cfg = ScreenConfig(n_folds=N_FOLDS, trainer=SMALL_TRAINER, loader="chunked", max_positive=None, chunk_size=100,
                       fingerprint="both", encoding="label", n_trials=3, trial_rounds=8, parallelism=N_FOLDS,
                       model_dir=shared_dir(spark, "screen-models"))
    u = V.unlabelled(spark, sf)
    return run_screen(V.docs(spark, sf), u, cfg, write_template(spark, u))["submission"]
