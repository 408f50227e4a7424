"""ML9: the whole screening run as one Spark job graph, and the flagship query.

load -> stratified sample (W1) -> featurize distinct texts -> write the
feature table to the shared folder (cuts lineage before the k fits) ->
stratified folds (W7) -> per-fold GBT fit / score (ML7) -> out-of-fold attach
(J1) -> per-group AUC per fold and CV summary (A6-A8) -> OOF AUC (A15) ->
k-model ensemble on the unlabelled rows (ML8, A16) -> clipped submission
joined to the template by key (J2, F11).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.operators import ensemble as E
from screenlake.operators import folds as FO
from screenlake.operators import metrics as M
from screenlake.operators import sampling as S
from screenlake.operators import train as T
from screenlake.plans import views as V
from screenlake.session import materialize, shared_dir
from screenlake.sources import files as SF


@dataclass
class ScreenConfig:
    groups: list[str] = field(default_factory=lambda: list(V.DOC_GROUPS))
    negative_ratio: int = S.NEGATIVE_RATIO
    max_positive: int | None = S.MAX_POSITIVE_SAMPLES
    n_folds: int = 5
    nbits: int = 512
    seed: int = 42
    trainer: T.TrainerConfig = field(default_factory=T.TrainerConfig)
    sample: bool = True
    loader: str = "stratified"          # or "chunked": W2 -> W3 -> W4 -> W6 in key order
    max_total: int = S.MAX_TOTAL_SAMPLES
    chunk_size: int = S.DATA_CHUNK_SIZE
    fingerprint: str = "morgan"         # or "maccs", "both"
    descriptors: bool = True
    encoding: str = "onehot"            # or "label"
    n_trials: int = 0                   # of the parameter search on the first fold; 0: none
    trial_rounds: int = 100
    search_budget: float | None = None  # seconds
    model_dir: str | None = None        # models are saved there, one a fold, and scored from the files
    run_name: str = "run"
    parallelism: int = 1


def load_sample(labelled: DataFrame, cfg: ScreenConfig) -> DataFrame:
    """The training rows by the loader the run names. The chunked one works on the narrow
    columns; the texts of the rows it keeps are joined afterwards."""
    if not cfg.sample:
        return labelled
    if cfg.loader == "stratified":
        return S.stratified_sample(labelled, "grp", "label", "key", cfg.negative_ratio,
                                   cfg.max_positive, cfg.seed, cfg.groups).drop("rn")
    if cfg.loader != "chunked":
        raise ValueError(f"unsupported loader: {cfg.loader}")
    cap = cfg.max_positive if cfg.max_positive is not None else S.MAX_POSITIVE_SAMPLES
    kept = S.chunked_sample(labelled.select("key", "grp", "label"), negative_ratio=cfg.negative_ratio,
                            max_positive_per_group=cap, max_total=cfg.max_total, chunk_size=cfg.chunk_size,
                            seed=cfg.seed, groups=cfg.groups)
    return labelled.join(kept.select("key"), "key", "left_semi")


def run_screen(labelled: DataFrame, unlabelled: DataFrame, cfg: ScreenConfig,
               template: DataFrame | None = None) -> dict[str, DataFrame]:
    """Labelled rows need (key, grp, label, text); unlabelled rows (key, grp, text).
    Returns DataFrames: oof, fold_metrics, cv_summary, oof_auc, ensemble, submission."""
    spark = labelled.sparkSession
    def features(rows):
        return T.ml_features(rows, cfg.groups, nbits=cfg.nbits, fingerprint=cfg.fingerprint,
                             descriptors=cfg.descriptors, encoding=cfg.encoding)
    # the features read the sample several times: draw it once
    data = materialize(FO.stratified_folds(load_sample(labelled, cfg), "grp", "label", "key", cfg.n_folds, cfg.seed), "sample-folds")
    feats = materialize(features(data)
                        .select("key", "grp", "label", "fold", "features"), "train-features",
                        sort_within=["key"])
    trainer, trials = cfg.trainer, None
    if cfg.n_trials:
        train, valid = FO.split_fold(feats, 0)
        trials = T.param_search(train, valid, trainer, cfg.n_trials, cfg.trial_rounds, parallelism=cfg.parallelism,
                                results=f"{cfg.model_dir}/{cfg.run_name}-trials" if cfg.model_dir else None, budget=cfg.search_budget)
        trainer = T.with_best(trainer, trials)
    models, preds = T.cross_validate(feats, trainer, cfg.n_folds, parallelism=cfg.parallelism)
    if cfg.model_dir:
        models = [T.load_model(T.save_model(m, f"{cfg.model_dir}/{cfg.run_name}-fold{k}")) for k, m in enumerate(models)]
    # k model scorings feed several metrics: score once, keep the file
    oof = materialize(E.attach_oof(feats.select("key", "grp", "label", "fold"),
                                   preds.select("key", "pred")), "oof")
    per_fold = M.group_auc(oof, ["fold", "grp"], "label", "oof_pred")
    fold_metrics = M.metrics_long(per_fold, "grp", "auc", by="fold")
    test = materialize(features(unlabelled).select("key", "features"), "test-features")
    ens = materialize(E.ensemble_mean(T.ensemble_scores(models, test)), "ensemble")
    if template is None:     # keys keep their own type (no narrowing cast that could overflow)
        template = unlabelled.select(F.col("key").alias("id")).distinct()
    sub = E.create_submission(template, ens.select(F.col("key").alias("id"),
                                                   F.col("ensemble").alias("pred")), "id", "pred")
    return {"oof": oof, "fold_metrics": fold_metrics, "cv_summary": M.cv_summary(fold_metrics),
            "oof_auc": E.oof_group_auc(oof, groups=cfg.groups), "ensemble": ens,
            "submission": sub, "models": models, "trials": trials, "trainer": trainer}


SMALL_TRAINER = T.TrainerConfig(overrides={"maxIter": 8, "maxDepth": 4, "minInstancesPerNode": 2,
                                           "stepSize": 0.2})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featurize the labelled documents, 2-fold GBT cross-validation, then the
    out-of-fold per-group AUC and macro mean as ``(metric, value)``."""
    docs = V.docs(spark, sf_dir)
    data = FO.stratified_folds(docs, n_folds=2)
    feats = T.ml_features(data, V.DOC_GROUPS).select("key", "grp", "label", "fold", "features")
    feats = materialize(feats, "flagship-features", sort_within=["key"])
    _, preds = T.cross_validate(feats, SMALL_TRAINER, 2)
    oof = E.attach_oof(feats.select("key", "grp", "label", "fold"), preds.select("key", "pred"))
    return E.oof_group_auc(oof, groups=V.DOC_GROUPS)


def write_template(spark: SparkSession, unlabelled: DataFrame) -> DataFrame:
    t = unlabelled.select(F.col("key").cast("bigint").alias("id"),
                          F.lit(0.5).cast("float").alias("binds")).distinct()
    return SF.read_template(spark, SF.write_csv(t, shared_dir(spark, "template"), "id"))


def small_validation(labelled: DataFrame, groups: list[str], n_rows: int = 2_000_000,
                   batch_size: int = 500_000, negative_ratio: int = 20, n_folds: int = 5,
                   seed: int = 42, trainer: T.TrainerConfig | None = None,
                   min_positives: int = 50) -> DataFrame:
    """The small validation run: whole batches up to ``n_rows`` in key order
    (W8), per-batch sampling with ``label == 0`` negatives (W9), the positives
    guard (F10), stratified folds (W7), per-fold fit and score (ML7), per-group
    AUC per fold and their summary (A6-A8). Rows need (key, grp, label, text).

    With fewer than ``min_positives`` positives it raises."""
    from screenlake.operators import profile as P
    trainer = trainer or T.TrainerConfig()
    rows = S.prefix_batches(labelled, n_rows, batch_size).drop("pos")
    s = materialize(S.chunk_sample(rows, chunk_size=batch_size, negative_ratio=negative_ratio,
                                   seed=seed, negatives="zero")
                    .select("key", "grp", "label", "text"), "validation-sample")
    n_pos = s.where(F.col("label") == 1).count()
    if n_pos < min_positives:
        raise ValueError(f"{n_pos} positive rows; at least {min_positives} are needed")
    s = FO.stratified_folds(s, n_folds=n_folds, seed=seed)
    feats = materialize(T.ml_features(s, groups).select("key", "grp", "label", "fold", "features"),
                        "validation-features", sort_within=["key"])
    _, preds = T.cross_validate(feats, trainer, n_folds, parallelism=n_folds)
    oof = materialize(E.attach_oof(feats.select("key", "grp", "label", "fold"),
                                   preds.select("key", "pred")), "validation-oof")
    per_fold = M.group_auc(oof, ["fold", "grp"], "label", "oof_pred")
    return M.cv_summary(M.metrics_long(per_fold, "grp", "auc", by="fold"))
