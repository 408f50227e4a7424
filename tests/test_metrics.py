import math
import random

from pyspark.sql import functions as F

from screenlake.functions.scores import clip_score
from screenlake.operators import metrics as M

NAN = float("nan")

# METRICS_TINY: ties, a one-class group, a configured empty group, NaN and null scores
TINY = [("A", 1, 0.9), ("A", 0, 0.1), ("A", 1, 0.5), ("A", 0, 0.5), ("A", 1, NAN), ("A", 0, None),
        ("B", 0, 0.3), ("B", 0, 0.7)]
SCHEMA = "grp string, label int, score double"


def _tiny(spark):
    return spark.createDataFrame(TINY, SCHEMA)


def test_group_auc_by_hand(spark):
    r = {x.grp: x for x in M.group_auc(_tiny(spark), groups=["A", "B", "C"]).collect()}
    assert r["A"].auc == 0.875 and (r["A"].n_pos, r["A"].n_neg) == (2, 2)
    assert r["B"].auc is None                      # one class only
    assert r["C"].auc is None and r["C"].n_pos == 0  # configured, no rows


def test_macro_mean_skips_missing(spark):
    per = M.group_auc(_tiny(spark), groups=["A", "B", "C"])
    row = M.macro_mean(per).first()
    assert row.mean_auc == 0.875 and row.n_groups == 1


def test_average_precision_by_hand(spark):
    r = {x.grp: x for x in M.average_precision(_tiny(spark)).collect()}
    assert abs(r["A"].average_precision - (0.5 + 0.5 * 2 / 3)) < 1e-9
    assert r["B"].average_precision is None


def test_threshold_metrics_by_hand(spark):
    r = {x.grp: x for x in M.threshold_metrics(_tiny(spark), threshold=0.5).collect()}
    a = r["A"]
    assert (a.tp, a.fp, a.fn, a.tn) == (2, 1, 0, 1)
    assert abs(a.precision - 2 / 3) < 1e-9 and a.recall == 1.0 and abs(a.f1 - 0.8) < 1e-9
    b = r["B"]                                      # zero division -> 0
    assert b.precision == 0.0 and b.recall == 0.0 and b.f1 == 0.0
    assert r["__all__"].tp == 2


def test_clip_keeps_nan_and_null(spark):
    df = spark.createDataFrame([(NAN,), (None,), (2.0,), (-1.0,), (0.3,)], "p double")
    out = [r.c for r in df.select(clip_score("p").alias("c")).collect()]
    assert math.isnan(out[0]) and out[1] is None
    assert out[2:] == [1 - 1e-6, 1e-6, 0.3]


def test_cv_summary_ignores_nan(spark):
    df = spark.createDataFrame([(0, "m", 0.5), (1, "m", NAN), (2, "m", 0.7), (0, "z", NAN)],
                               "fold int, metric string, value double")
    r = {x.metric: x for x in M.cv_summary(df).collect()}
    assert abs(r["m"].mean - 0.6) < 1e-9 and abs(r["m"].std - 0.1) < 1e-9 and r["m"].n_folds == 2
    assert r["z"].mean is None


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_group_auc_matches_brute_force_with_ties(spark):
    rnd = random.Random(7)
    rows = [(g, int(rnd.random() < 0.3), round(rnd.uniform(-3, 3), 1)) for g in "xyz" for _ in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.grp: r.auc for r in M.group_auc(df, limit=4).collect()}
    for g in "xyz":
        exp = _brute_auc([(y, s) for gg, y, s in rows if gg == g])
        assert abs(got[g] - exp) < 1e-12


def test_group_auc_independent_of_partitions(spark):
    rnd = random.Random(3)
    rows = [("g", int(rnd.random() < 0.1), rnd.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = M.group_auc(df).first().auc
    b = M.group_auc(df.repartition(13)).first().auc
    assert a == b


def test_auc_matches_mllib_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    rnd = random.Random(11)
    rows = [("all", int(rnd.random() < 0.2), round(rnd.random(), 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    ours = M.group_auc(df).first().auc
    raw = df.select(F.col("label").cast("double").alias("label"),
                    array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("raw"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    assert abs(ev.evaluate(raw) - ours) < 1e-9


def _brute_ap(rows):
    n_pos = sum(y for y, _ in rows)
    ap = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp_t = sum(1 for y, s in rows if s == t and y == 1)
        cum_tp = sum(1 for y, s in rows if s >= t and y == 1)
        cum_n = sum(1 for _, s in rows if s >= t)
        ap += tp_t / n_pos * cum_tp / cum_n
    return ap


def test_average_precision_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(g, int(rnd.random() < 0.25), round(rnd.uniform(0, 2), 1)) for g in "uv" for _ in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.grp: r.average_precision for r in M.average_precision(df, limit=3).collect()}
    for g in "uv":
        assert abs(got[g] - _brute_ap([(y, s) for gg, y, s in rows if gg == g])) < 1e-8
