"""Options of a run: pattern keys from a table, feature kinds, resumable search, saved models, loaders."""
import re

import pytest
from pyspark.sql import functions as F

from paths import SF0001
from screenlake.operators import features as X
from screenlake.operators import train as T
from screenlake.plans import screen as SC
from screenlake.plans import views as V
from screenlake.session import shared_dir

TABLE = [(0, r"abc", 1), (1, r"a[bc]+d", 1), (2, r"x?yz", 2), (3, r"foo|bar", 1), (4, r"\(C\)", 1), (5, r"(ab)?cde", 1), (6, r"ab{0,2}cdef", 1), (7, r"hell+o", 1), (8, r"[0-9]{3}", 1)]


@pytest.mark.parametrize("rx,need", [("abc", "abc"), ("a[bc]+d", "a"), ("x?yz", "yz"), ("foo|bar", ""), (r"\(C\)", "(C)"), ("(ab)?cde", "cde"), ("ab{0,2}cdef", "cdef"),
                                     ("hell+o", "hell"), (r"\d+abc", "abc"), ("", ""), ("ab*c", "a"), ("a.b", "a"), ("a+?bc", "bc"), ("[x+]+yes{2}", "ye")])
def test_needed_literals(rx, need):
    got = X.needed_literal(rx)
    assert got == need or (len(got) == len(need) and got in rx)


def test_pattern_table_equals_every_regex_on_every_text(spark):
    texts = ["abc", "xxabbcd yz yz", "bar (C) cde", "acdef abcdef", "hello helllo 123", "", None, "abc", "ab", "yz xyz", "hel lo"]
    df = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    table = spark.createDataFrame(TABLE, "key_id int, regex string, min_count int")
    got = {tuple(r) for r in X.pattern_keys_from_table(df, table).collect()}
    assert got == {(i, k) for i, t in enumerate(texts) for k, rx, m in TABLE if t is not None and len(list(re.finditer(rx, t))) >= m}


@pytest.mark.parametrize("kind,descriptors,encoding,size", [("morgan", True, "onehot", 64 + 16 + 2), ("maccs", False, "label", 167 + 1), ("both", True, "label", 64 + 167 + 16 + 1)])
def test_feature_options(spark, kind, descriptors, encoding, size):
    df = spark.createDataFrame([(1, "CCO", "en"), (2, "c1cc[nH]c1", "fr"), (3, None, "xx")], "key long, text string, grp string")
    got = {r.key: r.features for r in T.ml_features(df, ["en", "fr"], nbits=64, fingerprint=kind, descriptors=descriptors, encoding=encoding).collect()}
    assert {v.size for v in got.values()} == {size}
    assert [got[k][size - 1] for k in (1, 2, 3)] == ([0.0, 1.0, -1.0] if encoding == "label" else [0.0, 1.0, 0.0])
    if kind == "maccs":
        keys = {i for i in range(167) if got[1][i]}
        assert keys == {r.key_id for r in X.pattern_keys(df).where("key = 1").collect()}
    with pytest.raises(ValueError):
        T.ml_features(df, ["en"], fingerprint="ecfp")


def test_search_continues_and_keeps_its_budget(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(T, "fit", lambda train, cfg, *a: calls.append(cfg.overrides["maxDepth"]) or cfg)
    monkeypatch.setattr(T, "predict_proba", lambda m, df: df.withColumn("pred", F.col("x") * m.params()["stepSize"]))
    df = spark.createDataFrame([(0, 0.1), (1, 0.4), (0, 0.3), (1, 0.2)], "label int, x double")
    where = shared_dir(spark, "t-trials") + "/trials"
    first = T.param_search(df, df, T.TrainerConfig(), 2, 5, results=where).collect()
    assert len(calls) == 2 and len(first) == 2
    again = T.param_search(df, df, T.TrainerConfig(), 4, 5, results=where, parallelism=2).collect()
    assert len(calls) == 4 and {r.trial for r in again} == {0, 1, 2, 3}
    assert len(T.param_search(df, df, T.TrainerConfig(), 3, 5, budget=0.0).collect()) == 1
    best = T.with_best(T.TrainerConfig(overrides={"maxIter": 7}), spark.createDataFrame(again))
    assert best.overrides["maxIter"] == 7 and best.overrides["maxDepth"] == again[0].max_depth


def test_run_with_chunked_loader_search_and_saved_models(spark):
    folder = shared_dir(spark, "t-models")
    small = T.TrainerConfig(overrides={"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 2})
    cfg = SC.ScreenConfig(n_folds=2, trainer=small, loader="chunked", max_positive=None, chunk_size=60, fingerprint="maccs",
                          descriptors=False, encoding="label", n_trials=1, trial_rounds=2, model_dir=folder, run_name="a")
    u = V.unlabelled(spark, SF0001)
    out = SC.run_screen(V.docs(spark, SF0001), u, cfg)
    assert out["submission"].count() == u.count() and out["trials"].count() == 1
    assert [T.load_model(f"{folder}/a-fold{k}").getNumTrees for k in range(2)] == [m.getNumTrees for m in out["models"]]
    with pytest.raises(ValueError):
        SC.load_sample(u, SC.ScreenConfig(loader="none"))
