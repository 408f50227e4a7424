"""Model features in one pass over distinct texts, and fits that grow each tree once."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from screenlake.operators import features as X
from screenlake.operators import train as T

ODD = ["CCO", "c1cc[nH]c1", "[13CH4]Cl[Br-]BrB", "C%12CC%12%1", "[Dy].[Na+].[C@@H](F)I", "(]", "  ", "", "[]]", "naïve 𝒳 [é+] x@y", "a\n[b\nc]\nd", "C(=O)#N$*~/\\?>", "[[C]", "x" * 50 + "[2H]"]


def test_descriptors_of_one_text_equal_the_columns(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "key long, text string")
    want = {r.key: list(r)[1:] for r in X.text_descriptors(df).collect()}
    for i, t in enumerate(ODD):
        assert X.descriptor_values(t) == pytest.approx(want[i], abs=1e-6), t
    valid = {r.key for r in df.where(X.text_is_valid("text")).collect()}
    assert valid == {i for i, t in enumerate(ODD) if X.is_valid(t)}


def test_vectors_hold_bits_descriptors_and_groups_of_every_row(spark):
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate([*ODD, "CCO", None])]
    df = spark.createDataFrame(rows, "key long, text string, grp string")
    f = T.ml_features(df, ["en"], nbits=64)
    got = {r.key: r.v for r in f.select("key", vector_to_array("features").alias("v")).collect()}
    assert len(got) == len(rows)
    for k, t, g in rows:
        t = t if t is not None and X.is_valid(t) else ""
        bits = set(X.piece_bits([t], 64, X.GRAM)[1].tolist())
        assert got[k][:64] == [float(i in bits) for i in range(64)]
        assert got[k][64:-1] == pytest.approx(X.descriptor_values(t), abs=1e-6)
        assert got[k][-1] == float(g == "en")
    plan = f._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan        # no array of all grams of a text


def test_grams_are_hashed_once_a_task(monkeypatch):
    known, asked = {}, []
    real = X.hashlib.md5
    monkeypatch.setattr(X.hashlib, "md5", lambda b: asked.append(b) or real(b))
    first = X.piece_bits(["abcdef", "abcd"], 64, 4, known)
    again = X.piece_bits(["abcdef", "abcd"], 64, 4, known)
    assert len(asked) == len(set(asked)) > 0
    assert [x.tolist() for x in first] == [x.tolist() for x in again]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(400).select(F.col("id").alias("key"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                 F.concat(F.lit("C" * 3), F.md5(F.col("id").cast("string"))).alias("text"), F.lit("en").alias("grp"))
    return T.ml_features(df, ["en"], nbits=16).select("key", "label", "features").coalesce(1).sortWithinPartitions("key").cache()


def test_first_rounds_equal_a_fit_of_so_many(rows, tmp_path):
    cfg = T.TrainerConfig(overrides={"maxIter": 6, "maxDepth": 3, "minInstancesPerNode": 2})
    cut, = T._run_parallel(lambda m: T.first_rounds(m, 4), [T.fit(rows, cfg)], 2)      # as the folds run
    again = T.make_gbt(cfg, 4).fit(T.with_weight(rows.select("features", "label"), cfg))
    trees = [m.toDebugString.split("\n", 1)[1] for m in (cut, again, T.load_model(T.save_model(cut, str(tmp_path / "m"))))]
    assert trees[0] == trees[1] == trees[2]
    assert (cut.getMaxIter(), cut.getNumTrees, cut.numFeatures, cut.numClasses) == (4, 4, again.numFeatures, 2)
    score = [[r.pred for r in T.predict_proba(m, rows).orderBy("key").collect()] for m in (cut, again)]
    assert score[0] == score[1]


@pytest.mark.parametrize("at,asked,rounds", [(4, [4, 40], 25), (3, [4, 8], 6), (1, [4], 1)])
def test_a_fit_does_not_grow_its_trees_again(rows, monkeypatch, at, asked, rounds):
    """Losses with their least at round ``at`` of the first fit, at ``rounds`` of the last."""
    fits = []

    class Model:
        def __init__(self, n):
            self.n = n

        def evaluateEachIteration(self, held):
            least = at if len(fits) == 1 else rounds
            return [abs(i + 1 - least) + 1.0 for i in range(self.n)]

    class Gbt:
        def __init__(self, n):
            self.n = n

        def fit(self, data):
            fits.append(self.n)
            return Model(self.n)
    monkeypatch.setattr(T, "make_gbt", lambda cfg, n: Gbt(n))
    monkeypatch.setattr(T, "first_rounds", lambda m, n: ("cut", n))
    cfg = T.TrainerConfig(overrides={"maxIter": 40})
    got = T.fit(rows, cfg, rows, patience=2)
    assert fits == asked
    assert got == ("cut", rounds)


def test_alternative_trainer_runs_its_whole_preset(rows, monkeypatch):
    from screenlake.plans import queries_ml as Q
    asked, small = [], T.TrainerConfig(overrides={"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 2})

    def fit(train, cfg, valid=None, patience=T.PATIENCE):
        asked.append((cfg.params(), patience, valid is not None))
        return T.make_gbt(small, 2).fit(T.with_weight(train.select("features", "label"), small))
    monkeypatch.setattr(Q, "_features", lambda spark, sf: rows.withColumn("grp", F.lit("en")).withColumn("fold", (F.col("key") % 5).cast("int")))
    monkeypatch.setattr(T, "fit", fit)
    out = Q.q_alt_trainer(None, None)
    assert asked == [(T.PRESETS["deep"], T.PATIENCE, True)]
    assert out.columns == ["key", "grp", "label", "pred"] and out.count() == 80


@pytest.mark.parametrize("least,asked", [(38, [40, 400]), (25, [40, 80]), (130, [40, 400]), (15, [40])])
def test_a_fit_that_still_falls_goes_on_to_all_rounds(rows, monkeypatch, least, asked):
    """Losses that fall to round ``least`` and rise from there."""
    assert _rounds_asked(rows, monkeypatch, [abs(i + 1 - least) + 1.0 for i in range(400)]) == asked


def test_a_fit_past_half_of_all_rounds_grows_them_all(rows, monkeypatch):
    # a lower loss every 18 rounds: patience never runs out, none is among the last of a try
    losses = [1000.0 - i if i % 18 == 12 else 1000.0 for i in range(1, 401)]
    assert _rounds_asked(rows, monkeypatch, losses) == [40, 80, 160, 400]


def _rounds_asked(rows, monkeypatch, losses):
    fits = []

    class Model:
        def __init__(self, n):
            self.n = n

        def evaluateEachIteration(self, held):
            return losses[:self.n]

    class Gbt:
        def __init__(self, n):
            self.n = n

        def fit(self, data):
            fits.append(self.n)
            return Model(self.n)
    monkeypatch.setattr(T, "make_gbt", lambda cfg, n: Gbt(n))
    monkeypatch.setattr(T, "first_rounds", lambda m, n: n)
    got = T.fit(rows, T.TrainerConfig(overrides={"maxIter": 400}), rows, patience=20)
    best = T.best_round(losses, 20)
    assert got == best or (best == fits[-1] and got.n == best)
    return fits
