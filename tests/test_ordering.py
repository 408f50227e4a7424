"""Ranges of bounded size: positions, running sums and the n-th key on clustered and skewed keys."""
import random

import pytest
from pyspark.sql import functions as F

from screenlake.operators import metrics as M
from screenlake.operators import ordering as O
from screenlake.operators import sampling as S


def test_one_outlier_does_not_fill_one_range(spark):
    df = spark.range(20000).select(F.when(F.col("id") == 0, F.lit(1 << 60)).otherwise(F.col("id")).alias("key"))
    rows, sizes = O.range_numbered(df, ["key"], limit=1000)
    n = [r.n for r in sizes.collect()]
    assert sum(n) == 20000 and max(n) <= 1000 and len(n) >= 20
    got = [r.key for r in O.positions(df, "key", limit=1000).orderBy("pos").collect()]
    assert got == list(range(1, 20000)) + [1 << 60]


@pytest.mark.parametrize("kind", ["string", "double", "decimal(20,3)", "date"])
def test_positions_of_any_orderable_type(spark, kind):
    value = {"string": F.md5(F.col("id").cast("string")), "double": F.pow(F.lit(10.0), -F.col("id") % 300), "decimal(20,3)": F.col("id") * 7919 % 5003 / 1000,
             "date": F.date_add(F.lit("2000-01-01"), (F.col("id") * 37 % 3001).cast("int"))}[kind].cast(kind)
    df = spark.range(3001 if kind == "date" else 300 if kind == "double" else 4000).select(value.alias("k"), (F.col("id") % 3).alias("g"))
    keys = sorted(r.k for r in df.collect())
    assert [r.k for r in O.positions(df, "k", limit=200).orderBy("pos").collect()] == keys
    inside = {}
    for r in O.positions(df, "k", "p", ["g"], limit=200).collect():
        inside.setdefault(r.g, {})[r.p] = r.k
    for g, at in inside.items():
        assert sorted(at) == list(range(1, len(at) + 1)) and [at[i] for i in sorted(at)] == sorted(at.values())


def test_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None, 0), (None, 1), (5, 2), (5, 3), (5, 4), (1, 5)], "k int, row int")
    got = O.positions(df, "k", limit=2).collect()
    assert sorted(r.pos for r in got) == [1, 2, 3, 4, 5, 6]
    assert [r.k for r in sorted(got, key=lambda r: r.pos)] == [None, None, 1, 5, 5, 5]
    assert O.positions(df.limit(0), "k").count() == 0


def test_clustered_scores_share_no_range(spark):
    """10^5 distinct scores below 1e-6: an equal-width bucket would hold them all."""
    df = spark.range(100_000).select((F.col("id") * 1e-11).alias("score"), (F.col("id") % 7 == 0).cast("int").alias("label"), F.lit("A").alias("grp"))
    rows, sizes = O.range_numbered(M.score_counts(df, ["grp"], "label", "score"), ["grp", "score"], limit=5000)
    assert max(r.n for r in sizes.collect()) <= 5000
    got = M.group_auc(df, limit=5000).first()
    pos = [i for i in range(100_000) if i % 7 == 0]
    below = sum(i - k for k, i in enumerate(pos))
    assert got.n_pos == len(pos) and got.auc == pytest.approx(below / (len(pos) * (100_000 - len(pos))), abs=1e-15)


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    rng = random.Random(4)
    data = [(g, s / 977, rng.randrange(9)) for g in ("a", "b", None) for s in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(data, "g string, s double, c long")
    got = {(r.g, r.s): r.cum_c for r in O.cumulate(df, ["g"], "s", ["c"], descending, limit=100).collect()}
    for g in ("a", "b", None):
        total = 0
        for _, s, c in sorted((x for x in data if x[0] == g), key=lambda x: -x[1] if descending else x[1]):
            total += c
            assert got[g, s] == total


def test_nth_key(spark, monkeypatch):
    monkeypatch.setattr(O, "SAMPLED", 200)
    keys = [7] * 3000 + list(range(2000)) + [10**15]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long").repartition(5)
    for n in (1, 2, 7, 8, 9, 1500, 3008, 3009, 5000, 5001, 9999):
        assert O.nth_key(df, "k", n) == sorted(keys)[min(n, len(keys)) - 1]
    words = df.where("k is not null").select(F.md5(F.col("k").cast("string")).alias("k"))
    assert O.nth_key(words, "k", 1234) == sorted(r.k for r in words.collect())[1233]
    assert O.nth_key(df.limit(0), "k", 3) is None


def test_prefix_reads_only_the_kept_keys(spark):
    df = spark.range(5000).select((F.col("id") * 3).alias("key"), F.lit("x").alias("wide"))
    out = S.prefix_batches(df, 250, 100)
    assert sorted((r.key, r.pos) for r in out.collect()) == [(3 * i, i + 1) for i in range(300)]
    assert S.prefix_batches(df.limit(0), 250, 100).count() == 0
