from pyspark.sql import functions as F

from paths import SF001
from screenlake.operators import folds as FO
from screenlake.operators import rank as R
from screenlake.operators import sampling as S
from screenlake.plans import views as V


def test_two_level_rank_equals_plain_window(spark):
    a = V.assay(spark, SF001).select("key", "grp", "label")
    two = R.random_rank(a, ["grp", "label"], "key", out="rn")
    one = R.random_rank_plain(a, ["grp", "label"], "key", out="rn")
    assert two.exceptAll(one).count() == 0 and one.exceptAll(two).count() == 0
    g2 = R.random_rank(a, [], "key", out="rn", prefix=2)
    g1 = R.random_rank_plain(a, [], "key", out="rn")
    assert g2.exceptAll(g1).count() == 0


def test_key_position_is_row_number(spark):
    from pyspark.sql import Window
    a = V.assay(spark, SF001).select("key")
    p = R.key_position(a, "key", n_buckets=37)
    q = a.withColumn("pos", F.row_number().over(Window.orderBy("key")).cast("bigint"))
    assert p.exceptAll(q).count() == 0


def test_stratified_sample_quotas_and_reproducibility(spark):
    a = V.assay(spark, SF001)
    s = S.stratified_sample(a, max_positive=60, groups=["F", "O", "P"])
    c = {(r.grp, r.label): r["count"] for r in s.groupBy("grp", "label").count().collect()}
    tot = {(r.grp, r.label): r["count"] for r in a.groupBy("grp", "label").count().collect()}
    for g in "FOP":
        kp = min(tot[(g, 1)], 60)
        assert c[(g, 1)] == kp and c[(g, 0)] == min(tot[(g, 0)], 5 * kp)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = S.stratified_sample(a, max_positive=60, groups=["F", "O", "P"])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert s.select("key").exceptAll(again.select("key")).count() == 0


def test_folds_disjoint_complete_balanced(spark):
    a = V.assay(spark, SF001)
    f = FO.stratified_folds(a, n_folds=5)
    assert f.count() == a.count() and f.select("key").distinct().count() == a.count()
    sizes = f.groupBy("grp", "label", "fold").count().groupBy("grp", "label") \
        .agg((F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r.spread <= 1 for r in sizes)


def test_fold_tiny_stratum_and_string_labels(spark):
    rows = [(i, "g", "yes" if i < 2 else "no") for i in range(10)]
    df = spark.createDataFrame(rows, "key long, grp string, label string")
    f = FO.stratified_folds(df, n_folds=5)
    yes = sorted(r.fold for r in f.where("label = 'yes'").collect())
    assert yes == [0, 1]                 # stratum smaller than k: one row per fold
    assert f.where("label = 'no'").groupBy("fold").count().count() == 5


def test_chunk_tiny(spark):
    # chunk 0: no positives; chunk 1: 1 positive, 2 negatives (fewer than quota 5)
    rows = [(i, "F", 0) for i in range(4)] + [(4, "F", 1), (5, "F", 0), (6, "F", 0), (7, "X", 1)]
    df = spark.createDataFrame(rows, "key long, grp string, label int")
    s = S.chunk_sample(df, chunk_size=4, negative_ratio=5)
    keys = sorted(r.key for r in s.collect())
    assert keys == [4, 5, 6, 7]
    capped = S.window_positive_cap(s, max_per_group=1, merge_interval=5, groups=["F"])
    assert sorted(r.key for r in capped.collect()) == [4, 5, 6]   # unknown group 'X' dropped


def test_truncate_and_prefix(spark):
    a = V.assay(spark, SF001).select("key")
    t = S.truncate_to_cap(a, 123)
    assert t.count() == 123 and t.agg(F.max("shuffle_pos")).first()[0] == 123
    p = S.prefix_batches(a, n_rows=2500, batch_size=1000)
    assert p.count() == 3000


def test_group_disjoint_folds(spark):
    o = V.table(spark, SF001, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    f = FO.group_disjoint_folds(o, "o_custkey", 5)
    assert f.groupBy("o_custkey").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_hot_group_rank_and_sample(spark):
    # one group holds ~90% of the rows: ranks and quotas stay exact
    rows = [(i, "hot" if i % 10 else "cold", int(i % 37 == 0)) for i in range(20000)]
    df = spark.createDataFrame(rows, "key long, grp string, label int")
    two = R.random_rank(df, ["grp", "label"], "key", out="rn")
    one = R.random_rank_plain(df, ["grp", "label"], "key", out="rn")
    assert two.exceptAll(one).count() == 0
    s = S.stratified_sample(df, max_positive=100, negative_ratio=3)
    c = {(r.grp, r.label): r["count"] for r in s.groupBy("grp", "label").count().collect()}
    assert c[("hot", 1)] == 100 and c[("hot", 0)] == 300


def test_buckets_spread_a_hot_stratum(spark):
    # the second-level window is partitioned by (stratum, bucket): no bucket
    # of a hot stratum holds more than a small share of its rows
    rows = [(i, "hot", 0) for i in range(40000)]
    df = spark.createDataFrame(rows, "key long, grp string, label int")
    x, offs = R.rank_buckets(df, ["grp", "label"], "key")
    biggest = offs.agg(F.max("__sl_n")).first()[0]
    assert offs.count() > 3000 and biggest < 0.002 * 40000


def test_window_cap_binds(spark):
    # 7 positives of one group in one merge window, cap 3: exactly 3 kept, negatives untouched
    rows = [(i, "F", 1) for i in range(7)] + [(100 + i, "F", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "key long, grp string, label int")
    s = S.chunk_sample(df, chunk_size=1000, negative_ratio=2)
    assert s.where("label = 0").count() == 14
    capped = S.window_positive_cap(s, max_per_group=3, merge_interval=5)
    assert capped.where("label = 1").count() == 3 and capped.where("label = 0").count() == 14


def test_guards_and_small_helpers(spark):
    import pytest
    from screenlake.operators import ensemble as E
    from screenlake.operators import profile as P
    a = V.assay(spark, SF001)
    assert P.require_min_positives(a, minimum=50) > 50
    with pytest.raises(ValueError):
        P.require_min_positives(a.where("grp = 'F'").limit(10), minimum=50)
    w = a.select("key", E.row_mean(["score", "score2", "score3"]).alias("m"))
    l = E.ensemble_mean(E.stack_scores(a, "key", ["score", "score2", "score3"]))
    j = w.join(l, "key").where(F.abs(F.col("m") - F.col("ensemble")) > 1e-9)
    assert j.count() == 0
    s = a.select(FO.stratum_key("grp", "label").alias("s")).distinct()
    assert sorted(r.s for r in s.collect()) == ["F_0", "F_1", "O_0", "O_1", "P_0", "P_1"]


def test_profiles_on_empty_input(spark):
    from screenlake.operators import profile as P
    empty = spark.createDataFrame([], "key long, grp string, label int, text string")
    r = P.label_profile(empty).first()
    assert r.n_rows == 0 and r.pct_pos is None and r.neg_per_pos == float("inf")
    assert P.invalid_text_rate(empty).first().pct_invalid is None
    assert S.stratified_sample(empty, max_positive=10).count() == 0
