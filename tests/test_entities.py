"""Building blocks: quotas, features, folds; salted joins; sketch decisions."""
import random
from collections import Counter

from pyspark.sql import functions as F

from screenlake.operators import entities as EN
from screenlake.operators import skew as SK


def test_quotas_are_a_water_level(spark):
    rng = random.Random(2)
    sizes = {f"b{i}": rng.choice([1, 2, 3, 5, 40, 700]) for i in range(60)}
    rows = [(k, b) for b, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows)] + [(-1, None)], "key long, blk string")
    for total in (0, 1, 59, 60, 61, 500, len(rows) - 1, len(rows), len(rows) + 5):
        got = Counter(r.blk for r in EN.diversity_sample(df, "blk", total).collect())
        assert sum(got.values()) == min(total, len(rows))
        level = max((x for x in range(701) if sum(min(n, x) for n in sizes.values()) <= total), default=0)
        assert all(min(n, level) <= got[b] <= min(n, level + 1) for b, n in sizes.items())


def test_block_features_share_one_dictionary(spark):
    rows = [(i, f"AB{i % 7}CDE", "AB0CDE" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, b1 string, b2 string")
    got = {(r.key, r.feature_idx): r.value for r in EN.block_features(df, ["b1", "b2"], nbits=64).collect()}
    from screenlake.operators.features import hashed_fingerprint
    for i, c in enumerate(("b1", "b2")):
        one = {(r.key, i * 64 + r.bit): float(r.cnt) for r in hashed_fingerprint(df, "key", c, 64).collect()}
        assert one == {k: v for k, v in got.items() if i * 64 <= k[1] < (i + 1) * 64}


def test_balanced_folds(spark):
    rng = random.Random(3)
    rows = [(f"big{g}", int(rng.random() < 0.2)) for g, n in enumerate((900, 800, 500, 400, 200)) for _ in range(n)]
    rows += [(f"g{rng.randrange(2000)}", int(rng.random() < 0.05)) for _ in range(6000)] + [(None, 1)] * 30
    df = spark.createDataFrame(rows, "g string, label int")
    out = EN.balanced_group_folds(df, "g", n_folds=4)
    assert out.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    sizes = Counter(r.fold for r in out.collect())
    assert out.count() == len(rows) and max(sizes.values()) - min(sizes.values()) < 0.15 * len(rows) / 4
    hashed = Counter(r.fold for r in out.where("g like 'big%'").collect())
    assert len(hashed) == 4
    assert EN.balanced_group_folds(df.limit(0), "g").count() == 0


def test_salted_join_spreads_a_hot_key(spark):
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("t"))
    right = df.select("t").distinct().where("t is not null").withColumn("v", F.length("t"))
    for how in ("inner", "left"):
        assert sorted(map(str, SK.salted_join(df, right, "t", how).collect())) == sorted(map(str, df.join(right, "t", how).select("id", "t", "v").collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = [r["count"] for r in SK.salted_join(df, right, "t").groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in df.join(right, "t").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(plain) > 4 * sorted(plain)[len(plain) // 2] and max(n) <= 2 * sorted(n)[len(n) // 2]


def test_sketch_decides_as_the_exact_count(spark, monkeypatch):
    df = spark.range(20000).select((F.col("id") % 10).alias("few"), F.col("id").alias("all"), F.when(F.col("id") < 9990, F.col("id")).otherwise(0).alias("below"),
                                   F.when(F.col("id") < 10010, F.col("id")).otherwise(0).alias("above"), F.lit(None).cast("string").alias("none"))
    got = {r.column_name: r.encode for r in SK.encode_decision(df, df.columns).collect()}
    assert got == {"few": True, "all": False, "below": True, "above": False, "none": True}
    assert SK.encode_decision(df.limit(0), ["few"]).first().encode
