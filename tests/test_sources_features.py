import pytest
from pyspark.sql import functions as F

from paths import SF0001
from screenlake.operators import ensemble as E
from screenlake.operators import features as X
from screenlake.operators import profile as P
from screenlake.session import shared_dir
from screenlake.sources import files as SF
from screenlake.sources import parquet as SP


def test_narrow_tiny(spark):
    rows = [(-128, 127, -129, 32767, 2 ** 31 - 1, 2 ** 31, 1.5), (0, 0, 0, 32768, -2 ** 31, 0, 2.5)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long, e long, f long, x double")
    t = {r.column_name: r.narrow_type for r in SP.int_ranges(df).collect()}
    assert t == {"a": "tinyint", "b": "tinyint", "c": "smallint", "d": "int", "e": "int", "f": "bigint"}
    n = SP.narrow_types(df)
    assert [f.dataType.simpleString() for f in n.schema.fields] == \
        ["tinyint", "tinyint", "smallint", "int", "int", "bigint", "float"]
    u = SP.narrow_types(df, convert_floats=False, mode="int32")
    assert u.schema["a"].dataType.simpleString() == "int"
    assert u.schema["f"].dataType.simpleString() == "bigint"


def test_cardinality_threshold(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c"), ("c", "c")], "u string, v string")
    r = {x.column_name: x for x in P.cardinality_ratio(df, ["u", "v"]).collect()}
    assert r["u"].ratio == 0.75 and not r["u"].encode
    df2 = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "u string")
    assert P.cardinality_ratio(df2, ["u"]).first().encode is False      # exactly 0.5: not < 0.5
    df3 = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",)], "u string")
    assert P.cardinality_ratio(df3, ["u"]).first().encode is True


def test_template_tiny_and_strict_submission(spark):
    tmpl = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.5)], "id int, binds float")
    path = SF.write_csv(tmpl, shared_dir(spark, "tt"), "id")
    t = SF.read_template(spark, path)
    assert t.schema.simpleString() == "struct<id:bigint,binds:float>" and t.count() == 3
    bad = spark.createDataFrame([(1, 0.2), (1, 0.3), (4, 0.9)], "id int, pred double")
    c = E.template_key_check(t, bad, "id").first()
    assert (c.n_missing, c.n_extra, c.n_duplicate, c.n_template) == (2, 1, 1, 3)
    with pytest.raises(ValueError):
        E.create_submission(t, bad, "id", "pred")
    good = spark.createDataFrame([(1, 2.0), (2, -1.0), (3, 0.25)], "id int, pred double")
    out = {r.id: r.binds for r in E.create_submission(t, good, "id", "pred").collect()}
    assert out[3] == 0.25 and out[1] == pytest.approx(1 - 1e-6) and out[2] == pytest.approx(1e-6)


SMILES = [(1, "CCO"), (2, "c1ccccc1"), (3, "C[C@H](N)C(=O)O"), (4, "[Dy]CC"), (5, ""),
          (6, None), (7, "ClCBr"), (8, "C%12CC%12"), (9, "C(C")]


def test_descriptors_smiles_tiny(spark):
    df = spark.createDataFrame(SMILES, "key long, text string")
    d = {r.key: r for r in X.text_descriptors(df).collect()}
    assert (d[1].s_tokens, d[1].s_heavy_atoms, d[1].s_c, d[1].s_o) == (3, 3, 2, 1)
    assert d[1].s_mass == round(2 * 12.011 + 15.999, 6)
    assert (d[2].s_aromatic, d[2].s_ring_closures, d[2].s_c) == (6, 2, 6)
    assert (d[3].s_chiral, d[3].s_branches, d[3].s_double, d[3].s_n, d[3].s_o) == (1, 2, 1, 1, 2)
    assert d[4].s_linker == 1 and d[4].s_heavy_atoms == 3
    assert d[5].s_tokens == 0 and d[6].s_tokens == 0 and d[6].s_mass == 0.0
    assert d[7].s_halogen == 2 and d[7].s_c == 1
    assert d[8].s_ring_closures == 2


def test_bracket_atoms_count_once(spark):
    from screenlake.operators import train as T
    df = spark.createDataFrame([(1, "C[C@@H](N)C(=O)O"), (2, "C[NH3+]"), (3, "[13CH4]"),
                                (4, "[H]O[H]"), (5, "c1cc[nH]c1")], "key long, text string")
    d = {r.key: r for r in X.text_descriptors(df).collect()}
    assert [d[k].s_heavy_atoms for k in range(1, 6)] == [6, 2, 1, 1, 5]
    assert [d[k].s_ring_closures for k in range(1, 6)] == [0, 0, 0, 0, 2]
    assert d[1].s_chiral == 1 and d[2].s_charged == 1 and d[2].s_n == 1
    assert d[3].s_c == 1 and d[3].s_mass == 12.011 and d[5].s_aromatic == 5
    bad = spark.createDataFrame([(1, "C(CCCCCC", "en"), (2, None, "en")], "key long, text string, grp string")
    assert [(r.feature_idx, r.value) for r in X.feature_table_long(bad, ["en"]).collect()] \
        == [(X.DEFAULT_NBITS + len(X.DESCRIPTOR_NAMES), 1.0)] * 2
    assert all(r.features.numNonzeros() == 1 for r in T.ml_features(bad, ["en"]).collect())


def test_best_round_waits_for_a_late_minimum():
    from screenlake.operators.train import best_round
    assert best_round([0.5, 0.6, 0.6, 0.4, 0.45], 3) == 4
    assert best_round([0.5, 0.6, 0.6, 0.4, 0.45], 2) == 1
    assert best_round([0.5, 0.4, 0.3], 1) == 3


def test_validity_and_fingerprint(spark):
    df = spark.createDataFrame(SMILES + [(10, "C1CC1"), (11, "C2CC2")], "key long, text string")
    v = {r.key: r.ok for r in df.select("key", X.text_is_valid("text").alias("ok")).collect()}
    assert v[1] and not v[5] and not v[6] and not v[9]
    fp = X.hashed_fingerprint(df, nbits=64)
    assert fp.where((F.col("bit") < 0) | (F.col("bit") >= 64)).count() == 0
    a = sorted((r.bit, r.cnt) for r in fp.where("key = 10").collect())
    b = sorted((r.bit, r.cnt) for r in fp.where("key = 11").collect())
    assert a == b                      # ring-closure digits are normalised
    assert sum(c for _, c in a) == 2   # 'C0CC', '0CC0'


def test_distinct_featurize_runs_once_per_text(spark):
    df = spark.createDataFrame([(1, "abc 1"), (2, "abc 1"), (3, "zz")], "key long, text string")
    out = {r.key: r for r in X.distinct_featurize(df).collect()}
    assert out[1].k_chars == 5 and out[1].k_digits == 1 and out[1].k_spaces == 1
    assert out[1].k_chars == out[2].k_chars and out[3].k_chars == 2


def test_group_encodings(spark):
    df = spark.createDataFrame([(1, "en"), (2, "es")], "key long, grp string")
    oh = {r.key: r for r in X.group_onehot(df, ["en", "fr"]).collect()}
    assert (oh[1].g_en, oh[1].g_fr, oh[2].g_en, oh[2].g_fr) == (1.0, 0.0, 0.0, 0.0)
    le = {r.key: r.group_idx for r in X.group_label_encode(df, ["en", "fr"]).collect()}
    assert le == {1: 0, 2: -1}
    with pytest.raises(ValueError):
        X.fingerprint_width("ecfp")


def test_discovery(spark):
    files = SF.list_files(spark, SF0001, "*.parquet")
    assert files.count() == 14
    assert SF.find_input(spark, SF0001, "orders").endswith("orders.parquet")
    assert SF.find_input(spark, SF0001, "Orders").endswith("orders.parquet")     # names, without case
    assert SF.find_input(spark, SF0001, "nope", "dflt") == "dflt"
    assert SF.find_input(spark, SF0001, "testdata") is None                      # a folder's name is none


def test_grams_are_code_point_substrings(spark):
    import re
    texts = ["ab\U0001F600cd\U0001F600\U0001F600ef", "éu n1 2x", "\U0001F600" * 5, "abc", "",
             "a\nb\r\nc\td"]
    df = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    got = {r.key: r.g for r in df.select("key", X.grams("text").alias("g")).collect()}
    for i, t in enumerate(texts):
        n = re.sub("[0-9]", "0", t)
        assert got[i] == [n[j:j + 4] for j in range(len(n) - 3)]


def test_csv_roundtrip_keeps_whole_texts(spark):
    from screenlake.plans import views as V
    d = V.docs(spark, "/root/testdata/sf0.01").select("key", "grp", "label", "text")
    path = SF.write_csv(d, shared_dir(spark, "t-csv"))
    back = SF.read_small_csv(spark, path, "key BIGINT, grp STRING, label INT, text STRING")
    assert back.count() == d.count()
    assert back.exceptAll(d).count() == 0 and d.exceptAll(back).count() == 0


def test_csv_of_one_line_records(spark):
    rows = [(1, 'a\nb "q", %0A %25 % \r\n'), (2, ""), (3, "%"), (1 << 40, "plain\n")]
    df = spark.createDataFrame(rows, "key long, text string")
    path = SF.write_csv(df, shared_dir(spark, "t-csv-lines"), one_line=True)
    assert spark.read.text(path).where("value <> 'key,text'").count() == 4
    got = SF.read_small_csv(spark, path, "key BIGINT, text STRING", one_line=True)
    assert sorted((r.key, r.text or "") for r in got.collect()) == rows
    t = SF.write_csv(spark.createDataFrame([(1 << 40, 0.5)], "id long, binds float"), shared_dir(spark, "t-wide"))
    assert SF.read_template(spark, t).first().id == 1 << 40


def test_checked_broadcast_both_branches(spark):
    from screenlake.session import checked_broadcast, materialize
    big = spark.range(0, 5000).withColumn("g", F.col("id") % 7)
    small = materialize(spark.range(0, 7).withColumnRenamed("id", "g").withColumn("v", F.col("g") * 10),
                        "t-small")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        a = big.join(checked_broadcast(small, max_rows=100), "g")
        b = big.join(checked_broadcast(small, max_rows=3), "g")     # over the bound: shuffle join
        pa = a._jdf.queryExecution().executedPlan().toString()
        pb = b._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in pa and "BroadcastHashJoin" not in pb
        assert a.exceptAll(b).count() == 0 and a.count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
