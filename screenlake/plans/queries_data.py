"""Registered queries: OOF / ensemble / submission, scans and narrowing, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.functions.hashing import hash_unit
from screenlake.operators import ensemble as E
from screenlake.operators import entities as EN
from screenlake.operators import features as X
from screenlake.operators import folds as FO
from screenlake.operators import metrics as M
from screenlake.operators import profile as P
from screenlake.operators import skew as SK
from screenlake.plans import sql_text as Q
from screenlake.plans import views as V
from screenlake.plans.catalog import register, rounded
from screenlake.session import materialize, shared_dir
from screenlake.sources import files as SF
from screenlake.sources import parquet as SP

# ------------------------------------------------------------------ OOF, CV, ensemble

N_FOLDS = 5

_FOLDED_SQL = f"""(SELECT *, ((row_number() OVER (PARTITION BY grp, label ORDER BY {Q.kh('key')}, key) - 1) % 5)::int
  AS fold FROM {V.ASSAY_SQL})"""

_OOF_SQL = f"""(SELECT f.key, f.grp, f.label, f.fold, {Q.clip('p.pred')} AS oof_pred
  FROM {_FOLDED_SQL} f LEFT JOIN (SELECT key, score AS pred FROM {_FOLDED_SQL}) p ON f.key = p.key)"""


def _oof(spark, sf):
    # the folded table feeds every fold's predictions: write it once
    a = materialize(FO.stratified_folds(V.assay(spark, sf), n_folds=5), "folded")
    # one prediction set per fold model (here the view's score plays the model)
    preds = [a.where(F.col("fold") == k).select("key", F.col("score").alias("pred"))
             for k in range(N_FOLDS)]
    return E.attach_oof(a.select("key", "grp", "label", "fold"), preds)


@register("oof_attach", f"SELECT * FROM {_OOF_SQL}")
def q_oof_attach(spark, sf):
    return _oof(spark, sf)


@register("oof_coverage", f"""
SELECT count(*)::bigint AS n_total,
  sum(CASE WHEN oof_pred IS NULL OR isnan(oof_pred) THEN 0 ELSE 1 END)::bigint AS n_valid,
  sum(CASE WHEN oof_pred IS NULL OR isnan(oof_pred) THEN 1 ELSE 0 END)::bigint AS n_missing FROM {_OOF_SQL}""")
def q_oof_coverage(spark, sf):
    return P.coverage(_oof(spark, sf), "oof_pred")


def _auc_long_sql(src: str, by: str = "") -> str:
    """(by, metric, value): per-group AUC rows and the macro mean, from ``src``
    (columns grp, label, s and the ``by`` columns)."""
    byc = f"{by}, " if by else ""
    pby = f"PARTITION BY {by}, grp" if by else "PARTITION BY grp"
    return f"""
c AS (SELECT {byc}grp, s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::bigint AS pos,
             sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::bigint AS neg
      FROM {src} WHERE label IN (0, 1) AND s IS NOT NULL AND NOT isnan(s) AND grp IS NOT NULL
      GROUP BY {byc}grp, s),
r AS (SELECT *, sum(neg) OVER ({pby} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM c),
p AS (SELECT {byc}grp, sum(pos) AS n_pos, sum(neg) AS n_neg, sum(pos * (2 * below + neg)) AS num2
      FROM r GROUP BY {byc}grp),
g AS (SELECT {byc}grp, CASE WHEN n_pos > 0 AND n_neg > 0
        THEN num2::double / (n_pos::double * n_neg::double * 2.0::double) END AS auc FROM p),
lng AS (SELECT {byc}grp || '_auc' AS metric, auc AS value FROM g
        UNION ALL SELECT {byc}'mean_auc' AS metric, round(avg(auc), 9) AS value FROM g
        {'GROUP BY ' + by if by else ''})"""


def _mean_rounded(long):
    """The SQL rounds the mean over groups (a sum of doubles), not the values themselves."""
    return long.withColumn("value", F.when(F.col("metric") == "mean_auc", F.round("value", 9)).otherwise(F.col("value")))


@register("oof_group_auc", "WITH " + _auc_long_sql(f"(SELECT grp, label, oof_pred AS s FROM {_OOF_SQL})")
          + "\nSELECT metric, value FROM lng")
def q_oof_group_auc(spark, sf):
    return _mean_rounded(E.oof_group_auc(_oof(spark, sf)))


@register("cv_summary", "WITH " + _auc_long_sql(
    f"(SELECT fold, grp, label, score AS s FROM {_FOLDED_SQL})", "fold") + """
SELECT metric, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS std, round(min(v), 9) AS min,
       round(max(v), 9) AS max, count(v)::bigint AS n_folds
FROM (SELECT metric, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM lng) GROUP BY metric""")
def q_cv_summary(spark, sf):
    a = FO.stratified_folds(V.assay(spark, sf), n_folds=5)
    per = M.group_auc(a, ["fold", "grp"], "label", "score")
    return rounded(M.cv_summary(_mean_rounded(M.metrics_long(per, "grp", "auc", by="fold"))), "mean", "std", "min", "max")


_STACK_SQL = f"""(SELECT key, 'score' AS model, score FROM {V.ASSAY_SQL}
  UNION ALL SELECT key, 'score2', score2 FROM {V.ASSAY_SQL}
  UNION ALL SELECT key, 'score3', score3 FROM {V.ASSAY_SQL})"""


def _stacked(spark, sf):
    return E.stack_scores(V.assay(spark, sf), "key", ["score", "score2", "score3"])


@register("ensemble_mean", f"""
SELECT key, round(avg(score), 9) AS ensemble, count(score)::bigint AS n_models FROM {_STACK_SQL} GROUP BY key""")
def q_ensemble_mean(spark, sf):
    return rounded(E.ensemble_mean(_stacked(spark, sf)), "ensemble")


@register("weighted_blend", f"""
SELECT key, round(sum(w * score), 9) AS blend FROM {_STACK_SQL} s
JOIN (VALUES ('score', 0.5::double), ('score2', 0.25::double), ('score3', 0.25::double)) wt(model, w)
  ON s.model = wt.model GROUP BY key""")
def q_weighted_blend(spark, sf):
    blend = E.weighted_blend(_stacked(spark, sf), {"score": 2.0, "score2": 1.0, "score3": 1.0})
    return rounded(blend, "blend")


@register("score_stats", f"""
SELECT model, count(v)::bigint AS n, round(min(v), 9) AS min_score, round(max(v), 9) AS max_score,
       round(avg(v), 9) AS mean_score
FROM (SELECT model, score AS v FROM {_STACK_SQL}
      UNION ALL SELECT 'ensemble', avg(score) FROM {_STACK_SQL} GROUP BY key) GROUP BY model""")
def q_score_stats(spark, sf):
    long = _stacked(spark, sf)
    ens = long.groupBy("key").agg(F.avg("score").alias("score")).select(
        "key", F.lit("ensemble").alias("model"), "score")
    return rounded(M.score_stats(long.unionByName(ens), "model", "score"), "min_score", "max_score", "mean_score")


# ------------------------------------------------------------------ template / submission

_TEMPLATE_SQL = f"(SELECT DISTINCT key::bigint AS id, 0.5::float AS binds FROM {V.UNLABELLED_SQL})"


def _write_template(spark, sf) -> str:
    t = V.unlabelled(spark, sf).select(F.col("key").cast("bigint").alias("id"),
                                       F.lit(0.5).cast("float").alias("binds")).distinct()
    return SF.write_csv(t, shared_dir(spark, "template"), order_by="id")


@register("template_roundtrip", f"SELECT * FROM {_TEMPLATE_SQL}")
def q_template_roundtrip(spark, sf):
    return SF.read_template(spark, _write_template(spark, sf))


def _unlabelled_preds(spark, sf):
    """Model output for all unlabelled documents; and one with faults on purpose:
    'es' documents unscored, labelled 'fr' documents scored (extra keys),
    'de' documents scored twice."""
    def scored(rows):
        return rows.select(F.col("key").cast("bigint").alias("id"), hash_unit("key", "p:").alias("pred"))
    u = V.unlabelled(spark, sf)
    extra = scored(V.docs(spark, sf).where(F.col("grp") == "fr"))
    faulty = scored(u.where(F.col("grp") != "es")).unionByName(extra).unionByName(scored(u.where(F.col("grp") == "de")))
    return scored(u), faulty


_HU_P = "((('0x' || substr(md5('p:' || key::varchar), 1, 8))::bigint % 100)::double / 100)"


@register("submission_join", f"""
SELECT t.id, {Q.clip('p.pred')}::float AS binds FROM {_TEMPLATE_SQL} t
LEFT JOIN (SELECT key::bigint AS id, {_HU_P} AS pred FROM {V.UNLABELLED_SQL}) p ON t.id = p.id""")
def q_submission_join(spark, sf):
    template = SF.read_template(spark, _write_template(spark, sf))
    good, _ = _unlabelled_preds(spark, sf)
    return E.create_submission(template, good, "id", "pred")


@register("template_key_check", f"""
WITH t AS (SELECT DISTINCT id FROM {_TEMPLATE_SQL}),
p AS (SELECT key::bigint AS id FROM {V.UNLABELLED_SQL} WHERE grp <> 'es'
      UNION ALL SELECT key::bigint FROM {V.DOCS_SQL} WHERE grp = 'fr'
      UNION ALL SELECT key::bigint FROM {V.UNLABELLED_SQL} WHERE grp = 'de'),
pc AS (SELECT id, count(*) AS c FROM p GROUP BY id),
j AS (SELECT t.id AS tid, pc.id AS pid, pc.c FROM t FULL OUTER JOIN pc ON t.id = pc.id)
SELECT sum(CASE WHEN tid IS NOT NULL THEN 1 ELSE 0 END)::bigint AS n_template,
       sum(coalesce(c, 0))::bigint AS n_predictions,
       sum(CASE WHEN c IS NULL THEN 1 ELSE 0 END)::bigint AS n_missing,
       sum(CASE WHEN tid IS NULL THEN 1 ELSE 0 END)::bigint AS n_extra,
       sum(CASE WHEN c > 1 THEN 1 ELSE 0 END)::bigint AS n_duplicate FROM j""")
def q_template_key_check(spark, sf):
    template = SF.read_template(spark, _write_template(spark, sf))
    _, faulty = _unlabelled_preds(spark, sf)
    return E.template_key_check(template, faulty, "id")


@register("synthetic_row_id", f"""
SELECT key, (row_number() OVER (ORDER BY key) - 1)::bigint AS row_id FROM {V.ASSAY_SQL}""")
def q_synthetic_row_id(spark, sf):
    from screenlake.operators.rank import key_position
    r = key_position(V.assay(spark, sf).select("key"), "key", "pos")
    return r.select("key", (F.col("pos") - 1).alias("row_id"))


# ------------------------------------------------------------------ scans, types

@register("scan_pruned", "SELECT doc_id, quality::tinyint AS quality FROM labels")
def q_scan_pruned(spark, sf):
    return SP.load_labelled(spark, f"{sf}/labels.parquet", ["doc_id", "quality"], label="quality")


@register("scan_first_n", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100""")
def q_scan_first_n(spark, sf):
    return SP.load_labelled(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"],
                            nrows=100, order_by="o_orderkey")


@register("scan_unlabelled", f"""
SELECT d.doc_id::int AS doc_id, d.lang, d.n_chars::int AS n_chars
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_scan_unlabelled(spark, sf):
    d = SP.load_unlabelled(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "n_chars"])
    lab = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return d.join(lab, "doc_id", "left_anti")


_ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("row_count", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*)::bigint AS n_rows FROM {t}" for t in _ALL_TABLES))
def q_row_count(spark, sf):
    parts = [SP.row_count(spark, f"{sf}/{t}.parquet").select(F.lit(t).alias("table_name"), "n_rows")
             for t in _ALL_TABLES]
    return E.union_all(parts)


_NARROW_COLS = {"orders": ["o_orderkey", "o_custkey"],
                "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
                "nation": ["n_nationkey", "n_regionkey"], "events": ["event_id", "user_id"]}


def _narrow_case(c: str) -> str:
    return (f"CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
            f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' "
            f"WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END")


@register("narrow_int_types", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, min({c})::bigint AS min_value, max({c})::bigint AS max_value, "
    f"{_narrow_case(c)} AS narrow_type FROM {t}" for t, cs in _NARROW_COLS.items() for c in cs))
def q_narrow_int_types(spark, sf):
    return E.union_all([SP.int_ranges(spark.read.parquet(f"{sf}/{t}.parquet"), cs)
                        for t, cs in _NARROW_COLS.items()])


@register("narrow_float", """
SELECT l_quantity::float AS l_quantity, l_extendedprice::float AS l_extendedprice,
       l_discount::float AS l_discount, l_tax::float AS l_tax FROM lineitem""")
def q_narrow_float(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return SP.narrow_types(li)


@register("dictionary_encode", f"""
SELECT o_orderkey, o_orderpriority,
  (dense_rank() OVER (ORDER BY {Q.kh('o_orderpriority')}, o_orderpriority) - 1)::int AS o_orderpriority_code
FROM orders""")
def q_dictionary_encode(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderpriority")
    return SP.dictionary_encode(o, "o_orderpriority")


@register("discover_files")
def q_discover_files(spark, sf):
    return SF.list_files(spark, sf, "*.parquet").select("path", "length")


# ------------------------------------------------------------------ features

_SRC_TEXTS = f"src AS {V.TEXTS_SQL}"


@register("hashed_fingerprint", f"""
WITH {_SRC_TEXTS}, g AS ({Q.grams('text')})
SELECT key, {Q.hash_bucket('gram', 512)} AS bit, count(*)::bigint AS cnt FROM g GROUP BY ALL""")
def q_hashed_fingerprint(spark, sf):
    return X.hashed_fingerprint(V.texts(spark, sf), nbits=512)


@register("pattern_keys", "\nUNION ALL\n".join(
    f"SELECT key, {i}::int AS key_id FROM {V.TEXTS_SQL} WHERE {Q.rcount('text', r)} >= {m}"
    for i, r, m in X.DEFAULT_PATTERNS))
def q_pattern_keys(spark, sf):
    return X.pattern_keys(V.texts(spark, sf))


# A table of 192 keys: digit pairs and words with an ending, each with its own minimum.
_KEY_TABLE = ([(i, f"{i:02d}", 1 + i % 3) for i in range(100)]
              + [(100 + 4 * i + j, f"{a}{e}", 1 + (i + j) % 4) for i, a in enumerate("abcdefghijklmnopqrstuvw") for j, e in enumerate(("er", "en[a-z]", "i?on", "re+s"))])


@register("pattern_keys_table", f"""
WITH k(key_id, regex, min_count) AS (VALUES {', '.join(f"({i}, '{r}', {m})" for i, r, m in _KEY_TABLE)}),
t AS (SELECT DISTINCT text FROM {V.TEXTS_SQL} WHERE text IS NOT NULL),
h AS (SELECT text, key_id FROM t, k WHERE len(regexp_extract_all(text, regex)) >= min_count)
SELECT d.key, h.key_id::int AS key_id FROM {V.TEXTS_SQL} d JOIN h ON d.text = h.text""")
def q_pattern_keys_table(spark, sf):
    table = spark.createDataFrame(_KEY_TABLE, "key_id int, regex string, min_count int")
    return X.pattern_keys_from_table(V.texts(spark, sf), table)


@register("text_descriptors", f"SELECT key, {Q.descriptors('text')} FROM {V.TEXTS_SQL}")
def q_text_descriptors(spark, sf):
    return X.text_descriptors(V.texts(spark, sf))


@register("invalid_text_rate", f"""
SELECT grp, count(*)::bigint AS n_rows, sum(CASE WHEN v THEN 0 ELSE 1 END)::bigint AS n_invalid,
  round(100.0::double * sum(CASE WHEN v THEN 0 ELSE 1 END)::double / count(*)::double, 9) AS pct_invalid
FROM (SELECT grp, {Q.valid("text")} AS v
      FROM {V.TEXTS_SQL}) GROUP BY grp""")
def q_invalid_text_rate(spark, sf):
    return rounded(P.invalid_text_rate(V.texts(spark, sf), by=["grp"]), "pct_invalid")


@register("distinct_featurize", f"""
SELECT key, length(text)::bigint AS k_chars, (length(text) - length(replace(text, ' ', '')))::bigint AS k_spaces,
  len(regexp_extract_all(text, '[0-9]'))::bigint AS k_digits, length(text) > 0 AS k_valid
FROM {V.TEXTS_SQL} WHERE text IS NOT NULL""")
def q_distinct_featurize(spark, sf):
    t = V.texts(spark, sf).where(F.col("text").isNotNull())
    return X.distinct_featurize(t).select("key", "k_chars", "k_spaces", "k_digits", "k_valid")


_OH_GROUPS = ["en", "fr", "de"]   # 'es' plays the unknown group


@register("group_onehot", f"""
SELECT key, {', '.join(f"CASE WHEN grp = '{g}' THEN 1.0::double ELSE 0.0::double END AS g_{g}" for g in _OH_GROUPS)}
FROM {V.DOCS_SQL}""")
def q_group_onehot(spark, sf):
    return X.group_onehot(V.docs(spark, sf).select("key", "grp"), _OH_GROUPS).drop("grp")


@register("group_label_encode", f"""
SELECT key, (CASE {' '.join(f"WHEN grp = '{g}' THEN {i}" for i, g in enumerate(_OH_GROUPS))} ELSE -1 END)::int
  AS group_idx FROM {V.TEXTS_SQL}""")
def q_group_label_encode(spark, sf):
    return X.group_label_encode(V.texts(spark, sf).select("key", "grp"), _OH_GROUPS).drop("grp")


_NB = 512
_ND = len(X.DESCRIPTOR_NAMES)
_FT_SQL = f"""
every_doc AS (SELECT key, grp, text FROM {V.DOCS_SQL}),
src AS (SELECT * FROM every_doc WHERE {Q.valid('text')}),
g AS ({Q.grams('text')}),
fp AS (SELECT key, {Q.hash_bucket('gram', _NB)} AS feature_idx, count(*)::double AS value FROM g GROUP BY ALL),
d AS (SELECT key, {Q.descriptors('text')} FROM src),
dl AS (UNPIVOT d ON {', '.join(X.DESCRIPTOR_NAMES)} INTO NAME nm VALUE v),
dd AS (SELECT key, ({_NB} + list_position({X.DESCRIPTOR_NAMES!r}, nm) - 1)::int AS feature_idx,
              v::double AS value FROM dl),
oh AS (SELECT key, ({_NB + _ND} + list_position({V.DOC_GROUPS!r}, grp) - 1)::int AS feature_idx,
              1.0::double AS value FROM every_doc WHERE grp IN {tuple(V.DOC_GROUPS)!r}),
ft AS (SELECT key, feature_idx::int AS feature_idx, value FROM fp WHERE value <> 0
       UNION ALL SELECT * FROM dd WHERE value <> 0 UNION ALL SELECT * FROM oh)"""


def _feature_table(spark, sf):
    return X.feature_table_long(V.docs(spark, sf), V.DOC_GROUPS, nbits=_NB)


@register("feature_table", f"WITH {_FT_SQL}\nSELECT key, feature_idx, value FROM ft")
def q_feature_table(spark, sf):
    return _feature_table(spark, sf)


@register("feature_dictionary", f"""
WITH {_FT_SQL}
SELECT feature_idx, CASE WHEN feature_idx < {_NB} THEN 'fp_' || feature_idx::varchar
    WHEN feature_idx < {_NB + _ND} THEN {X.DESCRIPTOR_NAMES!r}[feature_idx - {_NB - 1}]
    ELSE 'g_' || {V.DOC_GROUPS!r}[feature_idx - {_NB + _ND - 1}] END AS feature_name,
  count(*)::bigint AS n_rows FROM ft GROUP BY feature_idx""")
def q_feature_dictionary(spark, sf):
    names = X.feature_names(_NB, V.DOC_GROUPS)
    dim = spark.createDataFrame(list(enumerate(names)), "feature_idx int, feature_name string")
    used = _feature_table(spark, sf).groupBy("feature_idx").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    return used.join(F.broadcast(dim), "feature_idx")


@register("token_gain_topk", f"""
WITH src AS (SELECT key, label, text FROM {V.DOCS_SQL}),
g AS ({Q.grams('text')}),
kb AS (SELECT DISTINCT key, {Q.hash_bucket('gram', _NB)} AS bit FROM g),
lab AS (SELECT key, label FROM src),
tot AS (SELECT count(*) AS n_all, sum(label) AS p_all FROM lab),
pb AS (SELECT bit, count(*) AS n_docs, sum(label) AS n_pos FROM kb JOIN lab USING (key) GROUP BY bit),
s AS (SELECT bit, n_docs::bigint AS n_docs, n_pos::bigint AS n_pos,
        round((n_pos::double / n_docs::double) / (p_all::double / n_all::double), 9) AS lift FROM pb, tot)
SELECT bit, n_docs, n_pos, lift, (row_number() OVER (ORDER BY lift DESC, bit))::int AS rank FROM s
ORDER BY lift DESC, bit LIMIT 20""")
def q_token_gain_topk(spark, sf):
    return rounded(X.token_gain_topk(V.docs(spark, sf), k=20, nbits=_NB), "lift")


@register("csv_first_n", f"""
SELECT key, grp, label::tinyint AS label FROM {V.ASSAY_SQL} ORDER BY key LIMIT 50""")
def q_csv_first_n(spark, sf):
    # The whole view written as header CSV, read back with a declared
    # schema (label as tinyint), first 50 rows by key as the mock test set
    a = V.assay(spark, sf).select("key", "grp", "label")
    path = SF.write_csv(a, shared_dir(spark, "small-csv"))
    return SF.read_small_csv(spark, path, "key BIGINT, grp STRING, label TINYINT",
                             first_n=50, order_by="key")


# ------------------------------------------------------------------ building blocks

# Orders as assembled rows: a customer is a block; one status makes one heavy group.
_BLOCKS_SQL = f"""(SELECT a.key, a.grp, a.label, o.o_custkey AS blk, CASE WHEN o.o_orderstatus = 'P' THEN 'status P'
    ELSE 'customer ' || o.o_custkey::varchar END AS grp_key, o.o_orderpriority AS b1, o.o_orderstatus || ' ' || o.o_orderpriority AS b2
  FROM {V.ASSAY_SQL} a JOIN orders o ON a.key = o.o_orderkey)"""
DIVERSE_ROWS = 5000


def _blocks(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("grp"),
                    (F.col("o_totalprice") > V.ASSAY_PRICE_CUT).cast("int").alias("label"), F.col("o_custkey").alias("blk"),
                    F.when(F.col("o_orderstatus") == "P", "status P").otherwise(F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))).alias("grp_key"),
                    F.col("o_orderpriority").alias("b1"), F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("b2"))


@register("diversity_sample", f"""
WITH b AS {_BLOCKS_SQL}, per AS (SELECT blk, count(*) AS n FROM b GROUP BY blk),
lev AS (SELECT max(l) AS l FROM unnest(range(0, (SELECT max(n) + 1 FROM per))) AS t(l)
        WHERE (SELECT sum(least(n, l)) FROM per) <= {DIVERSE_ROWS}),
more AS (SELECT blk FROM per, lev WHERE n > l ORDER BY {Q.kh('blk')}, blk
         LIMIT (SELECT {DIVERSE_ROWS} - sum(least(n, l)) FROM per, lev)),
quota AS (SELECT per.blk, least(n, l) + CASE WHEN more.blk IS NULL THEN 0 ELSE 1 END AS q FROM per CROSS JOIN lev LEFT JOIN more ON per.blk = more.blk),
r AS (SELECT *, row_number() OVER (PARTITION BY blk ORDER BY {Q.kh('key')}, key) AS rn FROM b)
SELECT key, grp, label, r.blk FROM r JOIN quota ON r.blk = quota.blk WHERE rn <= q""")
def q_diversity_sample(spark, sf):
    return EN.diversity_sample(_blocks(spark, sf).select("key", "grp", "label", "blk"), "blk", DIVERSE_ROWS)


@register("block_features", f"""
WITH b AS {_BLOCKS_SQL}, s AS (SELECT key, 0 AS i, b1 AS text FROM b UNION ALL SELECT key, 1, b2 FROM b),
src AS (SELECT key::varchar || '/' || i::varchar AS key, key AS k, i, text FROM s), g AS ({Q.grams('text')}),
f AS (SELECT key, {Q.hash_bucket('gram', 256)} AS bit, count(*) AS c FROM g GROUP BY ALL)
SELECT split_part(key, '/', 1)::bigint AS key, (split_part(key, '/', 2)::int * 256 + bit)::int AS feature_idx, c::double AS value FROM f""")
def q_block_features(spark, sf):
    return EN.block_features(_blocks(spark, sf), ["b1", "b2"], nbits=256)


# The same placement: largest group first, where the greater of its fold's shares stays least.
_COST = ", ".join(f"greatest((lr[{i}] + h.n)::double / r::double, (lp[{i}] + h.p)::double / greatest(s, 1)::double)" for i in range(1, 6))
_ROOMS = [f"greatest(0.0::double, r::double / 5 - lr[{i}]::double)" for i in range(1, 6)]


@register("balanced_group_folds", f"""
WITH RECURSIVE b AS {_BLOCKS_SQL}, per AS (SELECT grp_key AS g, count(*) AS n, count(*) FILTER (label = 1) AS p FROM b GROUP BY grp_key),
tot AS (SELECT sum(n)::bigint AS r, sum(p)::bigint AS s FROM per),
heavy AS (SELECT g, n, p, row_number() OVER (ORDER BY n DESC, {Q.kh('g')}) AS k FROM per, tot WHERE n * 100 > r),
place(k, g, f, lr, lp) AS (
  SELECT 0::bigint, ''::varchar, 0::bigint, [0, 0, 0, 0, 0]::bigint[], [0, 0, 0, 0, 0]::bigint[]
  UNION ALL
  SELECT k, g, f, [lr[i] + CASE WHEN i = f THEN n ELSE 0 END for i in [1, 2, 3, 4, 5]], [lp[i] + CASE WHEN i = f THEN p ELSE 0 END for i in [1, 2, 3, 4, 5]]
  FROM (SELECT h.k, h.g, h.n, h.p, lr, lp, list_position([{_COST}], list_min([{_COST}]))::bigint AS f
        FROM place JOIN heavy h ON h.k = place.k + 1, tot)),
fin AS (SELECT lr FROM place ORDER BY k DESC LIMIT 1),
edges AS (SELECT {', '.join(f"({' + '.join(_ROOMS[:i])}) / ({' + '.join(_ROOMS)}) AS e{i}" for i in range(1, 5))} FROM fin, tot),
u AS (SELECT g, ('0x' || substr({Q.kh('g')}, 1, 8))::bigint::double / 4294967296.0::double AS u FROM per),
fold AS (SELECT u.g, coalesce(place.f - 1, CASE WHEN u < e1 THEN 0 WHEN u < e2 THEN 1 WHEN u < e3 THEN 2 WHEN u < e4 THEN 3 ELSE 4 END)::int AS fold
         FROM u CROSS JOIN edges LEFT JOIN place ON place.k > 0 AND place.g = u.g)
SELECT b.key, b.grp_key, fold.fold FROM b JOIN fold ON b.grp_key = fold.g""")
def q_balanced_group_folds(spark, sf):
    return EN.balanced_group_folds(_blocks(spark, sf).select("key", "grp_key", "label"), "grp_key").select("key", "grp_key", "fold")


_DECIDE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@register("encode_decision", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c})::double / greatest(count(*), 1)::double < 0.5 AS encode FROM orders" for c in _DECIDE_COLS))
def q_encode_decision(spark, sf):
    return SK.encode_decision(spark.read.parquet(f"{sf}/orders.parquet"), _DECIDE_COLS)
