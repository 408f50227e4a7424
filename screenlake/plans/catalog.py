"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their SQL oracles.

Every query reads the given tables (or data Spark derives from them) in full.
Output columns are scalar and carry the same names and types as the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.functions.scores import clip_score
from screenlake.operators import metrics as M
from screenlake.plans import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, *cols: str, dp: int = 9) -> DataFrame:
    """Operators do not round; the comparison with SQL does, for sums of doubles."""
    return df.withColumns({c: F.round(c, dp) for c in cols})


# --------------------------------------------------------------------------- metrics

_AUC_SQL = """
WITH a AS {view},
c AS (SELECT grp, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::bigint AS pos,
             sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::bigint AS neg
      FROM a WHERE label IN (0, 1) AND score IS NOT NULL AND NOT isnan(score) AND grp IS NOT NULL
      GROUP BY grp, score),
r AS (SELECT *, sum(neg) OVER (PARTITION BY grp ORDER BY score
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM c),
p AS (SELECT grp, sum(pos)::bigint AS n_pos, sum(neg)::bigint AS n_neg,
             sum(pos * (2 * below + neg))::bigint AS num2 FROM r GROUP BY grp)
"""

_AUC_SELECT = """CASE WHEN n_pos > 0 AND n_neg > 0
       THEN num2::double / (n_pos::double * n_neg::double * 2.0::double) END"""


@register("group_auc", _AUC_SQL.format(view=V.ASSAY_SQL) +
          f"SELECT grp, n_pos, n_neg, {_AUC_SELECT} AS auc FROM p")
def q_group_auc(spark, sf):
    return M.group_auc(V.assay(spark, sf))


@register("group_auc_balanced", _AUC_SQL.format(view=V.ASSAY_BALANCED_SQL) +
          f"SELECT grp, n_pos, n_neg, {_AUC_SELECT} AS auc FROM p")
def q_group_auc_balanced(spark, sf):
    return M.group_auc(V.assay_balanced(spark, sf))


_GROUPS_P = "(VALUES ('F'), ('O'), ('P'), ('X')) AS dim(grp)"


@register("group_auc_with_gaps", _AUC_SQL.format(
    view=f"(SELECT * FROM {V.ASSAY_SQL} WHERE NOT (grp = 'O' AND label = 1))") + f"""
SELECT dim.grp, coalesce(p.n_pos, 0)::bigint AS n_pos, coalesce(p.n_neg, 0)::bigint AS n_neg,
       CASE WHEN p.n_pos > 0 AND p.n_neg > 0
            THEN p.num2::double / (p.n_pos::double * p.n_neg::double * 2.0::double) END AS auc
FROM {_GROUPS_P} LEFT JOIN p ON dim.grp = p.grp""")
def q_group_auc_with_gaps(spark, sf):
    # 'O' keeps only negatives (one class), 'X' is configured but has no rows.
    a = V.assay(spark, sf).where(~((F.col("grp") == "O") & (F.col("label") == 1)))
    return M.group_auc(a, groups=["F", "O", "P", "X"])


@register("macro_auc", _AUC_SQL.format(view=V.ASSAY_SQL) + f"""
SELECT round(avg({_AUC_SELECT}), 9) AS mean_auc, count({_AUC_SELECT})::bigint AS n_groups FROM p""")
def q_macro_auc(spark, sf):
    return rounded(M.macro_mean(M.group_auc(V.assay(spark, sf))), "mean_auc")


_AP_SQL = """
WITH a AS {view},
c AS (SELECT grp, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::bigint AS pos,
             count(*)::bigint AS n
      FROM a WHERE label IN (0, 1) AND score IS NOT NULL AND NOT isnan(score) AND grp IS NOT NULL
      GROUP BY grp, score),
r AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n FROM c
      WINDOW w AS (PARTITION BY grp ORDER BY score DESC
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT grp, sum(pos)::bigint AS n_pos, sum(n)::bigint AS n_rows,
       CASE WHEN sum(pos) > 0 THEN round(sum(pos::double * cum_pos::double / cum_n::double)
                                         / sum(pos)::double, 9) END AS average_precision
FROM r GROUP BY grp"""


@register("average_precision", _AP_SQL.format(view=V.ASSAY_SQL))
def q_average_precision(spark, sf):
    return rounded(M.average_precision(V.assay(spark, sf)), "average_precision")


@register("threshold_metrics", f"""
WITH a AS (SELECT * FROM {V.ASSAY_BALANCED_SQL}
           WHERE label IN (0, 1) AND score IS NOT NULL AND NOT isnan(score)),
t AS (SELECT CASE WHEN grouping(grp) = 1 THEN '__all__' ELSE grp END AS grp,
        sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END)::bigint AS tp,
        sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END)::bigint AS fp,
        sum(CASE WHEN score < 0.5 AND label = 1 THEN 1 ELSE 0 END)::bigint AS fn,
        sum(CASE WHEN score < 0.5 AND label = 0 THEN 1 ELSE 0 END)::bigint AS tn
      FROM a GROUP BY ROLLUP (grp))
SELECT grp, tp, fp, fn, tn,
  coalesce(round(CASE WHEN tp + fp > 0 THEN tp::double / (tp + fp)::double END, 9), 0.0) AS precision,
  coalesce(round(CASE WHEN tp + fn > 0 THEN tp::double / (tp + fn)::double END, 9), 0.0) AS recall,
  coalesce(round(CASE WHEN 2 * tp + fp + fn > 0
                      THEN (2 * tp)::double / (2 * tp + fp + fn)::double END, 9), 0.0) AS f1
FROM t""")
def q_threshold_metrics(spark, sf):
    return rounded(M.threshold_metrics(V.assay_balanced(spark, sf), threshold=0.5), "precision", "recall", "f1")


@register("clip_scores", f"""
SELECT key, grp, score,
  CASE WHEN score IS NULL OR isnan(score) THEN score ELSE least(greatest(score, 1e-6::double), 1.0::double - 1e-6::double) END
    AS clipped
FROM {V.ASSAY_SQL}""")
def q_clip_scores(spark, sf):
    a = V.assay(spark, sf)
    return a.select("key", "grp", "score", clip_score("score").alias("clipped"))


# --------------------------------------------------------------------------- sampling

from screenlake.operators import folds as FO  # noqa: E402
from screenlake.operators import profile as P  # noqa: E402
from screenlake.operators import sampling as S  # noqa: E402


from screenlake.plans.sql_text import kh as _kh  # noqa: E402


SAMPLE_CAP = 60            # binds at sf0.01 (about 97 positives per group)
CHUNK = 1000               # rows per chunk at test scale
WIN_CAP = 20               # positives per group per merge window
TOTAL_CAP = 1000           # kept-row cap


def _strat_sql(cap: int | None) -> str:
    def kp(n: str) -> str:           # kept positives of a stratum with ``n`` positives
        return f"least({n}, {cap})" if cap is not None else n
    return f"""
WITH a AS (SELECT * FROM {V.ASSAY_SQL} WHERE label IN (0, 1) AND grp IN ('F', 'O', 'P')),
r AS (SELECT key, grp, label,
             row_number() OVER (PARTITION BY grp, label ORDER BY {_kh('key')}, key) AS rn FROM a),
t AS (SELECT grp, label, count(*) AS n FROM a GROUP BY grp, label),
q AS (SELECT t.grp, t.label,
             CASE WHEN t.label = 1 THEN {kp('t.n')}
                  ELSE least(t.n, 5 * coalesce(p.kp, 0)) END AS quota
      FROM t LEFT JOIN (SELECT grp, {kp('n')} AS kp FROM t WHERE label = 1) p ON t.grp = p.grp)
SELECT r.key, r.grp, r.label, r.rn::bigint AS rn
FROM r JOIN q ON r.grp = q.grp AND r.label = q.label WHERE r.rn <= q.quota"""


@register("stratified_sample", _strat_sql(SAMPLE_CAP))
def q_stratified_sample(spark, sf):
    s = S.stratified_sample(V.assay(spark, sf), negative_ratio=5, max_positive=SAMPLE_CAP,
                            groups=V.ASSAY_GROUPS)
    return s.select("key", "grp", "label", "rn")


@register("stratified_sample_nocap", _strat_sql(None))
def q_stratified_sample_nocap(spark, sf):
    s = S.stratified_sample(V.assay(spark, sf), negative_ratio=5, max_positive=None,
                            groups=V.ASSAY_GROUPS)
    return s.select("key", "grp", "label", "rn")


_FOLDS_SQL = f"""(SELECT key, grp, label,
    ((row_number() OVER (PARTITION BY grp, label ORDER BY {_kh('key')}, key) - 1) % 5)::int AS fold
  FROM {V.ASSAY_SQL})"""


@register("stratified_folds", f"SELECT * FROM {_FOLDS_SQL}")
def q_stratified_folds(spark, sf):
    return FO.stratified_folds(V.assay(spark, sf), n_folds=5).select("key", "grp", "label", "fold")


@register("fold_split_counts", f"""
WITH f AS {_FOLDS_SQL},
v AS (SELECT fold, label, count(*) AS n_valid FROM f GROUP BY fold, label),
t AS (SELECT label, count(*) AS tot FROM f GROUP BY label)
SELECT v.fold, v.label, v.n_valid::bigint AS n_valid, (t.tot - v.n_valid)::bigint AS n_train
FROM v JOIN t ON v.label = t.label""")
def q_fold_split_counts(spark, sf):
    return FO.fold_split_counts(FO.stratified_folds(V.assay(spark, sf), n_folds=5))


@register("group_disjoint_folds", f"""
SELECT o_orderkey AS key, o_custkey AS entity,
       ((('0x' || substr({_kh('o_custkey')}, 1, 8))::bigint) % 5)::int AS fold FROM orders""")
def q_group_disjoint_folds(spark, sf):
    o = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"),
                                            F.col("o_custkey").alias("entity"))
    return FO.group_disjoint_folds(o, "entity", 5)


_PROFILE_COLS = """count(*)::bigint AS n_rows, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::bigint AS n_pos"""
_PROFILE_FINISH = """n_rows, n_pos, (n_rows - n_pos)::bigint AS n_neg,
  round(100.0::double * n_pos::double / n_rows::double, 9) AS pct_pos,
  CASE WHEN n_pos > 0 THEN round((n_rows - n_pos)::double / n_pos::double, 9)
       ELSE 'infinity'::double END AS neg_per_pos"""


@register("label_profile", f"""
SELECT {_PROFILE_FINISH} FROM (SELECT {_PROFILE_COLS} FROM {V.ASSAY_SQL})""")
def q_label_profile(spark, sf):
    return rounded(P.label_profile(V.assay(spark, sf)), "pct_pos", "neg_per_pos")


@register("group_label_profile", f"""
SELECT grp, {_PROFILE_FINISH} FROM (SELECT grp, {_PROFILE_COLS} FROM {V.ASSAY_BALANCED_SQL} GROUP BY grp)""")
def q_group_label_profile(spark, sf):
    return rounded(P.group_label_profile(V.assay_balanced(spark, sf)), "pct_pos", "neg_per_pos")


@register("profile_rollup", f"""
SELECT grp, level, {_PROFILE_FINISH} FROM (
  SELECT grp, grouping(grp)::int AS level, {_PROFILE_COLS} FROM {V.ASSAY_SQL} GROUP BY ROLLUP (grp))""")
def q_profile_rollup(spark, sf):
    return rounded(P.profile_rollup(V.assay(spark, sf)), "pct_pos", "neg_per_pos")


_CARD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]


@register("cardinality_ratio", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count(*)::bigint AS n_rows, count(DISTINCT {c})::bigint AS n_distinct,
  round(count(DISTINCT {c})::double / greatest(count(*), 1)::double, 9) AS ratio,
  round(count(DISTINCT {c})::double / greatest(count(*), 1)::double, 9) < 0.5 AS encode FROM orders"""
    for c in _CARD_COLS))
def q_cardinality_ratio(spark, sf):
    return rounded(P.cardinality_ratio(V.table(spark, sf, "orders"), _CARD_COLS), "ratio")


@register("split_label", f"""
SELECT sum(CASE WHEN coalesce(label = 1, false) THEN 1 ELSE 0 END)::bigint AS n_pos,
       sum(CASE WHEN NOT coalesce(label = 1, false) THEN 1 ELSE 0 END)::bigint AS n_rest,
       sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::bigint AS n_zero
FROM {V.ASSAY_BALANCED_SQL}""")
def q_split_label(spark, sf):
    return P.split_label(V.assay_balanced(spark, sf))


@register("known_groups_semi", f"""
SELECT key, grp, label FROM {V.ASSAY_SQL} WHERE grp IN (SELECT * FROM (VALUES ('F'), ('P'), ('Z')) g(grp))""")
def q_known_groups_semi(spark, sf):
    return P.known_groups(V.assay(spark, sf), ["F", "P", "Z"]).select("key", "grp", "label")


@register("min_positives_check", f"""
SELECT sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::bigint AS n_pos,
       sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) >= 50 AS ok FROM {V.ASSAY_SQL}""")
def q_min_positives_check(spark, sf):
    return P.min_positives_check(V.assay(spark, sf), minimum=50)


# chunk-window sampling ----------------------------------------------------------

_CHUNK_BASE = f"""
a AS (SELECT *, row_number() OVER (ORDER BY key) AS pos FROM {V.ASSAY_SQL}),
c AS (SELECT *, ((pos - 1) // {CHUNK})::bigint AS chunk_id, coalesce(label = 1, false) AS is_pos FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY chunk_id, is_pos ORDER BY {_kh('key')}, key) AS crn FROM c),
cp AS (SELECT chunk_id, sum(CASE WHEN is_pos THEN 1 ELSE 0 END) AS np FROM c GROUP BY chunk_id),
cs AS (SELECT r.* FROM r JOIN cp ON r.chunk_id = cp.chunk_id WHERE r.is_pos OR r.crn <= 5 * cp.np)"""

_WIN_BASE = _CHUNK_BASE + f""",
w AS (SELECT *, (chunk_id // 5)::bigint AS window_id FROM cs WHERE grp IN ('F', 'O', 'P')),
wr AS (SELECT *, row_number() OVER (PARTITION BY window_id, grp ORDER BY {_kh('key')}, key) AS wrn
       FROM w WHERE is_pos),
wc AS (SELECT key, grp, label, chunk_id, window_id FROM wr WHERE wrn <= {WIN_CAP}
       UNION ALL SELECT key, grp, label, chunk_id, window_id FROM w WHERE NOT is_pos)"""

_STOP_BASE = _WIN_BASE + f""",
wn AS (SELECT window_id, count(*) AS n FROM wc GROUP BY window_id),
wk AS (SELECT window_id FROM (SELECT window_id, sum(n) OVER (ORDER BY window_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before FROM wn) WHERE before < {TOTAL_CAP}),
es AS (SELECT * FROM wc WHERE window_id IN (SELECT window_id FROM wk))"""


def _chunk_sampled(spark, sf):
    return S.chunk_sample(V.assay(spark, sf), chunk_size=CHUNK, negative_ratio=5)


def _win_capped(spark, sf):
    from screenlake.session import materialize
    return materialize(S.window_positive_cap(_chunk_sampled(spark, sf), max_per_group=WIN_CAP,
                                             merge_interval=5, groups=V.ASSAY_GROUPS), "window-capped")


@register("chunk_sample", "WITH " + _CHUNK_BASE + """
SELECT key, grp, label, chunk_id, pos::bigint AS pos FROM cs""")
def q_chunk_sample(spark, sf):
    return _chunk_sampled(spark, sf).select("key", "grp", "label", "chunk_id", "pos")


@register("chunk_sample_validator", "WITH " + _CHUNK_BASE.replace(
    "FROM a),\nr AS", "FROM a WHERE coalesce(label = 1, false) OR label = 0),\nr AS")
    .replace("5 * cp.np", "20 * cp.np") + """
SELECT key, grp, label, chunk_id FROM cs""")
def q_chunk_sample_validator(spark, sf):
    # The validator's variant, ratio 20 and only label == 0 as negatives.
    s = S.chunk_sample(V.assay(spark, sf), chunk_size=CHUNK, negative_ratio=20, negatives="zero")
    return s.select("key", "grp", "label", "chunk_id")


@register("window_positive_cap", "WITH " + _WIN_BASE + """
SELECT key, grp, label, chunk_id, window_id FROM wc""")
def q_window_positive_cap(spark, sf):
    return _win_capped(spark, sf).select("key", "grp", "label", "chunk_id", "window_id")


@register("early_stop_windows", "WITH " + _STOP_BASE + """
SELECT key, grp, label, chunk_id, window_id FROM es""")
def q_early_stop_windows(spark, sf):
    s = S.early_stop_windows(_win_capped(spark, sf), TOTAL_CAP)
    return s.select("key", "grp", "label", "chunk_id", "window_id")


@register("truncate_to_cap", "WITH " + _STOP_BASE + f""",
sh AS (SELECT *, row_number() OVER (ORDER BY {_kh('key')}, key) AS shuffle_pos FROM es)
SELECT key, grp, label, shuffle_pos::bigint AS shuffle_pos FROM sh WHERE shuffle_pos <= 600""")
def q_truncate_to_cap(spark, sf):
    from screenlake.session import materialize
    s = materialize(S.early_stop_windows(_win_capped(spark, sf), TOTAL_CAP), "early-stopped")
    return S.truncate_to_cap(s, 600).select("key", "grp", "label", "shuffle_pos")


@register("chunk_running_totals", "WITH " + _CHUNK_BASE + """,
sc AS (SELECT chunk_id, count(*) AS rows_scanned, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos_found
       FROM c GROUP BY chunk_id),
kc AS (SELECT chunk_id, count(*) AS rows_kept FROM cs GROUP BY chunk_id),
t AS (SELECT sc.chunk_id, rows_scanned, pos_found, coalesce(rows_kept, 0) AS rows_kept
      FROM sc LEFT JOIN kc ON sc.chunk_id = kc.chunk_id)
SELECT chunk_id, rows_scanned::bigint AS rows_scanned, pos_found::bigint AS pos_found,
  rows_kept::bigint AS rows_kept,
  (sum(rows_scanned) OVER w)::bigint AS total_rows_scanned,
  (sum(pos_found) OVER w)::bigint AS total_pos_found,
  (sum(rows_kept) OVER w)::bigint AS total_rows_kept
FROM t WINDOW w AS (ORDER BY chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_chunk_running_totals(spark, sf):
    a = V.assay(spark, sf)
    return P.running_totals(S.chunk_sample(a, chunk_size=CHUNK), S.chunk_ids(a, chunk_size=CHUNK))


@register("prefix_batches", f"""
SELECT key, pos::bigint AS pos FROM (SELECT key, row_number() OVER (ORDER BY key) AS pos FROM {V.ASSAY_SQL})
WHERE pos <= 3000""")
def q_prefix_batches(spark, sf):
    return S.prefix_batches(V.assay(spark, sf), n_rows=2500, batch_size=1000).select("key", "pos")


@register("shuffled_order", f"""
SELECT key, grp, (row_number() OVER (ORDER BY {_kh('key')}, key))::bigint AS shuffle_pos FROM {V.ASSAY_SQL}""")
def q_shuffled_order(spark, sf):
    return S.shuffled_order(V.assay(spark, sf).select("key", "grp"))


@register("union_classes", f"""
SELECT key, grp, label, 'pos' AS part FROM {V.ASSAY_SQL} WHERE label = 1
UNION ALL
SELECT key, grp, label, 'neg' AS part FROM ({_strat_sql(None)}) WHERE label = 0""")
def q_union_classes(spark, sf):
    a = V.assay(spark, sf)
    pos = a.where(F.col("label") == 1).select("key", "grp", "label", F.lit("pos").alias("part"))
    neg = (S.stratified_sample(a, max_positive=None, groups=V.ASSAY_GROUPS)
           .where(F.col("label") == 0).select("key", "grp", "label", F.lit("neg").alias("part")))
    return pos.unionByName(neg)

from screenlake.plans import queries_data  # noqa: E402,F401
from screenlake.plans import queries_ml  # noqa: E402,F401
from screenlake.plans import queries_stream  # noqa: E402,F401
