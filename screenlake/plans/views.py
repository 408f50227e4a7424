"""The labelled / unlabelled views the operators run on, built from the given tables.

Each view exists twice: as a DataFrame (what the operators consume) and as a SQL
fragment the DuckDB oracle inlines. Both compute the same columns:

* ASSAY (orders): key, grp (order status), label (totalprice > 490000, ~2%),
  score / score2 / score3 (md5-derived, 100 levels, ties on purpose).
* ASSAY_BALANCED (events): key, grp (event type), label (value > 50, ~37%), score.
* DOCS (documents join labels): key, grp (lang), label (1 - quality), toxic, text.
* TEXTS (documents): key, grp, text.  UNLABELLED: documents without a label row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.functions.hashing import hash_unit

# Label rule of the ASSAY view and the score mixing weights.
ASSAY_PRICE_CUT = 490000
EVENT_VALUE_CUT = 50
ASSAY_GROUPS = ["F", "O", "P"]
DOC_GROUPS = ["de", "en", "es", "fr"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def assay(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    label = (F.col("o_totalprice") > F.lit(ASSAY_PRICE_CUT)).cast("int")
    return o.select(
        F.col("o_orderkey").alias("key"),
        F.col("o_orderstatus").alias("grp"),
        label.alias("label"),
        (hash_unit("o_orderkey") + F.lit(0.2) * label).alias("score"),
        (hash_unit("o_orderkey", "m2:") + F.lit(0.1) * label).alias("score2"),
        hash_unit("o_orderkey", "m3:").alias("score3"))


def _hash_unit_sql(expr: str, salt: str = "") -> str:
    inner = f"'{salt}' || {expr}::varchar" if salt else f"{expr}::varchar"
    return f"((('0x' || substr(md5({inner}), 1, 8))::bigint % 100)::double / 100)"


ASSAY_SQL = f"""(SELECT o_orderkey AS key, o_orderstatus AS grp,
    (o_totalprice > {ASSAY_PRICE_CUT})::int AS label,
    {_hash_unit_sql('o_orderkey')} + 0.2::double * (o_totalprice > {ASSAY_PRICE_CUT})::int::double AS score,
    {_hash_unit_sql('o_orderkey', 'm2:')} + 0.1::double * (o_totalprice > {ASSAY_PRICE_CUT})::int::double AS score2,
    {_hash_unit_sql('o_orderkey', 'm3:')} AS score3
  FROM orders)"""


def assay_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    label = (F.col("value") > F.lit(EVENT_VALUE_CUT)).cast("int")
    return e.select(F.col("event_id").alias("key"), F.col("event_type").alias("grp"),
                    label.alias("label"),
                    (hash_unit("event_id") + F.lit(0.2) * label).alias("score"))


ASSAY_BALANCED_SQL = f"""(SELECT event_id AS key, event_type AS grp,
    (value > {EVENT_VALUE_CUT})::int AS label,
    {_hash_unit_sql('event_id')} + 0.2::double * (value > {EVENT_VALUE_CUT})::int::double AS score
  FROM events)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("key"), F.col("lang").alias("grp"),
        (F.lit(1) - F.col("quality")).cast("int").alias("label"),
        F.col("toxic").cast("int").alias("toxic"), "text")


DOCS_SQL = """(SELECT d.doc_id AS key, d.lang AS grp, (1 - l.quality)::int AS label,
    l.toxic::int AS toxic, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), F.col("lang").alias("grp"), "text")


TEXTS_SQL = "(SELECT doc_id AS key, lang AS grp, text FROM documents)"


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"))
    return texts(spark, sf_dir).join(lab, "key", "left_anti")


UNLABELLED_SQL = """(SELECT d.doc_id AS key, d.lang AS grp, d.text FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))"""
