"""Registered streaming / resumable-ingest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.operators import features as X
from screenlake.plans import sql_text as Q
from screenlake.plans import views as V
from screenlake.plans.catalog import register
from screenlake.session import shared_dir
from screenlake.streaming import ingest as I
from screenlake.streaming import scan as SC

CHUNK_DOCS = 100


@register("stream_ingest", "SELECT doc_id, lang, n_chars FROM documents")
def q_stream_ingest(spark, sf):
    docs = V.table(spark, sf, "documents")
    sink, ck = shared_dir(spark, "stream-sink"), shared_dir(spark, "stream-ckpt")
    I.ingest(spark, f"{sf}/documents.parquet", docs.schema, sink, ck,
             transform=lambda s: s.select("doc_id", "lang", "n_chars"))
    return spark.read.parquet(sink)


def _labels_scan(spark, sf, name, keep=None):
    """The labels as chunks, each joined with the documents' languages, in a run of its own."""
    labels, docs = V.table(spark, sf, "labels"), V.table(spark, sf, "documents")
    lang = docs.select(F.col("doc_id").alias("key"), F.col("lang").alias("grp"))
    source = f"{sf}/labels.parquet"
    run = SC.open_run(spark, source, labels.schema, {"query": name}, shared_dir(spark, name))
    SC.scan(spark, run, source, labels.schema, keep, lambda b: b.select(
        F.col("doc_id").alias("key"), (F.lit(1) - F.col("quality")).cast("int").alias("label")).join(lang, "key"))
    return run


@register("stream_chunk_sample")
def q_stream_chunk_sample(spark, sf):
    run = _labels_scan(spark, sf, "chunk-sample", SC.chunk_sampler())
    return spark.read.parquet(run.folder("data")).select("key", "grp", "label", F.col("chunk_id").cast("bigint"))


@register("scan_totals", """
SELECT count(*)::bigint AS rows_scanned, sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END)::bigint AS pos_found,
       count(*)::bigint AS rows_kept FROM labels JOIN documents USING (doc_id)""")
def q_scan_totals(spark, sf):
    # A18 taken while scanning: the last running totals of the scan
    t = SC.running_totals(spark, _labels_scan(spark, sf, "scan-totals"))
    return t.agg(*[F.max(f"total_{n}").alias(n) for n in SC.TOTALS])


@register("resumable_features", f"SELECT key, {Q.descriptors('text')} FROM {V.TEXTS_SQL}")
def q_resumable_features(spark, sf):
    docs, source = V.table(spark, sf, "documents"), f"{sf}/documents.parquet"
    settings = {"features": X.DESCRIPTOR_NAMES}
    path = shared_dir(spark, "features-run")

    def feats(s):
        return X.text_descriptors(s.select(F.col("doc_id").alias("key"), "text"))

    for _ in range(2):      # the rerun reads and adds nothing
        run = SC.open_run(spark, source, docs.schema, settings, path)
        SC.scan(spark, run, source, docs.schema, prepare=feats, label=None)
    return spark.read.parquet(run.folder("data")).drop("chunk_id")


@register("resume_pending", f"""
SELECT DISTINCT (doc_id // {CHUNK_DOCS})::bigint AS chunk_id FROM documents
WHERE (doc_id // {CHUNK_DOCS}) NOT IN
  (SELECT c FROM (SELECT DISTINCT doc_id // {CHUNK_DOCS} AS c FROM documents) ORDER BY c LIMIT 4)""")
def q_resume_pending(spark, sf):
    rows = V.texts(spark, sf).withColumn(
        "chunk_id", F.floor(F.col("key") / F.lit(CHUNK_DOCS)).cast("bigint"))
    out = shared_dir(spark, "chunks-out")
    # an interrupted first run completes 4 chunks; the ledger then names the rest
    I.resumable_chunk_job(rows, X.text_descriptors_with_chunk, out, max_chunks=4)
    return I.pending_chunks(rows, spark, out)
