from pyspark.sql import functions as F

from paths import SF0001
from screenlake.operators import features as X
from screenlake.plans import views as V
from screenlake.session import shared_dir
from screenlake.streaming import ingest as I


def test_stream_three_batches_and_rerun(spark):
    docs = V.table(spark, SF0001, "documents")
    src = I.stage_files(docs, 6, "doc_id", "t-src")
    sink, ck = shared_dir(spark, "t-sink"), shared_dir(spark, "t-ck")
    n1 = I.ingest(spark, src, docs.schema, sink, ck, 2, lambda s: s.select("doc_id"))
    assert n1 == 3
    assert spark.read.parquet(sink).count() == docs.count()
    n2 = I.ingest(spark, src, docs.schema, sink, ck, 2, lambda s: s.select("doc_id"))
    assert n2 == 0 and spark.read.parquet(sink).count() == docs.count()


def test_resumable_chunks(spark):
    rows = V.texts(spark, SF0001).withColumn("chunk_id", (F.col("key") / 50).cast("bigint"))
    out = shared_dir(spark, "t-chunks")
    first = I.resumable_chunk_job(rows, X.text_descriptors_with_chunk, out, max_chunks=2)
    assert first.count() == 4
    assert I.pending_chunks(rows, spark, out).count() == 2
    I.resumable_chunk_job(rows, X.text_descriptors_with_chunk, out)
    assert I.pending_chunks(rows, spark, out).count() == 0
    assert spark.read.parquet(out).count() == rows.count()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["metric", "value"]
    rows = {r.metric: r.value for r in df.collect()}
    assert "mean_auc" in rows and set(rows) == {"de_auc", "en_auc", "es_auc", "fr_auc", "mean_auc"}


def test_chunk_write_is_idempotent(spark):
    d = V.docs(spark, SF0001).select("key", "grp", "label")
    sink = shared_dir(spark, "t-idem")
    b0 = I.chunk_sample_batch(d.where("key < 100"), 0)
    b1 = I.chunk_sample_batch(d.where("key >= 100"), 1)
    I.write_chunk(b0, sink)
    I.write_chunk(b1, sink)
    n = spark.read.parquet(sink).count()
    I.write_chunk(b0, sink)                      # batch 0 re-executed after a failure
    assert spark.read.parquet(sink).count() == n
    pos = d.where("label = 1 and key < 100").count()
    got = spark.read.parquet(sink).where("chunk_id = 0")
    assert got.where("label = 1").count() == pos
    assert got.where("label = 0").count() <= 5 * pos


def test_stream_chunk_sample_end_to_end(spark):
    d = V.docs(spark, SF0001).select("key", "grp", "label")
    src = I.stage_files(d, 6, "key", "t-cs-src")
    sink, ck = shared_dir(spark, "t-cs-sink"), shared_dir(spark, "t-cs-ck")
    I.stream_chunk_sample(spark, src, d.schema, sink, ck, 2)
    out = spark.read.parquet(sink)
    assert out.where("label = 1").count() == d.where("label = 1").count()
    assert out.select("chunk_id").distinct().count() == 3


def test_run_screen_end_to_end(spark):
    from paths import SF001
    from screenlake.plans.screen import SMALL_TRAINER, ScreenConfig, run_screen, write_template
    u = V.unlabelled(spark, SF001)
    cfg = ScreenConfig(n_folds=2, trainer=SMALL_TRAINER, max_positive=None)
    out = run_screen(V.docs(spark, SF001), u, cfg, write_template(spark, u))
    sub = out["submission"]
    assert sub.count() == u.count()
    assert sub.where((F.col("binds") < 1e-6 * 0.999) | (F.col("binds") > 1 - 1e-6 * 0.999)
                     | F.col("binds").isNull()).count() == 0
    oof = out["oof"]
    assert oof.where(F.col("oof_pred").isNull()).count() == 0
    metrics = {r.metric for r in out["cv_summary"].collect()}
    assert "mean_auc" in metrics and "en_auc" in metrics


def test_submission_keeps_wide_keys(spark):
    from screenlake.operators import ensemble as E
    big = 2 ** 40
    t = spark.createDataFrame([(big + 1,), (big + 2,)], "id long")
    p = spark.createDataFrame([(big + 1, 0.3), (big + 2, 0.9)], "id long, pred double")
    out = {r.id: r.binds for r in E.create_submission(t, p, "id", "pred").collect()}
    assert set(out) == {big + 1, big + 2}
