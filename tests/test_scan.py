"""The chunked scan: totals while reading, a stop that reads no more, resume after a kill."""
import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from screenlake.session import shared_dir
from screenlake.streaming import scan as SC


@pytest.fixture
def source(spark):
    path = shared_dir(spark, "t-scan-src")
    spark.range(12000).select(F.col("id").alias("key"), (F.col("id") % 40 == 0).cast("int").alias("label")).repartition(12, "key").write.mode("overwrite").parquet(path)
    return path, spark.read.parquet(path).schema


def test_totals_are_collected_in_one_scan(spark, source):
    path, schema = source
    run = SC.open_run(spark, path, schema, {"ratio": 5})
    assert SC.scan(spark, run, path, schema, SC.chunk_sampler(negative_ratio=5), max_files=3) == 12000
    t = SC.running_totals(spark, run).orderBy("chunk_id").collect()
    assert len(t) == 4 and (t[-1].total_rows_scanned, t[-1].total_pos_found, t[-1].total_rows_kept) == (12000, 300, 1800)
    got = spark.read.parquet(run.folder("data"))
    assert got.count() == got.select("key").distinct().count() == 1800 and got.where("label = 1").count() == 300


def test_scan_stops_reading_and_goes_on_later(spark, source):
    path, schema = source
    run = SC.open_run(spark, path, schema, {"stop": True})
    read = SC.scan(spark, run, path, schema, SC.chunk_sampler(), max_total=500, max_files=3)
    kept = spark.read.parquet(run.folder("data")).count()
    assert read < 12000 and kept >= 500 and SC.running_totals(spark, run).count() < 4
    assert SC.scan(spark, run, path, schema, SC.chunk_sampler(), max_total=500, max_files=3) == 0
    assert read + SC.scan(spark, run, path, schema, SC.chunk_sampler(), max_files=3) == 12000
    assert spark.read.parquet(run.folder("data")).count() == 1800


@pytest.mark.parametrize("after_write", [False, True])
def test_a_killed_run_resumes_without_loss_or_repeats(spark, source, after_write, monkeypatch):
    path, schema = source
    run = SC.open_run(spark, path, schema, {"kill": after_write})
    write = SC._write_chunk

    def dies(out, chunk_id, sink):
        if after_write:
            write(out, chunk_id, sink)
        if chunk_id == 2:
            raise RuntimeError("killed")
        if not after_write:
            write(out, chunk_id, sink)
    monkeypatch.setattr(SC, "_write_chunk", dies)
    with pytest.raises(StreamingQueryException):
        SC.scan(spark, run, path, schema, max_files=3)
    monkeypatch.setattr(SC, "_write_chunk", write)
    read = SC.scan(spark, run, path, schema, max_files=3)
    got = spark.read.parquet(run.folder("data"))
    assert read == got.where("chunk_id >= 2").count() < 12000
    assert got.count() == got.select("key").distinct().count() == 12000
    assert [r.chunk_id for r in SC.running_totals(spark, run).orderBy("chunk_id").collect()] == [0, 1, 2, 3]


def test_another_configuration_is_refused(spark, source):
    path, schema = source
    run = SC.open_run(spark, path, schema, {"fingerprint": "both"})
    assert SC.open_run(spark, path, schema, {"fingerprint": "both"}) == run
    assert SC.open_run(spark, path, schema, {"fingerprint": "keys"}).path != run.path
    with pytest.raises(SC.IncompatibleRun):
        SC.open_run(spark, path, schema, {"fingerprint": "keys"}, run.path)
    with pytest.raises(SC.IncompatibleRun):
        SC.open_run(spark, path + "-other", schema, {"fingerprint": "both"}, run.path)


def test_only_a_missing_path_means_nothing_done(spark, tmp_path):
    assert SC.read_if_there(spark, str(tmp_path / "none")) is None
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("no table")
    with pytest.raises(Exception):
        SC.read_if_there(spark, str(bad)).count()
