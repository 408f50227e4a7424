"""Incremental, resumable ingestion.

The reference reads a parquet file batch by batch, keeps running totals and
resumes a feature job at chunk granularity from a JSON ledger. Here:

* M1/S5: a file ``readStream`` with ``maxFilesPerTrigger`` and
  ``trigger(availableNow=True)``: a bounded stream processed in micro-batches.
* M2: ``foreachBatch`` samples each micro-batch (the batch id is the chunk id)
  and writes it with *dynamic partition overwrite* of that chunk's partition,
  so a batch re-executed after a failure replaces its output instead of
  duplicating it.
* M3/S9: the streaming checkpoint is the ledger: a rerun over the same
  source adds no rows (exactly-once file sink).
* J7: for batch jobs, pending chunks = all chunk ids ``left_anti`` the chunk
  ids already present in the output table.

Checkpoints and sinks live under the shared folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.operators.rank import random_rank
from screenlake.session import shared_dir

CHUNK_BYTES = 512 << 20     # of files in a micro-batch


def stage_files(df: DataFrame, n_files: int, key: str, name: str = "stage") -> str:
    """Write ``df`` as ``n_files`` parquet files (hash-partitioned by key) in a
    fresh shared folder; the input of a file stream."""
    path = shared_dir(df.sparkSession, name)
    df.repartition(n_files, key).write.mode("overwrite").parquet(path)
    return path


def file_stream(spark: SparkSession, src: str, schema, max_files: int | None = None,
                max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """M1: a bounded stream of the files of ``src`` (a folder or one file) where they lie,
    ``max_bytes`` of them per micro-batch, or ``max_files`` files."""
    stream = spark.readStream.schema(schema)
    stream = stream.option("maxFilesPerTrigger", max_files) if max_files else \
        stream.option("maxBytesPerTrigger", max_bytes)
    src = src.rstrip("/")
    return stream.parquet(f"{src[:-1]}[{src[-1]}]")      # a pattern may name a single file


def run_to_sink(stream: DataFrame, sink: str, checkpoint: str,
                partition_by: list[str] | None = None) -> int:
    """Drain a stream into a parquet sink (exactly once via the checkpoint);
    returns the number of micro-batches this run executed."""
    w = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(sink)
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p.get("numInputRows", 0) > 0)


def ingest(spark: SparkSession, src: str, schema, sink: str, checkpoint: str,
           max_files: int | None = None, transform=None) -> int:
    """M1/M3: stream ``src`` through an optional stateless ``transform`` into
    ``sink``. Rerunning with the same checkpoint processes only new files."""
    s = file_stream(spark, src, schema, max_files)
    if transform is not None:
        s = transform(s)
    return run_to_sink(s, sink, checkpoint)


def chunk_sample_batch(batch: DataFrame, chunk_id: int, label: str = "label", key: str = "key",
                       negative_ratio: int = 5, seed: int = 42) -> DataFrame:
    """W2 on one micro-batch: all positives plus ``ratio * positives``
    negatives of the batch (none if the batch has no positives)."""
    is_pos = F.coalesce(F.col(label) == 1, F.lit(False))
    x = batch.withColumn("__pos", is_pos)
    n_pos = x.where(F.col("__pos")).count()          # one scalar per micro-batch
    neg = random_rank(x.where(~F.col("__pos")), [], key, seed, "__rn",
                      limit=negative_ratio * n_pos)
    neg = neg.where(F.col("__rn") <= negative_ratio * n_pos).drop("__rn")
    return (x.where(F.col("__pos")).unionByName(neg).drop("__pos")
            .withColumn("chunk_id", F.lit(chunk_id).cast("bigint")))


def write_chunk(out: DataFrame, sink: str, chunk: str = "chunk_id") -> None:
    """Keyed, idempotent append: only the partitions of the chunks present in
    ``out`` are replaced, so re-running a micro-batch never duplicates rows."""
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(chunk).parquet(sink))


def stream_chunk_sample(spark: SparkSession, src: str, schema, sink: str, checkpoint: str,
                        max_files: int = 2, negative_ratio: int = 5, label: str = "label",
                        key: str = "key") -> int:
    """M2: per-micro-batch sampling with an idempotent keyed append."""
    def each(batch: DataFrame, batch_id: int):
        write_chunk(chunk_sample_batch(batch, batch_id, label, key, negative_ratio), sink)

    q = (file_stream(spark, src, schema, max_files).writeStream
         .option("checkpointLocation", checkpoint).foreachBatch(each)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(q.recentProgress)


def read_if_there(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``; None only if there is no such path (any other error is raised)."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        # a run that has not written yet has an empty folder at most
        if e.getCondition() == "PATH_NOT_FOUND" or e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def completed_chunks(spark: SparkSession, out_dir: str, chunk: str = "chunk_id") -> DataFrame:
    """The ledger: chunk ids already written to ``out_dir`` (empty if none)."""
    done = read_if_there(spark, out_dir)
    if done is None:
        return spark.createDataFrame([], f"{chunk} bigint")
    return done.select(chunk).distinct()


def pending_chunks(all_rows: DataFrame, spark: SparkSession, out_dir: str,
                   chunk: str = "chunk_id") -> DataFrame:
    """Chunk ids of the input not yet in the output."""
    return (all_rows.select(chunk).distinct()
            .join(completed_chunks(spark, out_dir, chunk), chunk, "left_anti"))


def resumable_chunk_job(rows: DataFrame, featurize, out_dir: str, chunk: str = "chunk_id",
                        max_chunks: int | None = None) -> DataFrame:
    """Featurize only pending chunks and write each chunk's partition with
    dynamic overwrite (a chunk is written whole or rewritten whole).
    ``max_chunks`` bounds one run (an interrupted run processes the first
    pending chunks). Returns the pending chunk ids *before* this run."""
    spark = rows.sparkSession
    todo = pending_chunks(rows, spark, out_dir, chunk)
    take = todo.orderBy(chunk).limit(max_chunks) if max_chunks else todo
    part = rows.join(take, chunk, "left_semi")
    (featurize(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(chunk).parquet(out_dir))
    return todo
