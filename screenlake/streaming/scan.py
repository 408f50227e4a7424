"""A chunked scan that keeps running totals, stops when it has enough, and resumes.

One bounded stream of files does it all:

* chunks are micro-batches of at most ``max_bytes`` of files (or ``max_files`` files), so
  their size follows from the input, and the table is read where it lies;
* the totals of a chunk (rows scanned, positives found, rows kept) are metrics that
  ``DataFrame.observe`` collects while the chunk is read and written: no extra pass;
* once ``max_total`` rows are kept, the next chunk ends the query before a row of it is
  read, and stays uncommitted: a later run with a higher cap goes on exactly there;
* a run lives in one folder named by a hash of the source, its schema and the settings.
  Its manifest says what it is for: continuing it with anything else raises
  ``IncompatibleRun`` instead of mixing two outputs;
* the stream's checkpoint is the only ledger. A chunk that failed is given again with the
  same number and the same files, and replaces its own partitions of the sinks.

The folder has ``manifest``, ``data/chunk_id=..``, ``totals/chunk_id=..``, ``checkpoint``.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from screenlake.operators.rank import random_rank
from screenlake.session import ensure_checkpoint_dir
from screenlake.streaming.ingest import CHUNK_BYTES, file_stream, read_if_there

TOTALS = ("rows_scanned", "pos_found", "rows_kept")


class IncompatibleRun(ValueError):
    """The folder belongs to a run with another source, schema or settings."""


class _Enough(Exception):
    """Raised inside the stream to end it before a chunk is read."""


@dataclass(frozen=True)
class ScanRun:
    path: str

    def folder(self, name: str) -> str:
        return os.path.join(self.path, name)


def open_run(spark: SparkSession, source: str, schema: StructType, settings: dict, path: str | None = None) -> ScanRun:
    """The run for this source, schema and settings (anything JSON can hold). Without ``path``
    its folder, under ``spark.checkpoint.dir``, is named by their hash; with it, a folder that
    was begun for something else raises."""
    manifest = json.dumps({"source": source, "schema": json.loads(schema.json()), "settings": settings}, sort_keys=True)
    if path is None:
        path = os.path.join(ensure_checkpoint_dir(spark), "scan-" + hashlib.sha256(manifest.encode()).hexdigest()[:24])
    found = read_if_there(spark, os.path.join(path, "manifest"), "text")
    lines = [r.value for r in found.collect()] if found is not None else []
    if not lines:
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "manifest"))
    elif lines != [manifest]:
        raise IncompatibleRun(f"{path} was begun with other settings: {lines[0]} is not {manifest}")
    return ScanRun(path)


def chunk_sampler(label: str = "label", key: str = "key", negative_ratio: int = 5, seed: int = 42) -> Callable[[DataFrame, dict], DataFrame]:
    """Keeps all positives of a chunk and ``negative_ratio`` times as many of its other rows,
    by hash rank; the number of positives comes from the chunk's observed totals."""
    def keep(chunk: DataFrame, totals: dict) -> DataFrame:
        is_pos = F.coalesce(F.col(label) == 1, F.lit(False))
        quota = negative_ratio * totals["pos_found"]
        rest = random_rank(chunk.where(~is_pos), [], key, seed, "__rn", limit=quota)
        return chunk.where(is_pos).unionByName(rest.where(F.col("__rn") <= quota).drop("__rn"))
    return keep


def _observed(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def scan(spark: SparkSession, run: ScanRun, source: str, schema: StructType, keep: Callable[[DataFrame, dict], DataFrame] | None = None,
         prepare: Callable[[DataFrame], DataFrame] | None = None, label: str | None = "label", max_total: int | None = None,
         max_bytes: int = CHUNK_BYTES, max_files: int | None = None) -> int:
    """Scan what is still to scan; returns the rows read by this call.

    ``prepare`` is a projection, filter or join with a static table, row by row; ``keep``
    gets the prepared chunk and its totals so far and returns what goes to ``data``
    (None: all of it). The chunk is held while it is counted and then kept, so its files
    are read once."""
    done = read_if_there(spark, run.folder("totals"))
    kept = {r.chunk_id: r.rows_kept for r in done.select("chunk_id", "rows_kept").collect()} if done is not None else {}
    state = {"enough": False, "read": 0}
    pos = F.count(F.when(F.col(label) == 1, 1)) if label else F.lit(0).cast("bigint")

    def each(batch: DataFrame, chunk_id: int) -> None:
        if max_total is not None and sum(n for c, n in kept.items() if c < chunk_id) >= max_total:
            state["enough"] = True
            raise _Enough
        chunk = (prepare(batch) if prepare else batch).persist()
        try:
            counted, seen = _observed(chunk, rows_scanned=F.count(F.lit(1)), pos_found=pos if label else F.sum(pos))
            counted.write.format("noop").mode("overwrite").save()
            totals = {n: seen.get[n] or 0 for n in ("rows_scanned", "pos_found")}
            out, stored = _observed(keep(chunk, totals) if keep else chunk, rows_kept=F.count(F.lit(1)))
            _write_chunk(out, chunk_id, run.folder("data"))
            totals["rows_kept"] = stored.get["rows_kept"] or 0
            one = spark.createDataFrame([tuple(int(totals[n]) for n in TOTALS)], ", ".join(f"{n} bigint" for n in TOTALS))
            _write_chunk(one.coalesce(1), chunk_id, run.folder("totals"))
            kept[chunk_id] = totals["rows_kept"]
            state["read"] += totals["rows_scanned"]
        finally:
            chunk.unpersist()

    query = (file_stream(spark, source, schema, max_files, max_bytes).writeStream
             .option("checkpointLocation", run.folder("checkpoint")).foreachBatch(each).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not state["enough"]:
            raise
    return state["read"]


def _write_chunk(out: DataFrame, chunk_id: int, sink: str) -> None:
    """Replace the partition of one chunk: a chunk that is given again writes no row twice."""
    (out.withColumn("chunk_id", F.lit(chunk_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("chunk_id").parquet(sink))


def running_totals(spark: SparkSession, run: ScanRun) -> DataFrame:
    """Per chunk of the run its totals and their running sums; a row per chunk."""
    per = read_if_there(spark, run.folder("totals"))
    if per is None:
        per = spark.createDataFrame([], ", ".join(f"{n} bigint" for n in (*TOTALS, "chunk_id")))
    w = Window.orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.select(F.col("chunk_id").cast("bigint"), *TOTALS, *[F.sum(n).over(w).alias(f"total_{n}") for n in TOTALS])
