"""Session construction and the shared work folder.

On a cluster the folder for checkpoints, sinks and run outputs is the one named
by ``spark.checkpoint.dir``; it must be shared storage visible to every executor.
A local folder is created only where the setting is absent and the master is
``local[...]`` (tests, laptops); a cluster without the setting raises.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "screenlake") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    ``master`` and ``shuffle_partitions`` are only applied when given: on a cluster
    the launcher decides them.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset.

    Order: ``spark.checkpoint.dir`` from the session, then a checkpoint folder
    already set on the context, then (tests only) a new local folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name shared storage on {sc.master}")
        d = tempfile.mkdtemp(prefix="screenlake-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_CONF, d)
        except Exception:   # core conf not settable at runtime in this session
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder for one run/sink."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    if "://" not in base:
        os.makedirs(path, exist_ok=True)
    return path


def materialize(df, name: str = "stage", sort_within: list[str] | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back. Used at stage boundaries of multi-pass operators (a two-level rank
    reads its input twice; chained stages would otherwise recompute their whole
    lineage once per reference) and before iterative work. Files in the shared
    folder survive executor loss; ``localCheckpoint`` is never used.

    ``sort_within`` fixes the row order inside each partition (shuffle output
    order varies between runs); row-sampling learners then repeat exactly."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Rows up to which a data-derived table is broadcast after its size is checked.
MAX_BROADCAST_ROWS = 1_000_000


def checked_broadcast(small, max_rows: int = MAX_BROADCAST_ROWS):
    """Broadcast ``small`` only when its row count (checked here) is at most
    ``max_rows``; otherwise return it unchanged so the join shuffles (with AQE
    skew splitting). ``small`` should be materialised: it is counted, then joined."""
    from pyspark.sql import functions as F
    return F.broadcast(small) if small.count() <= max_rows else small
