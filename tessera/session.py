"""Session construction and cluster-safe helpers (lineage cuts, sized broadcasts)."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "tessera", master: str | None = None,
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Only in local mode, where driver and
    tasks are one process, a private folder is created when it is unset; on a
    cluster that is an error, as executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured and not re.match(r"local(\[[^-]*\])?$", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike local checkpoints) and freezes any
    non-deterministic input so it is computed exactly once.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SIZE_CHECKS: dict = {}


def checked_broadcast(df: DataFrame, max_rows: int = 100_000, cache_key: str | None = None) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows.

    The check is a bounded action (``limit(max_rows + 1).count()``); above
    the bound the frame is returned unhinted and the planner falls back to a
    shuffle join (AQE may still convert it at runtime from real sizes).
    ``cache_key`` (e.g. the source path) reuses a check within the session.
    """
    key = (id(df.sparkSession), cache_key, max_rows) if cache_key else None
    if key is not None and key in _SIZE_CHECKS:
        small = _SIZE_CHECKS[key]
    else:
        small = df.limit(max_rows + 1).count() <= max_rows
        if key is not None:
            _SIZE_CHECKS[key] = small
    return F.broadcast(df) if small else df


_COSTLY_NODES = ("Join", "Aggregate", "Window", "Generate", "Sort", "Expand", "Union")


def is_costly(df: DataFrame) -> bool:
    """True when re-reading ``df`` recomputes joins/aggregates (not just a file scan)."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except Exception:  # no JVM handle (e.g. a remote session): assume costly
        return True
    if "InMemoryRelation" in plan:  # already served from the cache
        return False
    return any(n in plan for n in _COSTLY_NODES)


#: A forest holds, by estimate, up to 1 KB a row while it is fitted (its trees' weights of the row and the binned features) and reads that in every pass.
ROWS_PER_TRAINING_TASK = 200_000


def persist_sized(df: DataFrame, rows_per_partition: int = ROWS_PER_TRAINING_TASK, keep_slots: bool = True,
                  level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist ``df`` with about ``rows_per_partition`` rows per partition.

    Iterative learners (boosting rounds, tree levels, optimiser steps) run one
    job per step over every partition of their input; a training frame that
    comes out of a shuffle has ``spark.sql.shuffle.partitions`` partitions
    whatever its size, so small frames would pay per-task overhead on every
    step. The frame is counted once (materialising the cache), then narrowed
    with ``coalesce`` (no shuffle) when it has more partitions than its size
    needs, but not below the cluster's default parallelism. One with fewer, whose
    partitions would grow with the input, is dealt out anew. The caller unpersists the result.
    """
    d = df.persist(level)
    n = d.count()
    have = d.rdd.getNumPartitions()
    # never below the cluster's task slots (while the frame has that many partitions), unless several fits share them
    slots = min(have, df.sparkSession.sparkContext.defaultParallelism) if keep_slots else 1
    want = max(1, -(-n // rows_per_partition), slots)
    if want == have:
        return d
    c = (d.coalesce(want) if want < have else d.repartition(want)).persist(level)
    c.count()
    d.unpersist()
    return c


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, force: bool = False):
    """Keep ``df`` (usually a narrow column projection) across the passes of a
    multi-pass operator whose result is collected inside the block.

    Only done when re-reading would recompute joins or aggregates: a plain
    column-pruned parquet scan is cheaper to read again than to cache at
    scale. Lost blocks are recomputed from lineage, so executor loss is
    survivable; the cache is released on exit.
    """
    if not (force or is_costly(df)):
        yield df
        return
    d = df.persist(level)
    try:
        yield d
    finally:
        d.unpersist()
