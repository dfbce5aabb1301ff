"""What the corpus operators share: scratch tables, streamed Arrow batches, text constants."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

#: White space of the contracts: space and the control characters tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: One word, as a pattern for Java, DuckDB and Python alike.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that may be broadcast after they have been counted.
BROADCAST_ROWS = 100_000
#: Rows of one Arrow batch sent to Python, so that a batch of long texts stays small.
BATCH_ROWS = 1_000


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label) + "/t"
    schema = df.schema
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(schema).parquet(path)


def small_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a stored table of at most ``max_rows`` counted rows; larger ones are left to a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept; pure ASCII takes the quick way."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` applied to every Arrow batch of ``df`` inside the tasks."""
    batches(df.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                yield fn(b)

    return df.mapInArrow(run, schema)


def batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches to ``rows`` rows in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def id_edges(docs: DataFrame, buckets: int) -> list[int]:
    """Ascending cuts of ``doc_id`` into about ``buckets`` equal ranges (a bounded quantile sketch of one column)."""
    if buckets < 2:
        return []
    at = [i / buckets for i in range(1, buckets)]
    cuts = docs.agg(F.percentile_approx("doc_id", at, 10_000)).first()[0]
    return sorted({int(c) for c in cuts or []})


def id_bucket(doc_id: Column, edges: list[int]) -> Column:
    """Number of ``edges`` at or below ``doc_id``, by binary search; a null id belongs to the last bucket."""
    steps = [1 << i for i in reversed(range(len(edges).bit_length()))]
    if not steps:
        return F.lit(0)
    cuts = F.lit(edges)
    found = F.aggregate(F.lit(steps), F.lit(0), lambda pos, step: F.when(
        F.get(cuts, pos + step - 1) <= doc_id, pos + step).otherwise(pos))
    return F.when(doc_id.isNull(), F.lit(len(edges))).otherwise(found)
