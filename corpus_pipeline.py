"""From raw documents to token ids: five of the corpus operators one after another.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows its predecessor kept; its result is written
as Parquet and read back as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, mixing, simhash, toxicity
from tessera.llm.common import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; it learns from the labelled documents among ``docs``."""
    return toxicity.keep_clean(docs, toxicity.labels_of(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines it keeps; ``n_chars`` follows its text."""
    out = line_dedup.dedup_lines(docs.select("doc_id", "text", F.struct("*").alias("_row")))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[new.get(c, F.col(f"_row.`{c}`")) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as many times as it is taken."""
    return mixing.mixture(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with the checksums of both ways."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe", tokenise),
]
#: The trained chain has no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
