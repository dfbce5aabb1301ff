"""Line dedup with levelled sorted runs of line hashes (DataFrame operations only).

Lines are hashed once. Batches of documents, newest ids first, are then taken
one after another: the batch's distinct hashes are merge-joined with every run
of the index; hashes that no run holds (the anti join) become a new sorted run
whose entry names the batch's largest document as the keeper, hashes already
held only add to a tally. A level that has ``fanout`` runs is compacted into
one run of the next level. Runs are Parquet tables bucketed and sorted by hash,
so a batch meets them without shuffling or sorting them again.

Decisions: a line whose key (stripped, A-Z lower-cased) has at least
``min_chars`` code points and occurs in at least ``min_docs`` documents stays
only in the largest document holding it, with all its repeats there.

Edge cases: a null text is an empty text (one empty line). A null ``doc_id`` is
one document below all others. Rows with the same ``doc_id`` are one document
when documents are counted, and each row keeps its own lines. Other columns
pass through; an input column that has the name of an output is replaced. An
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BLANKS, ascii_lower, id_edges, scratch_path, stored

MIN_DOCS, MIN_CHARS = 3, 20
#: Batches of one run over a table, and runs of a level before it is compacted.
BATCHES, FANOUT = 4, 2
LOWEST = -(1 << 63)


class LineRuns:
    """The index: levels of bucketed, sorted runs ``(h, n, keeper)`` and the tallies of hashes met again."""

    def __init__(self, spark, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[DataFrame]] = [[]]
        self.tallies: list[DataFrame] = []
        self._names: list[str] = []

    def _run(self, df: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h")
         .option("path", scratch_path(self.spark, "line-run") + "/t").saveAsTable(name))
        self._names.append(name)
        return self.spark.table(name)

    def add(self, pairs: DataFrame) -> None:
        """Take one batch of ``(h, doc)`` pairs: anti-join the runs, add the rest as a run, compact full levels."""
        keys = (pairs.groupBy("h").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper")))
        known = F.lit(False)
        for i, run in enumerate(r for level in self.levels for r in level):
            # a broadcast would put every run, ten times its file's size, on the driver at once
            keys = keys.hint("merge").join(run.select("h", F.lit(True).alias(f"in{i}")), "h", "left")
            known = known | F.col(f"in{i}").isNotNull()
        met = self._run(keys.select("h", "n", "keeper", known.alias("known")))
        self.levels[0].append(met.where(~F.col("known")).drop("known"))
        self.tallies.append(met.where("known").select("h", "n"))
        self._compact()

    def _compact(self) -> None:
        for i in range(len(self.levels)):
            if len(self.levels[i]) >= self.fanout:
                merged = self._run(_union(self.levels[i]).repartition(self.buckets, "h"))
                self.levels[i] = []
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(merged)

    def repeated(self, min_docs: int) -> DataFrame:
        """``(h, keeper)`` of every hash met in at least ``min_docs`` documents."""
        more = _union(self.tallies).groupBy("h").agg(F.sum("n").alias("more"))
        runs = _union([r for level in self.levels for r in level])
        return (runs.join(more, "h", "left")
                .where(F.col("n") + F.coalesce("more", F.lit(0)) >= min_docs).select("h", "keeper"))

    def drop(self) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_pairs(docs: DataFrame, min_chars: int, edges: list[int]) -> DataFrame:
    """``(doc, th, pos, h, batch)``: every long enough line's place and 128-bit key hash; ``th`` tells rows of one id apart."""
    doc = F.coalesce("doc_id", F.lit(LOWEST))
    batch = sum((F.when(doc < e, 1).otherwise(0) for e in edges), F.lit(0))
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    return (docs.select(doc.alias("doc"), F.xxhash64("text").alias("th"), batch.alias("batch"),
                        F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
            .where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= min_chars)
            .select("doc", "th", "pos", F.unhex(F.md5(key)).alias("h"), "batch"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, ``n_lines`` (before) and ``n_dropped``."""
    docs = docs.drop("n_lines", "n_dropped")
    edges = id_edges(docs, batches)
    pairs = stored(line_pairs(docs, min_chars, edges), "line-pairs", ["batch"])
    index = LineRuns(docs.sparkSession, fanout)
    try:
        for b in range(len(edges) + 1):
            index.add(pairs.where(F.col("batch") == b).select("h", "doc"))
        hot = stored(index.repeated(min_docs), "line-hot")
    finally:  # a failed run leaves no table names behind either
        index.drop()
    gone = (pairs.drop("batch").join(hot, "h").where(F.col("doc") != F.col("keeper"))
            .groupBy("doc", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone")))
    lines, gone_at = F.col("lines"), F.col("gone")
    # the lines between one dropped place and the next, put together in order
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(gone_at)),
        lambda i: F.slice(lines, F.coalesce(F.get(gone_at, i - 1), F.lit(-1)) + 2,
                          F.coalesce(F.get(gone_at, i), F.size(lines)) - F.coalesce(F.get(gone_at, i - 1), F.lit(-1)) - 1)))
    # the other columns travel in one struct, so that no name of theirs meets a name of the join
    others = [c for c in docs.columns if c != "text"]
    out = (docs.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"), F.xxhash64("text").alias("th"), F.col("text").alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"))
           .join(gone, ["doc", "th"], "left").withColumn("lines", _lines(F.col("text"))))
    made = F.struct(
        F.when(gone_at.isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone_at), F.lit(0)).cast("long").alias("n_dropped"))
    return out.select("row", made.alias("made")).select(*[F.col(f"row.`{c}`") for c in others], "made.text", "made.n_lines", "made.n_dropped")


def query(spark, sf_dir):
    from tessera.llm.common import documents
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
hot AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
