"""Mixing sources to target weights by capped water-filling.

Weights are shares of the mix. A source whose share would take it beyond
``max_epochs`` passes over its words is clamped there and its excess goes to the
others by weight, round after round, until none is above. A source's target of
``e`` epochs is then met by ``floor(e)`` whole repetitions of every document and
one more of a seeded part: documents in the order of a seeded hash, up to the
words still wanted. That part is found through hash buckets, then buckets inside the one in which it ends,
so only the last one's documents are ranked. Sources are numbered by range, in as many tasks as there are ranges.

Edge cases: a null text has size 0; a null source is a source of its own, last;
sources without words get target 0 and are not taken. Rows with equal ids are
taken alike. Other columns pass through (``size``, ``source_size``, ``target``
and ``reps`` are replaced). An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, documents, small_broadcast, stored
from tessera.operators.levels import level_dictionary

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2, "mix-1"
#: Leading hex digits of a hash that name its bucket, level by level: 4,096 buckets inside one of the level before.
BUCKET_DIGITS = (3, 6)


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size`` in words and the seeded place ``_h`` in its source's order."""
    return (docs.drop("size", "source_size", "target", "reps")
            .withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
            .withColumn("_h", F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("source")))))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` of a table of ``(source, size)``: one row per source, null last."""
    grouped = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-groups")
    place = level_dictionary(grouped, ["source"]).select(F.col("level").alias("source"), "code")
    last = grouped.where("source is not null").count()
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.coalesce("code", F.lit(last)) % len(weights) + 1).cast("int"))
    src = stored(grouped.join(place, "source", "left")
                 .select("source", "source_size", pick.cast("long").alias("w"), (F.col("source_size") * max_epochs).alias("cap")), "mix-sources")
    # one small aggregate a round: the level at which the unclamped sources share what the clamped leave
    total = src.agg(F.sum("source_size")).first()[0] or 0
    budget, level, clamped = total * share, 0.0, -1
    while True:
        over = F.col("w") * F.lit(level) > F.col("cap")
        n, cap, w = src.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
                            F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0))).first()
        if n == clamped or not w:
            break
        clamped, level = n, (budget - cap) / w
    return src.select("source", "source_size",
                      F.least(F.col("w") * F.lit(level), F.col("cap").cast("double")).alias("target"))


def mix_plan(narrow: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: its target, whole repetitions, and the last hash (``cut``) of those taken once more.

    ``narrow`` holds ``(source, size, _h)``. The words of each hash bucket place the end of the seeded part in
    one bucket per source; only that bucket's documents are ranked.
    """
    src = stored(targets(narrow, weights, share, max_epochs)
                 .withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
                 .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    ends, depth = src.select("source", F.lit("").alias("bucket"), F.lit(0).cast("long").alias("before"), "rest"), 0
    for digits in BUCKET_DIGITS:
        upto = Window.partitionBy("source").orderBy("bucket")  # at most 4,096 buckets of a source
        ends = stored(_inside(narrow, ends, depth).groupBy("source", F.substring("_h", 1, digits).alias("bucket"))
                      .agg(F.sum("size").alias("words"), F.max("before").alias("start"), F.max("rest").alias("rest"))
                      .withColumn("upto", F.col("start") + F.sum("words").over(upto))
                      .withColumn("before", F.col("upto") - F.col("words"))
                      .where("before <= rest and rest < upto").select("source", "bucket", "before", "rest"), "mix-ends")
        depth = digits
    # a document belongs when at least half of it is still wanted
    run = Window.partitionBy("source").orderBy("_h")
    cut = (_inside(narrow, ends, depth)
           .withColumn("mid", F.col("before") + F.sum("size").over(run) - F.col("size") / 2)
           .groupBy("source", "bucket").agg(F.max(F.when(F.col("mid") <= F.col("rest"), F.col("_h"))).alias("cut")))
    # a bucket's bare prefix sorts before all its hashes, and "g" after every hash
    none = F.when(F.col("rest") > 0, F.lit("g")).otherwise(F.lit(""))
    return small_broadcast(stored(
        src.alias("s").join(cut.alias("c"), F.expr("s.source <=> c.source"), "left")
        .select("s.source", "source_size", "target", "whole", F.coalesce("cut", "bucket", none).alias("cut")), "mix-plan"))


def _inside(narrow: DataFrame, ends: DataFrame, depth: int) -> DataFrame:
    """The rows of ``narrow`` in the bucket (of ``depth`` digits) that ``ends`` names for their source."""
    return (narrow.alias("n").join(small_broadcast(ends).alias("e"), F.expr(f"n.source <=> e.source and substring(n._h, 1, {depth}) = e.bucket"))
            .select("n.source", "e.bucket", "_h", "size", "before", "rest"))


def _taken(docs: DataFrame, plan: DataFrame) -> DataFrame:
    return (docs.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
            .select("d.*", "p.source_size", "p.target", F.expr("p.whole + cast(d._h <= p.cut as long)").alias("reps"))
            .drop("_h"))


def _narrow(docs: DataFrame, seed: str) -> DataFrame:
    return stored(sized(docs.select("doc_id", "source", "text"), seed)
                  .select("doc_id", "source", "size", "_h"), "mix-sizes")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (its source's) and ``reps``, the times the mix takes it."""
    own = docs.drop("size", "source_size", "target", "reps")
    # all columns travel in one struct, so that no name of theirs meets a name of the join
    rows = own.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in own.columns]).alias("row"))
    out = _taken(sized(rows, seed), mix_plan(_narrow(docs, seed), weights, share, max_epochs))
    return out.select(*[F.col(f"row.`{c}`") for c in own.columns], "size", "source_size", "target", "reps")


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as many times as it is taken."""
    m = mix(docs.select("doc_id", "source", "text", F.struct("*").alias("_row")), **how)
    return m.where("reps > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("reps")))).select("_row.*")


def query(spark, sf_dir):
    narrow = _narrow(documents(spark, sf_dir), SEED)
    return (_taken(narrow, mix_plan(narrow))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken")))


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(concat_ws('|', 'mix-1', CAST(doc_id AS VARCHAR), source)) AS h
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS BIGINT) AS cap,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sizes GROUP BY source),
-- sources in the order in which they are clamped; the level when the first k are
ranked AS (
  SELECT *, CAST(sum(cap) OVER o AS BIGINT) - cap AS cap_before, CAST(sum(w) OVER () AS BIGINT) - CAST(sum(w) OVER o AS BIGINT) + w AS w_left,
         CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS budget
  FROM src WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT arg_min((budget - cap_before) / w_left, cap_before) FILTER (w * ((budget - cap_before) / w_left) <= cap) AS lv
  FROM ranked),
aims AS (
  SELECT source, source_size, least(w * coalesce(lv, 1e300::DOUBLE), CAST(cap AS DOUBLE)) AS target FROM src, level),
parts AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, s.h,
         CASE WHEN a.source_size = 0 THEN 0 ELSE floor(a.target / a.source_size) END AS whole,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY h) AS DOUBLE) - size / 2 AS mid
  FROM sizes s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN mid <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM parts
"""
