"""Reproducible splits and folds (inventory 62, 63, 82).

Each row gets ``h = md5('<seed>|<key>')`` (same value in Spark and DuckDB).
Rows are ranked by (h, key) inside their class; the test share and the fold
number follow from that rank, so class proportions are exact.

The rank is computed without a window over a whole class: rows are spread
over 16**5 (about a million) buckets by the first five hex digits of ``h``
(uniform, so a huge class splits evenly: 10^12 rows give about 10^6 rows per
sorted task), bucket sizes give offsets, and only the window inside one
(class, bucket) is sorted. The bucket-size table joins back on the same
(class, bucket) partitioning the window needs, so the rows shuffle once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.quantile import quantile_row

HASH_BUCKETS_HEX = 5  # 16**5 buckets
#: Cuts that are collected and broadcast at most: one row per class and wanted rank.
CUT_ROWS = 100_000


def _hashed(df: DataFrame, key: str, seed: int, by: str | None) -> DataFrame:
    """``df`` with its hash, bucket and class; a NULL class is a class of its own (``_gn`` true)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(f"`{key}`").cast("string")))
    g = F.col(f"`{by}`").cast("string") if by else F.lit("")
    return (df.withColumn("_h", h).withColumn("_gn", g.isNull()).withColumn("_g", F.coalesce(g, F.lit("")))
              .withColumn("_b", F.substring("_h", 1, HASH_BUCKETS_HEX)))


def _bucket_sizes(hashed: DataFrame) -> DataFrame:
    sizes = hashed.groupBy("_gn", "_g", "_b").agg(F.count(F.lit(1)).alias("_bn"))
    wb = Window.partitionBy("_gn", "_g").orderBy("_b")  # <= 16**5 rows per group
    return (sizes.withColumn("_off", F.sum("_bn").over(wb.rowsBetween(Window.unboundedPreceding, -1)))
                 .withColumn("_group_n", F.sum("_bn").over(Window.partitionBy("_gn", "_g")))
                 .withColumn("_off", F.coalesce("_off", F.lit(0))))


def hash_rank(df: DataFrame, key: str, seed: int = 42, by: str | None = None) -> DataFrame:
    """Adds ``_h`` and ``_rank`` (1-based rank of (h, key) within ``by``) and ``_group_n``."""
    d = _hashed(df, key, seed, by)
    sizes = _bucket_sizes(d).drop("_bn")
    w = Window.partitionBy("_gn", "_g", "_b").orderBy("_h", key)
    ranked = d.withColumn("_r", F.row_number().over(w))
    # sizes: at most groups x 16**5 rows; the planner (AQE) decides whether to broadcast it
    out = ranked.join(sizes, ["_gn", "_g", "_b"]).withColumn("_rank", F.col("_off") + F.col("_r"))
    return out.drop("_gn", "_g", "_b", "_r", "_off")


def _cuts(df: DataFrame, key: str, seed: int, by: str | None, wanted: list):
    """A table ``(_gn, _g, _i, _cut_h, _cut_k)``: the (hash, key) of the rank ``wanted[_i]`` of each class, and the hint for joining it.

    ``wanted`` are expressions of the class size ``_group_n``. Only keys and classes are read, and only the one bucket that
    holds a wanted rank is ranked. The cuts are calculated once: a bounded number of them is collected (one row per
    class and rank) and given back as a small table; more classes than that leave them to a join.
    """
    spark = df.sparkSession
    narrow = (_hashed(df.select(*{f"`{c}`": 0 for c in (key, by) if c}), key, seed, by)
              .select("_gn", "_g", "_b", "_h", F.col(f"`{key}`").alias("_k")))
    ranks = F.array(*[F.struct(F.lit(i).alias("_i"), w.cast("long").alias("_rank")) for i, w in enumerate(wanted)])
    edge = (_bucket_sizes(narrow).select("_gn", "_g", "_b", "_bn", "_off", F.inline(ranks))
            .withColumn("_want", F.col("_rank") - F.col("_off"))
            .where((F.col("_want") > 0) & (F.col("_want") <= F.col("_bn"))))
    edge = edge.groupBy("_gn", "_g", "_b").agg(F.collect_list(F.struct("_i", "_want")).alias("_wants"))
    w = Window.partitionBy("_gn", "_g", "_b").orderBy("_h", "_k")
    cuts = (narrow.join(edge, ["_gn", "_g", "_b"]).withColumn("_r", F.row_number().over(w))
            .select("_gn", "_g", F.col("_h").alias("_cut_h"), F.col("_k").alias("_cut_k"), "_r", F.inline("_wants"))
            .where(F.col("_r") == F.col("_want")).select("_gn", "_g", "_i", "_cut_h", "_cut_k"))
    rows = cuts.limit(CUT_ROWS + 1).collect()
    if len(rows) > CUT_ROWS:
        return cuts, lambda d: d
    return spark.createDataFrame(rows, cuts.schema), F.broadcast


def train_test_split(df: DataFrame, key: str, label: str | None = None, test_frac: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``split`` in {'train','test'}: per class the first round(frac * n_class) ranks are test.

    Only the last test row's (hash, key) of each class is needed, and only the one
    bucket it falls in is ranked; whole rows are compared with their class's cut
    where they are.
    """
    cuts, hint = _cuts(df, key, seed, label, [F.floor(F.col("_group_n") * F.lit(test_frac) + F.lit(0.5))])
    upto = (F.col("_h") < F.col("_cut_h")) | ((F.col("_h") == F.col("_cut_h")) & (F.col(f"`{key}`") <= F.col("_cut_k")))
    return (_hashed(df, key, seed, label).join(hint(cuts.drop("_i")), ["_gn", "_g"], "left")
            .withColumn("split", F.when(upto, "test").otherwise("train"))
            .select(*[F.col(f"`{c}`") for c in df.columns], "split"))


def kfold_ranges(df: DataFrame, key: str, k: int = 5, label: str | None = None, seed: int = 42) -> DataFrame:
    """Adds ``fold``: each class's rows in the order of their hash, cut into ``k`` ranges of equal size (to one row).

    Fold sizes and class proportions are those of :func:`kfold_assign`, but whole rows stay where they are: a row is
    compared with the k - 1 cuts of its class. A class smaller than ``k`` fills its last folds first. Rows that share
    one key share a fold. An existing ``fold`` is replaced.
    """
    df = df.drop("fold")
    cuts, hint = _cuts(df, key, seed, label, [F.floor(F.col("_group_n") * i / F.lit(k)) for i in range(1, k)])
    per = cuts.groupBy("_gn", "_g").agg(F.collect_list(F.struct(F.col("_cut_h").alias("h"), F.col("_cut_k").alias("k"))).alias("_cuts"),
                                        F.count(F.lit(1)).alias("_n"))
    # a cut of rank 0 has no row: all rows of the class are above it
    above = F.size(F.filter("_cuts", lambda c: (F.col("_h") > c["h"]) | ((F.col("_h") == c["h"]) & (F.col(f"`{key}`") > c["k"]))))
    fold = F.lit(k - 1) - F.coalesce(F.col("_n"), F.lit(0)) + F.coalesce(above, F.lit(0))
    return (_hashed(df, key, seed, label).join(hint(per), ["_gn", "_g"], "left")
            .select(*[F.col(f"`{c}`") for c in df.columns], fold.cast("int").alias("fold")))


def kfold_assign(df: DataFrame, key: str, k: int = 5, label: str | None = None, seed: int = 42) -> DataFrame:
    """Adds ``fold`` = (rank - 1) mod k, stratified by ``label`` when given."""
    r = hash_rank(df, key, seed, label)
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank", "_group_n")


def temporal_holdout(df: DataFrame, ts: str, test_frac: float = 0.2) -> tuple[DataFrame, float]:
    """Split by time: rows after the exact (1 - frac) quantile of the timestamp are test; without one, NULL."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        # wall-clock timestamps: microseconds since the epoch without any session time zone
        us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(ts))
    else:
        us = F.unix_micros(F.col(ts).cast("timestamp"))
    secs = us.cast("double") / 1e6
    cut = quantile_row(df.select(secs.alias("_t")), ["_t"], [1 - test_frac]).get(("_t", 1 - test_frac))
    return df.withColumn("split", F.when(secs > F.lit(cut), "test").when(secs.isNotNull(), "train")), cut
