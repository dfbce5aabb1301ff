"""Level dictionaries: the sorted levels of text columns with their codes, as a table (inventory 57, 58).

Distinct levels are a grouped aggregate (so a hot level is combined before the shuffle); they are range-sorted by column and
level, written once, and numbered by a rank inside each range plus the prefix sum of the ranges before it. No
level reaches the driver, and no window spans a column. Rows meet the dictionary in an equi-join, which is a broadcast
join only where the dictionary has been counted to be small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checked_broadcast, cut_lineage

#: Levels of a dictionary that may be broadcast.
SMALL = 100_000


def level_dictionary(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, level, code, n)``: codes count from 0 in ascending order of the level (of its UTF-8 bytes), ``n`` its rows.

    A NULL is not a level. Values that are not text are taken by their string form.
    """
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in cols]))
    counted = df.select(cells).where("level is not null").groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(counted.repartitionByRange("column", "level").withColumn("range", F.spark_partition_id()))
    within = F.row_number().over(Window.partitionBy("range", "column").orderBy("level"))
    # one row for each column and range
    sizes = ranged.groupBy("column", "range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    return (ranged.withColumn("within", within).join(checked_broadcast(sizes), ["column", "range"])
            .select("column", "level", (F.col("before") + F.col("within") - 1).alias("code"), "n"))


def level_counts(dictionary: DataFrame, cols: list[str]) -> dict[str, int]:
    """Number of levels of each column (one row per column)."""
    found = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in cols}


def with_codes(df: DataFrame, dictionary: DataFrame, codes: dict[str, str]) -> DataFrame:
    """``df`` with a code column for each ``{column: new name}``; NULL for a NULL or an unknown level."""
    out = df
    for c, name in codes.items():
        part = dictionary.where(F.col("column") == c).select(F.col("level").alias("_level"), F.col("code").alias(name))
        if name in out.columns:
            out = out.drop(name)
        out = out.join(checked_broadcast(part, SMALL), F.col(f"`{c}`").cast("string") == F.col("_level"), "left").drop("_level")
    return out


def with_levels(df: DataFrame, dictionary: DataFrame, levels: dict[tuple[str, str], str]) -> DataFrame:
    """``df`` with the level for each ``{(dictionary column, code column): new name}``; NULL for an unknown code."""
    out = df
    for (c, code), name in levels.items():
        part = dictionary.where(F.col("column") == c).select(F.col("code").alias("_code"), F.col("level").alias(name))
        if name in out.columns:
            out = out.drop(name)
        out = out.join(checked_broadcast(part, SMALL), F.col(f"`{code}`").cast("long") == F.col("_code"), "left").drop("_code")
    return out


def unit_vector(place: Column, size: int) -> Column:
    """A sparse vector of ``size`` places with a 1 at ``place``; all zeros where that is NULL."""
    def build(at: pa.Array) -> pa.Array:
        at = at.to_numpy(zero_copy_only=False).astype(np.int32)
        ends = pa.array(np.concatenate(([0], np.cumsum(at >= 0))).astype(np.int32))
        places = pa.ListArray.from_arrays(ends, pa.array(at[at >= 0]))
        ones = pa.ListArray.from_arrays(ends, pa.array(np.ones(int((at >= 0).sum()))))
        return pa.StructArray.from_arrays([pa.array(np.zeros(len(at), np.int8)), pa.array(np.full(len(at), size, np.int32)), places, ones],
                                          ["type", "size", "indices", "values"])

    return F.arrow_udf(build, VectorUDT())(F.coalesce(place.cast("int"), F.lit(-1)))
