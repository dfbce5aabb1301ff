"""Very wide tables, infinite values, mixed encodings, odd selections."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import assoc, gramian, profile, select
from tessera.plans.catalog_ml import scratch
from tessera.sources import files

INF = float("inf")


def test_correlated_pairs_equal_the_matrix(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 9))
    x[:, 3] = -x[:, 0] + 0.01 * x[:, 3]
    x[:, 5] = 7.0
    x[:, 8] = 1e6 + 1e-3 * x[:, 1]
    holes = rng.random(x.shape) < 0.2
    rows = [[None if h else float(v) for v, h in zip(r, hr)] for r, hr in zip(x, holes)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(9))).repartition(4)
    want = {(r.col_a, r.col_b): r["corr"] for r in assoc.correlation_matrix(df).collect() if r["corr"] is not None}
    for block in (2, 4, 128):
        got = {(r.col_a, r.col_b): r["corr"] for r in gramian.correlated_pairs(df, df.columns, -1.0, block).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    assert {(r.col_a, r.col_b) for r in gramian.correlated_pairs(df, df.columns, 0.95, 4).collect()} == {("c0", "c3"), ("c1", "c8")}
    assert gramian.correlated_pairs(df.limit(0), df.columns, 0.5).count() == 0
    assert [r["column"] for r in assoc.redundant_columns(df).collect()] == ["c3", "c8"]


def test_five_thousand_columns_with_nulls(spark):
    p, rng = 5_000, np.random.default_rng(1)
    cols = [f"c{i}" for i in range(p)]
    x = rng.normal(size=(240, p))
    # c4999 follows c7 and c2500 runs against c1; the rest is noise, every tenth value missing
    x[:, 4999], x[:, 2500] = 2 * x[:, 7] + 1, -x[:, 1]
    x[rng.random(x.shape) < 0.1] = np.nan
    base = scratch(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    for part in range(3):
        pq.write_table(pa.table({c: pa.array(x[part::3, i], from_pandas=True) for i, c in enumerate(cols)}), f"{local}/{part}.parquet")
    df = spark.read.parquet(base)
    got = {(r.col_a, r.col_b): round(r["corr"], 6) for r in gramian.correlated_pairs(df, cols, 0.9).collect()}
    assert got == {("c7", "c4999"): 1.0, ("c1", "c2500"): -1.0}


def test_infinite_values_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, INF), (3.0, 6.5, 1.0), (4.0, 8.0, -INF)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r["corr"] for r in assoc.correlation_matrix(df, full=True).collect()}
    assert got[("a", "b")] > 0.99 and got[("a", "a")] == 1.0
    assert got[("a", "c")] is None and got[("c", "b")] is None and got[("c", "c")] is None
    with_null = df.unionByName(spark.createDataFrame([(None, 1.0, 2.0)], df.schema))
    got = {(r.col_a, r.col_b): r["corr"] for r in assoc.correlation_matrix(with_null).collect()}
    assert got[("a", "b")] > 0.99 and got[("b", "c")] is None
    assert {r["column"]: r["corr"] for r in assoc.correlation_with_target(df, "a").collect()}["c"] is None
    assert [r["column"] for r in assoc.redundant_columns(df).collect()] == ["b"]
    assert assoc.prune_columns(df, "a")[1] == ["b"]


def test_histogram_counts_infinite_values_apart(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (INF,), (INF,), (-INF,), (None,), (float("nan"),)], "v double")
    got = {r.bin: (r.lower, r.upper, r["count"]) for r in profile.histogram(df, "v", 2).collect()}
    assert got == {0: (1.0, 1.5, 1), 1: (1.5, 2.0, 1), -1: (-INF, -INF, 1), 2: (INF, INF, 2)}
    only = profile.histogram(df.where("v = double('Infinity')"), "v", 2).collect()
    assert [(r.bin, r["count"]) for r in only] == [(2, 2)]


def test_a_text_selects_no_number(spark):
    df = spark.createDataFrame([(1, 1.5), (2, 2.0)], "i int, d double")
    assert select.filter_in(df, "i", ["x"]).count() == 0 and select.filter_in(df, "i", ["x", "2", "1.5"]).count() == 1
    assert select.filter_in(df, "d", ["y", "1.5"]).count() == 1 and select.filter_in(df, "d", [None]).count() == 0
    assert select.filter_in(df.withColumn("i", F.lit(9007199254740993)), "i", [9007199254740993]).count() == 2


def _write(folder, name, text, encoding):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(text.encode(encoding))


def test_a_folder_of_two_encodings(spark):
    base = scratch(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    _write(local, "a b.csv", "Name,N\nmüller,1\nçelik,2\n", "utf-8")
    _write(local, "b.csv", "Name,N\nmüller,3\n", "latin-1")
    _write(local, "c.csv", "N,Name,Extra\n4.5,ärger,x\n", "latin-1")
    _write(local, "empty.csv", "", "utf-8")
    found = {os.path.basename(r.file): (r.encoding, r.lines, r.bad_lines) for r in files.file_encodings(spark, base).collect()}
    assert found == {"a%20b.csv": ("utf-8", 3, 0), "b.csv": ("latin-1", 2, 1), "c.csv": ("latin-1", 2, 1)}
    df = files.read_csv_multi_encoding(spark, base)
    assert df.columns == ["name", "n", "extra"] and dict(df.dtypes)["n"] == "double"
    assert sorted(map(tuple, df.collect()), key=str) == [("müller", 1.0, None), ("müller", 3.0, None), ("ärger", 4.5, "x"), ("çelik", 2.0, None)]
    with pytest.raises(ValueError, match="could not decode"):
        files.read_csv_multi_encoding(spark, base, encodings=("utf-8",))


def test_malformed_records_are_kept(spark):
    base = scratch(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    _write(local, "a.csv", "name,n\nok,1\ntoo,2,many\nfew\nbad,x\n", "utf-8")
    df = files.read_csv_multi_encoding(spark, base, schema="n int, name string", quarantine="raw")
    assert df.columns == ["name", "n", "raw"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [("ok", 1, None), ("too", 2, "too,2,many"), ("few", None, "few"), ("bad", None, "bad,x")], key=str)
