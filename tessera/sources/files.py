"""Sources and sinks (inventory 1-9): CSV ingest, parquet layers, exports, configs.

Paths may be any Hadoop filesystem URI; file listings go through the
Hadoop FileSystem API of the session, never the local disk.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.names import standardize_names

ENCODINGS = ("utf-8", "latin-1", "iso-8859-1", "cp1252")
# names the CSV reader accepts for the encodings above
SPARK_CHARSET = {"utf-8": "utf-8", "utf8": "utf-8", "latin-1": "iso-8859-1", "latin1": "iso-8859-1",
                 "iso-8859-1": "iso-8859-1"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def file_encodings(spark: SparkSession, path, encodings=ENCODINGS, header: bool = True) -> DataFrame:
    """``(file, encoding, lines, bad_lines, header)`` of every file with lines: the first encoding in order that decodes it.

    UTF-8 validity is checked on every line in parallel (``is_valid_utf8`` on the raw text source) and counted
    by file; Latin-1 decodes any byte, so it ends the chain. Without an encoding that fits, it is NULL. ``header`` is a
    file's first line as the text source shows it (NULL if files have none).
    """
    fits = F.lit(None).cast("string")
    for enc in reversed(encodings):
        e = enc.lower().replace("_", "-")
        if e in ("utf-8", "utf8"):
            fits = F.when(F.col("bad_lines") == 0, F.lit(enc)).otherwise(fits)
        elif e in ("latin-1", "iso-8859-1", "latin1"):
            fits = F.lit(enc)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"),
        # lines of one block are read in order
        F.when(F.col("_metadata.file_block_start") == 0, F.struct(F.monotonically_increasing_id().alias("i"), "value")).alias("line"))
    per = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("ok")).alias("bad_lines"),
                                    F.min_by("line.value", "line.i").alias("header"))
    return per.select("file", fits.alias("encoding"), "lines", "bad_lines", "header" if header else F.lit(None).cast("string").alias("header"))


def detect_encoding(spark: SparkSession, path: str, encodings=ENCODINGS) -> str:
    """First encoding in order that decodes all the file(s)."""
    bad = file_encodings(spark, path, encodings).agg(F.sum("bad_lines")).first()[0]
    for enc in encodings:
        e = enc.lower().replace("_", "-")
        if e in ("latin-1", "iso-8859-1", "latin1") or (e in ("utf-8", "utf8") and not bad):
            return enc
    raise ValueError(f"could not decode {path} with any of {encodings}")


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the inferred types ``a`` and ``b``."""
    if a == b:
        return a
    numbers = [T.IntegerType(), T.LongType(), T.DoubleType()]
    if a in numbers and b in numbers:
        return numbers[max(numbers.index(a), numbers.index(b))]
    return T.StringType()


def read_csv_multi_encoding(spark: SparkSession, path, encodings=ENCODINGS, header: bool = True,
                            infer_schema: bool = True, schema=None, standardize: bool = True,
                            multi_line: bool = False, quarantine: str | None = None) -> DataFrame:
    """Read CSV, every file with the first encoding that decodes it; standardise names; NaN -> NULL.

    Files are read in one group per encoding and header, and the groups are put together by column name (a column that a
    group lacks is NULL there; types that differ are widened). ``schema`` gives the types by name, or by position without a
    header. ``quarantine`` names a column for the text of malformed records (a field too few or too
    many, or a value that its type does not hold); it is NULL for good ones, so that row counts add up.

    Quotes inside a quoted field are doubled. ``multi_line`` allows line breaks inside quoted
    fields; such a file cannot be split, so it is read by one task. File names reach the driver, as in any read of files.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = file_encodings(spark, path, encodings, header).select("file", "encoding", "header").collect()
    unknown = [r["file"] for r in found if r["encoding"] is None]
    if unknown:
        raise ValueError(f"could not decode {unknown[0]} ({len(unknown)} files) with any of {encodings}")
    uri = spark.sparkContext._jvm.java.net.URI
    groups: dict = {}
    for r in sorted(found, key=lambda r: r["file"]):
        file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri(r["file"])).toString()
        groups.setdefault((r["encoding"], r["header"]), []).append(file)
    if not groups:
        return spark.createDataFrame([], given or T.StructType())

    def reader(encoding: str):
        return (spark.read.option("header", header).option("encoding", SPARK_CHARSET.get(encoding.lower(), encoding))
                .option("quote", '"').option("escape", '"').option("multiLine", multi_line))

    def final(names: list[str]) -> list[str]:
        return standardize_names(names) if standardize else names

    fields: dict = {}  # group -> its fields in order, under their final names
    types: dict = {}
    for g, group_files in groups.items():
        inferred = reader(g[0]).option("inferSchema", infer_schema and given is None).csv(group_files).schema
        if given is not None and not header:
            inferred = given
        fields[g] = final(inferred.fieldNames())
        wanted = dict(zip(final(given.fieldNames()), given)) if given is not None else {}
        for name, f in zip(fields[g], inferred):
            t = wanted[name].dataType if name in wanted else f.dataType
            types[name] = t if name in wanted else _wider(types.get(name, t), t)
    out = None
    for g, group_files in groups.items():
        full = T.StructType([T.StructField(n, types[n]) for n in fields[g]])
        r = reader(g[0])
        if quarantine:
            full = full.add(quarantine, T.StringType())
            r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", quarantine)
        part = r.schema(full).csv(group_files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return nan_to_null(out)


def pick_csv_in_folder(spark: SparkSession, folder: str) -> str | None:
    """Full path of the first ``.csv`` in ``folder`` (sorted by name), or None."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return None
    names = sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(".csv"))
    return names[0] if names else None


def standardize_columns(df: DataFrame) -> DataFrame:
    """strip / lower / space->_ / drop [^a-z0-9_]; colliding names get a numeric suffix."""
    return df.toDF(*standardize_names(df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select([F.when(F.isnan(F.col(f"`{f.name}`")), None).otherwise(F.col(f"`{f.name}`")).alias(f.name)
                      if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                      for f in df.schema.fields])


def latest_layer(spark: SparkSession, base: str, name: str) -> str | None:
    fs, p = _fs(spark, f"{base.rstrip('/')}/{name}")
    if not fs.exists(p):
        return None
    vs = sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(p)
                if s.getPath().getName().startswith("v=") and fs.exists(
                    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    return f"{base.rstrip('/')}/{name}/v={vs[-1]}" if vs else None


def write_layer(df: DataFrame, base: str, name: str, partition_by=None) -> str:
    """Write a new version ``<base>/<name>/v=<n>`` (never overwrites the path being read)."""
    spark = df.sparkSession
    cur = latest_layer(spark, base, name)
    n = int(cur.rsplit("v=", 1)[1]) + 1 if cur else 1
    path = f"{base.rstrip('/')}/{name}/v={n}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_layer(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = latest_layer(spark, base, name)
    if path is None:
        raise FileNotFoundError(f"layer {name} not found under {base}")
    return spark.read.parquet(path)


def layer_exists(spark: SparkSession, base: str, name: str, min_rows: int = 1) -> bool:
    """The layer has a committed version with at least ``min_rows`` rows (bounded check)."""
    path = latest_layer(spark, base, name)
    if path is None:
        return False
    return spark.read.parquet(path).limit(min_rows).count() >= min_rows


def export_filtered_csv(df: DataFrame, path: str) -> str:
    """Write the (filtered) rows as CSV with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_config(spark: SparkSession, obj, path: str) -> None:
    """Small JSON configuration (target, strategy, hypotheses) as a one-row text table."""
    spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_config(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path).first()["value"])


#: Records of the configuration files.
TARGET_RECORD = "target_col string, problem_type string, insights array<string>"
STRATEGY_RECORD = ("standard array<string>, custom array<struct<name: string, expression: string>>, selected array<string>, "
                   "dropped array<struct<name: string, reason: string>>")
HYPOTHESIS_RECORD = ("id string, statement string, columns array<string>, test string, direction string, verdict string, "
                     "p_value double, groups array<struct<grp: string, mean: double, count: bigint>>")


def write_records(df: DataFrame, schema: str, path: str) -> None:
    """``df`` as nested JSON records of the declared ``schema``, one a line; a field of the schema that is missing is NULL.

    Other columns are an error, as they would be lost when the records are read."""
    wanted = T.StructType.fromDDL(schema)
    extra = [c for c in df.columns if c not in wanted.fieldNames()]
    if extra:
        raise ValueError(f"the records have no field for {extra}")
    out = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
    df.select(*out).write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def read_records(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Nested JSON records (one a line, or one document a file with ``multi_line``) as a table of the declared schema.

    A record that is no JSON, or does not fit the schema, is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)


def stats_report_table(df: DataFrame, keys: list[str], digits: int = 4) -> DataFrame:
    """A profile or metrics table as report rows ``(*keys, metric, value, text)``, all of them.

    Every other column becomes one row per input row: numbers in ``value`` (rounded), anything else in ``text``.
    """
    numeric = (T.NumericType,)
    recs = []
    for f in df.schema.fields:
        if f.name in keys:
            continue
        c = F.col(f"`{f.name}`")
        is_num = isinstance(f.dataType, numeric)
        recs.append(F.struct(F.lit(f.name).alias("metric"),
                             (F.round(c.cast("double"), digits) if is_num else F.lit(None).cast("double")).alias("value"),
                             (F.lit(None).cast("string") if is_num else c.cast("string")).alias("text")))
    return df.select(*[F.col(f"`{k}`") for k in keys], F.inline(F.array(*recs)))


def markdown(df: DataFrame, digits: int = 4) -> str:
    """A small result (the caller has bounded it) as a markdown table, every row."""
    cols = df.columns

    def fmt(v):
        if isinstance(v, float):
            return f"{v:.{digits}f}"
        return "" if v is None else str(v)
    lines = ["| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
    lines += ["| " + " | ".join(fmt(r[c]) for c in cols) + " |" for r in df.collect()]
    return "\n".join(lines) + "\n"
