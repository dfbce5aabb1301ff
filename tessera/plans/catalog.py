"""The registered queries: each operator run over whole driver tables.

Every query reads the given parquet tables (or frames Spark derives from
them) so its work grows with the data. Money sums are exact (whole cents),
so row-level values are bit-identical across engines and compared unrounded;
aggregates whose last bits depend on the summation order are rounded (6
digits, 4 for large magnitudes) in both the query and its oracle, which is
DuckDB SQL built in ``sqlgen``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.safe import sql_std_name
from tessera.operators import assoc, features, groups, impute, metrics, profile, select, split
from tessera.operators import hypothesis as hyp
from tessera.operators.levels import level_dictionary
from tessera.plans import sqlgen as S
from tessera.plans.facts import (ORDER_NUMERIC, event_frame, line_facts, line_late, load_table, order_frame,
                                 scored_frame, with_nulls)
from tessera.plans.registry import query, round_doubles

LL, LF, OF, SC = S.LINE_LATE, S.LINE_FACTS, S.ORDER_FRAME, S.SCORED


# -- 2.3 grouped aggregates ---------------------------------------------------

@query("group_mean_count", f"""
SELECT o_orderpriority, round(avg(late), 6) AS mean, count(late) AS "count" FROM {LL} t GROUP BY o_orderpriority""")
def q_group_mean_count(spark, sf):
    return round_doubles(groups.group_mean_count(line_late(spark, sf), "o_orderpriority", "late"))


@query("group_mean", f"""
SELECT l_linenumber, round(avg(late), 6) AS mean FROM {LL} t
GROUP BY l_linenumber ORDER BY avg(late) DESC, l_linenumber LIMIT 10""")
def q_group_mean(spark, sf):
    return round_doubles(groups.group_mean(line_late(spark, sf), "l_linenumber", "late", top=10))


DELAY_YEARS = "CAST(floor(delay_days / 365) AS BIGINT)"


@query("group_mean_derived", f"""
SELECT delay_years, round(mean, 6) AS mean FROM (
  SELECT {DELAY_YEARS} AS delay_years, avg(late) AS mean FROM {LL} t GROUP BY 1) g
ORDER BY mean DESC, delay_years LIMIT 10""")
def q_group_mean_derived(spark, sf):
    return round_doubles(groups.group_mean_derived(line_late(spark, sf), "delay_years", DELAY_YEARS, "late", top=10))


QLABELS = ["lowest", "lower", "upper", "highest"]


@query("quantile_buckets", f"""
WITH t AS {LL}, e AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM t)
SELECT CASE WHEN l_extendedprice <= q[1] THEN 'lowest' WHEN l_extendedprice <= q[2] THEN 'lower'
            WHEN l_extendedprice <= q[3] THEN 'upper' ELSE 'highest' END AS bucket,
       round(avg(late), 6) AS mean, count(late) AS "count"
FROM t, e WHERE l_extendedprice IS NOT NULL GROUP BY 1""")
def q_quantile_buckets(spark, sf):
    return round_doubles(groups.quantile_buckets(line_late(spark, sf), "l_extendedprice", "late", 4, QLABELS))


@query("group_multi_agg", f"""
SELECT c_mktsegment, round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_std,
  min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, round(avg(l_extendedprice), 4) AS l_extendedprice_mean,
  max(l_extendedprice) AS l_extendedprice_max, round(avg(l_discount), 6) AS l_discount_mean, count(late) AS late_count,
  round(avg(late), 6) AS late_mean
FROM {LF} t GROUP BY c_mktsegment""")
def q_group_multi_agg(spark, sf):
    out = groups.group_multi_agg(line_facts(spark, sf), "c_mktsegment",
                                 {"l_quantity": ["mean", "std", "min", "max"], "l_extendedprice": ["mean", "max"],
                                  "l_discount": ["mean"], "late": ["count", "mean"]})
    out = out.withColumn("l_extendedprice_mean", F.round("l_extendedprice_mean", 4))
    return round_doubles(out)


@query("prediction_kpis", f"""
WITH s AS {SC}, per AS (SELECT prediction AS cls, count(*) AS n FROM s GROUP BY 1)
SELECT (SELECT count(*) FROM s) AS "rows",
  (SELECT cls FROM per ORDER BY n DESC, cls LIMIT 1) AS top_class,
  round((SELECT max(n) FROM per) * 100.0 / (SELECT count(*) FROM s), 6) AS top_share_pct,
  round((SELECT avg(prediction_proba) FROM s), 6) AS mean_confidence,
  round((SELECT count_if(prediction = 1.0) FROM s) * 100.0 / (SELECT count(*) FROM s), 6) AS positive_pct,
  round((SELECT avg(o_totalprice) FROM s), 4) AS mean_benefit""")
def q_prediction_kpis(spark, sf):
    k = groups.prediction_kpis(scored_frame(spark, sf), benefit="o_totalprice")
    return round_doubles(k.withColumn("mean_benefit", F.round("mean_benefit", 4)))


@query("predicted_rate_by_category", f"""
SELECT r_name, round(avg(CASE WHEN prediction = 1.0 THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS positive_pct,
  count(*) AS "rows" FROM {SC} s WHERE r_name IS NOT NULL GROUP BY r_name""")
def q_predicted_rate_by_category(spark, sf):
    return round_doubles(groups.predicted_rate_by_category(scored_frame(spark, sf), "r_name"))


@query("late_by_state_top10", f"""
SELECT n_name, count(*) AS "count" FROM {SC} s WHERE prediction = 1.0 AND n_name IS NOT NULL
GROUP BY n_name ORDER BY count(*) DESC, n_name LIMIT 10""")
def q_late_by_state_top10(spark, sf):
    return groups.late_by_state_top10(scored_frame(spark, sf), "n_name")


# -- 2.3 profiling ------------------------------------------------------------

@query("column_profile", S.column_profile(OF, S.ORDER_COLS))
def q_column_profile(spark, sf):
    return round_doubles(profile.column_profile(order_frame(spark, sf)), 4)


@query("describe_all", S.describe(OF, S.ORDER_COLS))
def q_describe_all(spark, sf):
    return round_doubles(profile.describe_all(order_frame(spark, sf)), 4)


LI_NUM = [(c, t) for c, t in S.LINEITEM_COLS if t in S.NUMERIC_TYPES]


@query("describe_numeric_transposed", S.describe("lineitem", LI_NUM, d=3, only_numeric=True))
def q_describe_numeric_transposed(spark, sf):
    return profile.describe_numeric_transposed(load_table(spark, sf, "lineitem"), digits=3)


@query("table_inventory", "\nUNION ALL\n".join(
    f"SELECT (SELECT count(*) FROM lineitem) AS \"rows\", {len(S.LINEITEM_COLS)} AS \"columns\", {i} AS position, "
    f"{S.lit(c)} AS \"column\", {S.lit(t)} AS dtype" for i, (c, t) in enumerate(S.LINEITEM_COLS)))
def q_table_inventory(spark, sf):
    return profile.table_inventory(load_table(spark, sf, "lineitem"))


def _nulled_orders(spark, sf):
    f = order_frame(spark, sf)
    f = with_nulls(f, "_src_idx", ["o_totalprice", "c_mktsegment"], 10)
    f = with_nulls(f, "_src_idx", ["sum_qty", "r_name"], 7)
    return with_nulls(f, "_src_idx", ["avg_tax"], 13)


NULLED_OF = f"""(SELECT _src_idx,
  CASE WHEN _src_idx % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, n_lines,
  CASE WHEN _src_idx % 7 = 0 THEN NULL ELSE sum_qty END AS sum_qty, sum_price, avg_discount,
  CASE WHEN _src_idx % 13 = 0 THEN NULL ELSE avg_tax END AS avg_tax, c_acctbal, o_orderpriority, o_orderstatus,
  CASE WHEN _src_idx % 10 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN _src_idx % 7 = 0 THEN NULL ELSE r_name END AS r_name, n_name, late FROM {OF} x)"""


@query("null_report", "\nUNION ALL\n".join(
    f"SELECT {S.lit(c)} AS \"column\", count(*) FILTER (WHERE {S.q(c)} IS NULL) AS nulls FROM {NULLED_OF} t "
    f"HAVING count_if({S.q(c)} IS NULL) > 0" for c, _ in S.ORDER_COLS))
def q_null_report(spark, sf):
    return profile.null_report(_nulled_orders(spark, sf))


def _iqr_sql(src, cols, d=6):
    parts = []
    for c in cols:
        x = f"CAST({S.q(c)} AS DOUBLE)"
        parts.append(f"""SELECT {S.lit(c)} AS "column", count(*) FILTER (WHERE {x} < lo OR {x} > hi) AS outliers, round(q1, {d}) AS q1,
  round(q3, {d}) AS q3, round(lo, {d}) AS lower, round(hi, {d}) AS upper FROM {src} s,
  (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
    (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {src} s2) a) b
  GROUP BY q1, q3, lo, hi HAVING count_if({x} < lo OR {x} > hi) > 0""")
    return "\nUNION ALL\n".join(parts)


@query("iqr_outliers", _iqr_sql(OF, ORDER_NUMERIC))
def q_iqr_outliers(spark, sf):
    return round_doubles(profile.iqr_outliers(order_frame(spark, sf), ORDER_NUMERIC))


@query("value_counts", """
SELECT p_brand, count(*) AS "count" FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
ORDER BY count(*) DESC, p_brand LIMIT 15""")
def q_value_counts(spark, sf):
    return profile.value_counts(load_table(spark, sf, "part"), "p_brand", 15)


@query("value_shares", """
SELECT event_type, count(*) AS "count", round(count(*) * 1.0 / (SELECT count(event_type) FROM events), 6) AS share
FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def q_value_shares(spark, sf):
    return round_doubles(profile.value_shares(load_table(spark, sf, "events"), "event_type"))


@query("mode_of", """
SELECT l_returnflag AS "mode", count(*) AS freq, round(count(*) * 1.0 / (SELECT count(*) FROM lineitem), 6) AS share
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag ORDER BY count(*) DESC, l_returnflag LIMIT 1""")
def q_mode_of(spark, sf):
    return round_doubles(profile.mode_of(load_table(spark, sf, "lineitem"), "l_returnflag"))


def _hist_sql(src, x, bins=40, d=6):
    return f"""WITH mm AS (SELECT min({x}) AS mn, max({x}) AS mx FROM {src} s0),
b AS (SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor(({x} - mn) / ((mx - mn) / {float(bins)})), {bins - 1}) END AS INTEGER)
  AS bin FROM {src} s1, mm WHERE {x} IS NOT NULL AND NOT isnan({x})),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(g.bin AS INTEGER) AS bin, round(mn + g.bin * ((mx - mn) / {float(bins)}), {d}) AS lower,
  round(mn + (g.bin + 1) * ((mx - mn) / {float(bins)}), {d}) AS upper, coalesce(c.n, 0) AS "count"
FROM range({bins}) g(bin) CROSS JOIN mm LEFT JOIN c ON c.bin = g.bin WHERE mn IS NOT NULL"""


@query("histogram", _hist_sql("events", "value"))
def q_histogram(spark, sf):
    return round_doubles(profile.histogram(load_table(spark, sf, "events"), "value", 40))


LI_BOX = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _box_sql(src, cols, d=6):
    parts = []
    for c in cols:
        x = f"CAST({S.q(c)} AS DOUBLE)"
        parts.append(f"""SELECT {S.lit(c)} AS "column", round(q1, {d}) AS q1, round(q2, {d}) AS median, round(q3, {d}) AS q3,
  round(q3 - q1, {d}) AS iqr, round(min(CASE WHEN {x} >= lo AND {x} <= hi THEN {x} END), {d}) AS whisker_low,
  round(max(CASE WHEN {x} >= lo AND {x} <= hi THEN {x} END), {d}) AS whisker_high,
  count(*) FILTER (WHERE {x} IS NOT NULL AND NOT ({x} >= lo AND {x} <= hi)) AS fliers
FROM {src} s, (SELECT q1, q2, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS q2, quantile_cont({x}, 0.75) AS q3
   FROM {src} s2) a) b GROUP BY q1, q2, q3, lo, hi""")
    return "\nUNION ALL\n".join(parts)


@query("boxplot_stats", _box_sql("lineitem", LI_BOX))
def q_boxplot_stats(spark, sf):
    return round_doubles(profile.boxplot_stats(load_table(spark, sf, "lineitem"), LI_BOX))


# -- 2.2 projections and filters ----------------------------------------------

@query("select_by_type", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                         "l_discount, l_tax FROM lineitem")
def q_select_by_type(spark, sf):
    return select.select_by_type(load_table(spark, sf, "lineitem"), "numeric")


@query("low_cardinality_columns", f"""
SELECT "column", nunique, position FROM (
  SELECT 'o_orderpriority' AS "column", count(DISTINCT o_orderpriority) AS nunique, 8 AS position FROM {OF} a
  UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), 9 FROM {OF} b
  UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), 10 FROM {OF} c
  UNION ALL SELECT 'r_name', count(DISTINCT r_name), 11 FROM {OF} d
  UNION ALL SELECT 'n_name', count(DISTINCT n_name), 12 FROM {OF} e) t
WHERE nunique <= 20 ORDER BY position LIMIT 4""")
def q_low_cardinality_columns(spark, sf):
    return select.low_cardinality_columns(order_frame(spark, sf), 20, 4, exclude=("late",))


@query("filter_in", f"""
SELECT * FROM {OF} t WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND n_lines IN (3, 4)""")
def q_filter_in(spark, sf):
    f = order_frame(spark, sf)
    f = select.filter_in(f, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return select.filter_in(f, "n_lines", ["3", "4"])


@query("filter_range", """
WITH b AS (SELECT min(l_quantity) = max(l_quantity) AS q, min(l_discount) = max(l_discount) AS d, min(l_tax) = max(l_tax) AS t
  FROM lineitem)
SELECT lineitem.* FROM lineitem, b WHERE (q OR l_quantity BETWEEN 10 AND 20) AND (d OR l_discount BETWEEN 0.02 AND 0.05)
  AND (t OR l_tax BETWEEN 0.0 AND 0.0)""")
def q_filter_range(spark, sf):
    return select.filter_range(load_table(spark, sf, "lineitem"),
                               {"l_quantity": (10.0, 20.0), "l_discount": (0.02, 0.05), "l_tax": (0.0, 0.0)})


@query("filter_prediction", f"SELECT _src_idx, prediction, prediction_proba FROM {SC} s WHERE prediction = 1.0")
def q_filter_prediction(spark, sf):
    return select.filter_prediction(scored_frame(spark, sf), "late").select("_src_idx", "prediction",
                                                                           "prediction_proba")


@query("project_priority", f"""
SELECT prediction, prediction_proba, late, o_orderpriority, o_orderstatus, _src_idx, o_totalprice, n_lines, sum_qty,
  sum_price, avg_discount, avg_tax, c_acctbal, c_mktsegment, r_name, n_name FROM {SC} s""")
def q_project_priority(spark, sf):
    return select.project_priority(scored_frame(spark, sf))


@query("map_values", f"""
SELECT _src_idx, CASE WHEN prediction = 1.0 THEN 'Late' WHEN prediction = 0.0 THEN 'On time' END AS prediction_label
FROM {SC} s""")
def q_map_values(spark, sf):
    m = select.map_values(scored_frame(spark, sf), "prediction", {1.0: "Late", 0.0: "On time"}, "prediction_label")
    return m.select("_src_idx", "prediction_label")


@query("align_schema", f"""
SELECT _src_idx, o_totalprice, 0 AS feat_missing, n_lines, c_mktsegment FROM {OF} t""")
def q_align_schema(spark, sf):
    return round_doubles(select.align_schema(order_frame(spark, sf),
                                             ["o_totalprice", "feat_missing", "n_lines", "c_mktsegment"],
                                             keep=("_src_idx",)))


@query("sample_head", f"SELECT * FROM {OF} t ORDER BY _src_idx LIMIT 10")
def q_sample_head(spark, sf):
    return select.sample_head(order_frame(spark, sf), 10)


@query("column_samples", "\nUNION ALL\n".join(
    f"""SELECT * FROM (SELECT {S.lit(c)} AS "column", CAST(row_number() OVER (ORDER BY _src_idx) AS INTEGER) AS rank,
  CAST({S.q(c)} AS VARCHAR) AS value FROM {NULLED_OF} t WHERE {S.q(c)} IS NOT NULL) u WHERE rank <= 3"""
    for c in ("n_lines", "o_orderpriority", "c_mktsegment", "r_name", "late")))
def q_column_samples(spark, sf):
    f = _nulled_orders(spark, sf).select("_src_idx", "n_lines", "o_orderpriority", "c_mktsegment", "r_name", "late")
    return select.column_samples(f, 3)


@query("drop_null_rows", f"SELECT * FROM {NULLED_OF} t WHERE o_totalprice IS NOT NULL AND sum_qty IS NOT NULL "
                         f"AND avg_tax IS NOT NULL AND c_mktsegment IS NOT NULL AND r_name IS NOT NULL")
def q_drop_null_rows(spark, sf):
    return select.drop_null_rows(_nulled_orders(spark, sf))


@query("drop_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
       "l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def q_drop_columns(spark, sf):
    return select.drop_columns(load_table(spark, sf, "lineitem"), ["l_tax", "not_there"])


@query("standardize_names", r"""
SELECT p_partkey, regexp_replace(replace(lower(trim(p_type)), ' ', '_'), '[^a-z0-9_]', '', 'g') AS p_type_std FROM part""")
def q_standardize_names(spark, sf):
    p = load_table(spark, sf, "part")
    return p.select("p_partkey", sql_std_name("p_type").alias("p_type_std"))


# -- 2.4 association ----------------------------------------------------------

@query("correlation_matrix", S.corr_pairs(OF, ORDER_NUMERIC))
def q_correlation_matrix(spark, sf):
    return round_doubles(assoc.correlation_matrix(order_frame(spark, sf), ORDER_NUMERIC))


@query("correlation_matrix_nulls", S.corr_pairs(NULLED_OF, ORDER_NUMERIC))
def q_correlation_matrix_nulls(spark, sf):
    return round_doubles(assoc.correlation_matrix(_nulled_orders(spark, sf), ORDER_NUMERIC))


@query("correlation_with_target", "SELECT \"column\", position, corr, abs(corr) AS abs_corr FROM (" + "\nUNION ALL\n".join(
    f"SELECT {S.lit(c)} AS \"column\", {i} AS position, "
    f"round({S.corr(f'CAST({S.q(c)} AS DOUBLE)', 'CAST(late AS DOUBLE)')}, 6) AS corr FROM {OF} t{i}"
    for i, c in enumerate(ORDER_NUMERIC)) + ") u")
def q_correlation_with_target(spark, sf):
    out = assoc.correlation_with_target(order_frame(spark, sf), "late", ORDER_NUMERIC)
    return round_doubles(out).withColumn("abs_corr", F.abs("corr"))


STD_FEATS = ["feat_ratio", "feat_sum", "feat_product", "feat_diff", "feat_interact", "sq_o_totalprice", "sq_n_lines"]
STD_FEATS_SQL = f"""(SELECT *, CAST(o_totalprice AS DOUBLE) / (CAST(n_lines AS DOUBLE) + 1e-9) AS feat_ratio,
  o_totalprice + n_lines AS feat_sum, o_totalprice * n_lines AS feat_product, o_totalprice - n_lines AS feat_diff,
  o_totalprice * sum_qty AS feat_interact, o_totalprice * o_totalprice AS sq_o_totalprice,
  CAST(n_lines AS DOUBLE) * n_lines AS sq_n_lines FROM {OF} t0)"""


def _std_frame(spark, sf):
    f, _ = features.standard_features(order_frame(spark, sf), target="late", exclude=("_src_idx",), logs=False)
    return f


# feature arithmetic on exact inputs is the same IEEE operations in both engines: compared unrounded
@query("standard_features", f"SELECT _src_idx, {', '.join(STD_FEATS)} FROM {STD_FEATS_SQL} s")
def q_standard_features(spark, sf):
    return _std_frame(spark, sf).select("_src_idx", *STD_FEATS)


CORR_COLS = ORDER_NUMERIC + STD_FEATS


@query("redundant_columns", f"""
SELECT "column", position, max_abs_corr, partner FROM (
  SELECT col_b AS "column", pos_b AS position, abs(corr) AS max_abs_corr, col_a AS partner,
         row_number() OVER (PARTITION BY col_b ORDER BY abs(corr) DESC, pos_a) AS rn
  FROM ({S.corr_pairs(STD_FEATS_SQL, CORR_COLS)}) p WHERE abs(corr) > 0.95 AND col_b <> 'late') w WHERE rn = 1""")
def q_redundant_columns(spark, sf):
    cm = round_doubles(assoc.correlation_matrix(_std_frame(spark, sf), CORR_COLS))
    return assoc.redundant_columns(None, corr=cm, threshold=0.95, target="late")


@query("cramers_v_matrix", "\nUNION ALL\n".join(
    f"""SELECT {S.lit(a)} AS col_a, {S.lit(b)} AS col_b, n, round(chi2, 6) AS chi2,
  round(CASE WHEN least(r, c) - 1 > 0 THEN sqrt(greatest(chi2, 0.0) / (n * (least(r, c) - 1))) END, 6) AS cramers_v FROM (
  SELECT tot.n, tot.r, tot.c, sum(cells.o * cells.o * tot.n / (ra.ra * cb.cb)) - tot.n AS chi2 FROM
  (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {OF} x WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2) cells
  JOIN (SELECT {a} AS a, count(*) AS ra FROM {OF} x WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) ra ON cells.a = ra.a
  JOIN (SELECT {b} AS b, count(*) AS cb FROM {OF} x WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) cb ON cells.b = cb.b
  CROSS JOIN (SELECT count(*) AS n, count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS c FROM {OF} x
              WHERE {a} IS NOT NULL AND {b} IS NOT NULL) tot
  GROUP BY tot.n, tot.r, tot.c) z"""
    for i, a in enumerate(["o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name"])
    for b in ["o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name"][i + 1:]))
def q_cramers_v_matrix(spark, sf):
    return round_doubles(assoc.cramers_v_matrix(order_frame(spark, sf),
                                                ["o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name"]))


@query("ml_ready_prune", f"""
SELECT DISTINCT "column", reason FROM (
  SELECT col_b AS "column", 'redundant' AS reason FROM ({S.corr_pairs(STD_FEATS_SQL, CORR_COLS)}) p
  WHERE abs(corr) > 0.95 AND col_b <> 'late'
  UNION ALL SELECT '_src_idx', 'id_like') u""")
def q_ml_ready_prune(spark, sf):
    """Columns removed to form the ml_ready layer: redundant (|corr| > 0.95 with an earlier
    column) and id-like names; the pruned frame itself is ``assoc.prune_columns``."""
    f = _std_frame(spark, sf)
    cm = round_doubles(assoc.correlation_matrix(f, CORR_COLS))
    red = assoc.redundant_columns(None, corr=cm, threshold=0.95, target="late").select(
        "column", F.lit("redundant").alias("reason"))
    ids = spark.createDataFrame([(c, "id_like") for c in assoc.id_like_columns(f.columns, "late")],
                                "column string, reason string")
    return red.unionByName(ids).distinct()


# -- 2.5 imputation -----------------------------------------------------------

def _nulled_lines(spark, sf):
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    li = with_nulls(li, "l_orderkey", ["l_quantity"], 10)
    return with_nulls(li, "l_orderkey", ["l_linenumber"], 7)


NULLED_LI = """(SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_quantity END AS l_quantity, l_extendedprice FROM lineitem)"""


@query("impute_median", f"""
WITH t AS {NULLED_LI}
SELECT l_orderkey, coalesce(CAST(l_linenumber AS DOUBLE), (SELECT quantile_cont(CAST(l_linenumber AS DOUBLE), 0.5) FROM t))
  AS l_linenumber, coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM t)) AS l_quantity, l_extendedprice
FROM t""")
def q_impute_median(spark, sf):
    return round_doubles(impute.impute_median(_nulled_lines(spark, sf), ["l_linenumber", "l_quantity"]))


def _mode_sql(src, c):
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {src} m WHERE {c} IS NOT NULL GROUP BY 1) "
            f"ORDER BY n DESC, v LIMIT 1)")


@query("impute_mode", f"""
WITH t AS {NULLED_OF}
SELECT _src_idx, coalesce(c_mktsegment, {_mode_sql('t', 'c_mktsegment')}) AS c_mktsegment,
  coalesce(r_name, {_mode_sql('t', 'r_name')}) AS r_name, o_orderpriority FROM t""")
def q_impute_mode(spark, sf):
    f = _nulled_orders(spark, sf).select("_src_idx", "c_mktsegment", "r_name", "o_orderpriority")
    return impute.impute_mode(f)


@query("impute_auto", f"""
WITH t AS {NULLED_OF}
SELECT _src_idx, coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM t)) AS o_totalprice,
  coalesce(sum_qty, (SELECT quantile_cont(sum_qty, 0.5) FROM t)) AS sum_qty,
  coalesce(c_mktsegment, {_mode_sql('t', 'c_mktsegment')}) AS c_mktsegment,
  coalesce(r_name, {_mode_sql('t', 'r_name')}) AS r_name FROM t""")
def q_impute_auto(spark, sf):
    """Numbers by the named method (median), strings by mode."""
    f = _nulled_orders(spark, sf).select("_src_idx", "o_totalprice", "sum_qty", "c_mktsegment", "r_name")
    return impute.impute_auto(f, key="_src_idx", method="median")


KNN_COLS = ["o_totalprice", "n_lines", "sum_qty", "sum_price", "c_acctbal"]
KNN_HOLES = {"o_totalprice": 50, "sum_qty": 35, "c_acctbal": 70}
_KNN_SHARED = " + ".join(f"CAST(a.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INTEGER)" for c in KNN_COLS)
_KNN_SUM = " + ".join(f"CASE WHEN a.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN (a.{c} - d.{c}) * (a.{c} - d.{c}) ELSE 0.0 END" for c in KNN_COLS)
# for each column with holes: the mean over the five nearest rows that have it
_KNN_FILLS = ",\n".join(f"""f{i} AS (SELECT _src_idx, avg(v) AS v FROM (
  SELECT a._src_idx, d.{c} AS v, CAST(5 AS DOUBLE) / nullif({_KNN_SHARED}, 0) * ({_KNN_SUM}) AS dist, d._src_idx AS donor
  FROM t a JOIN t d ON a.{c} IS NULL AND d.{c} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a._src_idx ORDER BY dist, donor) <= 5) GROUP BY _src_idx)"""
                         for i, c in enumerate(KNN_HOLES))


@query("impute_knn", f"""
WITH t AS (SELECT _src_idx, {', '.join(f"CASE WHEN _src_idx % {KNN_HOLES[c]} = 0 THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}"
                                        if c in KNN_HOLES else f"CAST({c} AS DOUBLE) AS {c}" for c in KNN_COLS)} FROM {OF} x),
{_KNN_FILLS}
SELECT t._src_idx, {', '.join(f"round(coalesce(t.{c}, f{list(KNN_HOLES).index(c)}.v), 6) AS {c}" if c in KNN_HOLES
                              else f"round({c}, 6) AS {c}" for c in KNN_COLS)}
FROM t {' '.join(f'LEFT JOIN f{i} ON f{i}._src_idx = t._src_idx' for i in range(len(KNN_HOLES)))}""")
def q_impute_knn(spark, sf):
    """Holes in three order columns, each filled from the five nearest orders that have the value."""
    f = order_frame(spark, sf).select("_src_idx", *KNN_COLS)
    for c, every in KNN_HOLES.items():
        f = with_nulls(f, "_src_idx", [c], every)
    return round_doubles(impute.impute_knn(f, KNN_COLS, "_src_idx", 5).select(
        "_src_idx", *[F.col(c).cast("double").alias(c) for c in KNN_COLS]))


@query("impute_centres", f"""
SELECT _src_idx, sum_price, o_totalprice AS seen_price, sum_qty AS seen_qty, true AS whole FROM {NULLED_OF} t""")
def q_impute_centres(spark, sf):
    """Neighbour imputation by learned centres: observed values stay, nothing is missing or out of range afterwards."""
    f = _nulled_orders(spark, sf).select("_src_idx", "o_totalprice", "sum_qty", "sum_price")
    out = impute.impute_centres(f.withColumn("seen_price", F.col("o_totalprice")).withColumn("seen_qty", F.col("sum_qty")),
                                ["o_totalprice", "sum_qty", "sum_price"])
    lo, hi = f.select(F.min("o_totalprice")).scalar(), f.select(F.max("o_totalprice")).scalar()
    whole = (F.col("o_totalprice").between(lo, hi) & F.col("sum_qty").isNotNull()
             & F.coalesce(F.col("seen_price") == F.col("o_totalprice"), F.lit(True)))
    return out.select("_src_idx", "sum_price", "seen_price", "seen_qty", whole.alias("whole"))


# -- 2.6 features and encoding ------------------------------------------------

EV_NUM = ["user_id", "value"]


@query("log_candidates", "\nUNION ALL\n".join(
    f"""SELECT {S.lit(c)} AS "column", {i} AS position, round(CAST(min({c}) AS DOUBLE), 6) AS min,
  round({S.skew(f'CAST({c} AS DOUBLE)')}, 6) AS skew,
  coalesce(min({c}) > 0 AND abs({S.skew(f'CAST({c} AS DOUBLE)')}) > 1.0, false) AS chosen FROM events"""
    for i, c in enumerate(EV_NUM)))
def q_log_candidates(spark, sf):
    return round_doubles(features.log_decisions(event_frame(spark, sf), EV_NUM))


@query("log_features", "SELECT event_id AS _src_idx, round(ln(1 + value), 6) AS log_value FROM events")
def q_log_features(spark, sf):
    f, made = features.log_features(event_frame(spark, sf), EV_NUM)
    return round_doubles(f.select("_src_idx", *made))


DOMAIN = {"net_price": "l_extendedprice * (1 - l_discount)",
          "gross_price": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
          "tax_paid": "l_extendedprice * (1 - l_discount) * l_tax",
          "balance_left": "c_acctbal - l_extendedprice",
          "ship_weeks": "CAST(delay_days AS DOUBLE) / 7"}


@query("domain_features", f"""SELECT l_orderkey, l_linenumber, {', '.join(f'round({e}, 6) AS {n}' for n, e in DOMAIN.items())}
FROM {LF} t""")
def q_domain_features(spark, sf):
    f = features.domain_features(line_facts(spark, sf), DOMAIN)
    return round_doubles(f.select("l_orderkey", "l_linenumber", *DOMAIN))


OH_LEVELS = {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
             "o_orderstatus": ["F", "O", "P"],
             "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
             "r_name": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]}


@query("one_hot", "SELECT _src_idx, " + ", ".join(
    f"CAST(CASE WHEN {c} = {S.lit(v)} THEN 1 ELSE 0 END AS INTEGER) AS {S.q(f'{c}_{v}')}"
    for c, lv in OH_LEVELS.items() for v in lv[1:]) + f" FROM {OF} t")
def q_one_hot(spark, sf):
    f = order_frame(spark, sf).select("_src_idx", *OH_LEVELS)
    out, names = features.one_hot(f, list(OH_LEVELS))
    return out.select("_src_idx", *[F.col(f"`{n}`") for n in names])


@query("label_encode", f"""SELECT _src_idx, o_orderpriority,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_idx FROM {OF} t""")
def q_label_encode(spark, sf):
    out, _ = features.label_encode(order_frame(spark, sf).select("_src_idx", "o_orderpriority"), "o_orderpriority")
    return out


PT_TARGETS = [("late", "int"), ("n_lines", "bigint"), ("o_totalprice", "double"), ("o_orderpriority", "string"),
              ("c_acctbal", "double"), ("sum_qty", "double")]


@query("detect_problem_type", "\nUNION ALL\n".join(
    f"""SELECT {S.lit(c)} AS "column", {S.lit(t)} AS dtype, count(DISTINCT {c}) AS nunique, count(*) AS n,
  CASE WHEN {str(t == 'string').upper()} THEN 'classification' WHEN count(DISTINCT {c}) <= 15 THEN 'classification'
       WHEN count(DISTINCT {c}) <= 30 AND {str(t in ('int', 'bigint')).upper()} THEN 'classification'
       WHEN count(DISTINCT {c}) * 1.0 / count(*) < 0.05 THEN 'classification' ELSE 'regression' END AS problem_type
FROM {OF} t""" for c, t in PT_TARGETS))
def q_detect_problem_type(spark, sf):
    return features.detect_problem_type(order_frame(spark, sf), [c for c, _ in PT_TARGETS])


# -- 2.7 splits ---------------------------------------------------------------

RANKED_OF = f"""(SELECT _src_idx, late,
  row_number() OVER (PARTITION BY late ORDER BY md5('42|' || CAST(_src_idx AS VARCHAR)), _src_idx) AS rn,
  count(*) OVER (PARTITION BY late) AS cnt FROM {OF} t)"""
SPLIT_OF = f"""(SELECT _src_idx, late, CASE WHEN rn <= floor(cnt * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
  FROM {RANKED_OF} r)"""


@query("train_test_split_nulls", f"""
WITH t AS (SELECT _src_idx, CASE WHEN _src_idx % 10 = 0 THEN NULL ELSE late END AS late FROM {OF} t0),
r AS (SELECT *, row_number() OVER (PARTITION BY late ORDER BY md5('42|' || CAST(_src_idx AS VARCHAR)), _src_idx) AS rn,
  count(*) OVER (PARTITION BY late) AS cnt FROM t)
SELECT _src_idx, late, CASE WHEN rn <= floor(cnt * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split,
  CAST((rn - 1) % 5 AS INTEGER) AS fold FROM r""")
def q_train_test_split_nulls(spark, sf):
    """Rows without a class are a class of their own, in the split and in the folds."""
    f = with_nulls(order_frame(spark, sf).select("_src_idx", "late"), "_src_idx", ["late"], 10)
    return split.kfold_assign(split.train_test_split(f, "_src_idx", "late", 0.2, 42), "_src_idx", 5, "late", 42)


@query("train_test_split", f"SELECT * FROM {SPLIT_OF} s")
def q_train_test_split(spark, sf):
    return split.train_test_split(order_frame(spark, sf).select("_src_idx", "late"), "_src_idx", "late", 0.2, 42)


@query("kfold_assign", f"SELECT _src_idx, late, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM {RANKED_OF} r")
def q_kfold_assign(spark, sf):
    return split.kfold_assign(order_frame(spark, sf).select("_src_idx", "late"), "_src_idx", 5, "late", 42)


@query("kfold_ranges", f"""
WITH t AS (SELECT _src_idx, CASE WHEN _src_idx % 10 = 0 THEN NULL ELSE n_lines END AS n_lines FROM {OF} t0),
r AS (SELECT *, row_number() OVER (PARTITION BY n_lines ORDER BY md5('42|' || CAST(_src_idx AS VARCHAR)), _src_idx) AS rn,
  count(*) OVER (PARTITION BY n_lines) AS cnt FROM t)
SELECT _src_idx, n_lines, CAST(len(list_filter([1, 2, 3, 4], lambda i: floor(cnt * i / 5.0) < rn)) AS INTEGER) AS fold FROM r""")
def q_kfold_ranges(spark, sf):
    """Stratified folds by the hash ranges of each class; rows without a class are one, and whole rows are not shuffled."""
    f = with_nulls(order_frame(spark, sf).select("_src_idx", "n_lines"), "_src_idx", ["n_lines"], 10)
    return split.kfold_ranges(f, "_src_idx", 5, "n_lines", 42)


@query("temporal_holdout", """
SELECT event_id AS _src_idx, CASE WHEN epoch_us(ts) / 1e6 > (SELECT quantile_cont(epoch_us(ts) / 1e6, 0.8) FROM events)
  THEN 'test' ELSE 'train' END AS split FROM events""")
def q_temporal_holdout(spark, sf):
    out, _cut = split.temporal_holdout(event_frame(spark, sf), "ts", 0.2)
    return out.select("_src_idx", "split")


# -- 2.7 metrics on (actual, predicted) ----------------------------------------

LAB_A = "CAST(CAST(late AS DOUBLE) AS VARCHAR)"
LAB_P = "CAST(prediction AS VARCHAR)"


@query("accuracy", f"""SELECT count(*) AS "rows",
  round(avg(CASE WHEN {LAB_A} = {LAB_P} THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM {SC} s""")
def q_accuracy(spark, sf):
    return round_doubles(metrics.accuracy(scored_frame(spark, sf), "late", "prediction"))


@query("binary_cells", f"""SELECT count(*) FILTER (WHERE late = 0 AND prediction = 0.0) AS tn, count(*) FILTER (WHERE late = 0 AND prediction = 1.0) AS fp,
  count(*) FILTER (WHERE late = 1 AND prediction = 0.0) AS fn, count(*) FILTER (WHERE late = 1 AND prediction = 1.0) AS tp FROM {SC} s""")
def q_binary_cells(spark, sf):
    return metrics.binary_cells(scored_frame(spark, sf), "late", "prediction")


@query("rmse_r2", f"""SELECT count(*) AS "rows", round(sqrt(avg((o_totalprice - sum_price) ^ 2)), 4) AS rmse,
  round(1 - sum((o_totalprice - sum_price) ^ 2) / (var_pop(o_totalprice) * count(*)), 6) AS r2
FROM {OF} t WHERE o_totalprice IS NOT NULL AND sum_price IS NOT NULL""")
def q_rmse_r2(spark, sf):
    out = metrics.rmse_r2(order_frame(spark, sf), "o_totalprice", "sum_price")
    return round_doubles(out.withColumn("rmse", F.round("rmse", 4)))


CM_SQL = f"""(WITH s AS {SC},
lab AS (SELECT DISTINCT v FROM (SELECT {LAB_A} AS v FROM s UNION ALL SELECT {LAB_P} FROM s) u WHERE v IS NOT NULL),
obs AS (SELECT {LAB_A} AS actual, {LAB_P} AS predicted, count(*) AS n FROM s
        WHERE late IS NOT NULL AND prediction IS NOT NULL GROUP BY 1, 2)
SELECT a.v AS actual, p.v AS predicted, coalesce(obs.n, 0) AS "count" FROM lab a CROSS JOIN lab p
LEFT JOIN obs ON obs.actual = a.v AND obs.predicted = p.v)"""


@query("confusion_matrix", f"SELECT * FROM {CM_SQL} c")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored_frame(spark, sf), "late", "prediction")


@query("classification_report", f"""
WITH cm AS {CM_SQL},
per AS (SELECT actual AS label, sum(CASE WHEN actual = predicted THEN "count" END) AS tp, sum("count") AS support
        FROM cm GROUP BY actual),
pc AS (SELECT predicted AS label, sum("count") AS pred_n FROM cm GROUP BY predicted),
cls AS (SELECT per.label, per.tp, per.support,
  coalesce(CASE WHEN pred_n = 0 THEN NULL ELSE tp * 1.0 / pred_n END, 0.0) AS precision,
  coalesce(CASE WHEN support = 0 THEN NULL ELSE tp * 1.0 / support END, 0.0) AS recall FROM per JOIN pc USING (label)),
cls2 AS (SELECT *, coalesce(CASE WHEN precision + recall = 0 THEN NULL ELSE 2 * precision * recall / (precision + recall) END, 0.0)
  AS f1 FROM cls),
allr AS (SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM cls2
  UNION ALL SELECT 'accuracy', round(sum(tp) * 1.0 / sum(support), 6), round(sum(tp) * 1.0 / sum(support), 6),
    round(sum(tp) * 1.0 / sum(support), 6), sum(support) FROM cls2
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM cls2
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
    round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support) FROM cls2)
SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM allr""")
def q_classification_report(spark, sf):
    return round_doubles(metrics.classification_report(scored_frame(spark, sf), "late", "prediction"))


@query("class_distribution_compare", f"""
SELECT label, count(*) FILTER (WHERE w = 0) AS actual_count, count(*) FILTER (WHERE w = 1) AS predicted_count FROM (
  SELECT 0 AS w, {LAB_A} AS label FROM {SC} a UNION ALL SELECT 1, {LAB_P} FROM {SC} b) u
WHERE label IS NOT NULL GROUP BY label""")
def q_class_distribution_compare(spark, sf):
    return metrics.class_distribution_compare(scored_frame(spark, sf), "late", "prediction")


@query("error_rate_by_class", f"""
WITH d AS (SELECT {LAB_A} AS label, {LAB_A} <> {LAB_P} AS wrong FROM {SC} s WHERE late IS NOT NULL),
u AS (SELECT label, count(*) AS "rows", count(*) FILTER (WHERE wrong) AS errors FROM d GROUP BY label
      UNION ALL SELECT 'ALL', count(*), count(*) FILTER (WHERE wrong) FROM d)
SELECT label, "rows", errors, round(errors * 1.0 / "rows", 6) AS error_rate, round(1 - errors * 1.0 / "rows", 6) AS accuracy
FROM u""")
def q_error_rate_by_class(spark, sf):
    return round_doubles(metrics.error_rate_by_class(scored_frame(spark, sf), "late", "prediction"))


RESID = f"(SELECT _src_idx, o_totalprice - sum_price AS residual FROM {OF} t)"


@query("residuals", f"""SELECT _src_idx, o_totalprice AS actual, sum_price AS predicted,
  round(o_totalprice - sum_price, 6) AS residual FROM {OF} t""")
def q_residuals(spark, sf):
    return round_doubles(metrics.residuals(order_frame(spark, sf), "o_totalprice", "sum_price", "_src_idx"))


@query("residual_histogram", _hist_sql(RESID, "residual", 40, d=4))
def q_residual_histogram(spark, sf):
    r = metrics.residuals(order_frame(spark, sf), "o_totalprice", "sum_price", "_src_idx")
    return round_doubles(profile.histogram(r, "residual", 40), 4)


@query("identity_line", f"SELECT least(min(o_totalprice), min(sum_price)) AS lo, greatest(max(o_totalprice), "
                        f"max(sum_price)) AS hi FROM {OF} t")
def q_identity_line(spark, sf):
    return round_doubles(metrics.identity_line(order_frame(spark, sf), "o_totalprice", "sum_price"))


@query("train_test_gap", f"""
WITH j AS (SELECT s.late, s.prediction, p.split FROM {SC} s JOIN {SPLIT_OF} p ON s._src_idx = p._src_idx),
a AS (SELECT avg(CASE WHEN split = 'train' THEN CASE WHEN CAST(late AS DOUBLE) = prediction THEN 1.0 ELSE 0.0 END END) AS tr,
             avg(CASE WHEN split = 'test' THEN CASE WHEN CAST(late AS DOUBLE) = prediction THEN 1.0 ELSE 0.0 END END) AS te FROM j)
SELECT round(tr, 6) AS train_score, round(te, 6) AS test_score, round(tr - te, 6) AS gap,
  CASE WHEN tr - te > 0.05 THEN 'overfitting' WHEN tr - te < -0.05 THEN 'underfitting' ELSE 'good fit' END AS fit FROM a""")
def q_train_test_gap(spark, sf):
    s = scored_frame(spark, sf)
    sp = split.train_test_split(order_frame(spark, sf).select("_src_idx", "late"), "_src_idx", "late").select(
        "_src_idx", "split")
    return round_doubles(metrics.train_test_gap(s.join(sp, "_src_idx"), "late", "prediction"))


@query("high_confidence_tiers", f"""
SELECT tier, count(*) AS "rows" FROM (SELECT CASE WHEN p > 0.8 THEN 'high' WHEN p >= 0.5 THEN 'medium'
  WHEN p IS NOT NULL THEN 'low' END AS tier FROM (SELECT CASE WHEN prediction = 1.0 THEN prediction_proba
  ELSE 1 - prediction_proba END AS p FROM {SC} s) a) b WHERE tier IS NOT NULL GROUP BY tier""")
def q_high_confidence_tiers(spark, sf):
    s = scored_frame(spark, sf)
    s = s.withColumn("proba_1", F.when(F.col("prediction") == 1.0, F.col("prediction_proba"))
                     .otherwise(1 - F.col("prediction_proba")))
    return metrics.high_confidence_tiers(s, "proba_1")


# -- 2.8 hypotheses -----------------------------------------------------------

SPECS = [
    {"id": "H1", "statement": "Later line numbers ship late more often", "kind": "group_mean", "key": "l_linenumber",
     "target": "late", "expected_direction": "positive"},
    {"id": "H2", "statement": "Order priority changes the late rate", "kind": "group_mean_count",
     "key": "o_orderpriority", "target": "late", "expected_direction": "none"},
    {"id": "H3", "statement": "Longer delays in years mean more late lines", "kind": "group_mean_derived",
     "key": "delay_years", "expr": DELAY_YEARS, "target": "late", "expected_direction": "positive"},
    {"id": "H4", "statement": "Market segment changes the late rate", "kind": "group_mean_count",
     "key": "c_mktsegment", "target": "late", "expected_direction": "none"},
    {"id": "H5", "statement": "Region changes the late rate", "kind": "group_mean_count", "key": "r_name",
     "target": "late", "expected_direction": "none"},
    {"id": "H6", "statement": "Pricier lines ship late less often", "kind": "quantile_buckets",
     "key": "l_extendedprice", "q": 4, "labels": QLABELS, "target": "late", "expected_direction": "negative"},
    {"id": "H7", "statement": "Nation changes the late rate", "kind": "group_mean_count", "key": "n_name",
     "target": "late", "expected_direction": "none"},
]


def _spec_sql(s):
    if s["kind"] == "quantile_buckets":
        return f"""SELECT 'H6' AS id, bucket AS grp, CAST(CASE bucket WHEN 'lowest' THEN 1 WHEN 'lower' THEN 2 WHEN 'upper' THEN 3
  ELSE 4 END AS DOUBLE) AS ord, avg(late) AS mean, count(late) AS "count" FROM (
  SELECT late, CASE WHEN l_extendedprice <= q[1] THEN 'lowest' WHEN l_extendedprice <= q[2] THEN 'lower'
    WHEN l_extendedprice <= q[3] THEN 'upper' ELSE 'highest' END AS bucket FROM {LF} t,
    (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM {LF} t2) e
  WHERE l_extendedprice IS NOT NULL) b GROUP BY bucket"""
    key = DELAY_YEARS if s["kind"] == "group_mean_derived" else s["key"]
    ordc = f"CAST({key} AS DOUBLE)" if s["key"] in ("l_linenumber", "delay_years") else "CAST(NULL AS DOUBLE)"
    return (f"SELECT {S.lit(s['id'])} AS id, CAST({key} AS VARCHAR) AS grp, {ordc} AS ord, avg(late) AS mean, "
            f"count(late) AS \"count\" FROM {LF} t WHERE {key} IS NOT NULL GROUP BY {key}")


HYP_RESULTS = "(" + "\nUNION ALL\n".join(_spec_sql(s) for s in SPECS) + ")"


def _hyp_results(spark, sf):
    return hyp.run_hypotheses(line_facts(spark, sf), SPECS)


@query("hypothesis_test", f"SELECT id, grp, ord, round(mean, 6) AS mean, \"count\" FROM {HYP_RESULTS} h")
def q_hypothesis_test(spark, sf):
    return round_doubles(_hyp_results(spark, sf))


SPEC_VALUES = "(VALUES " + ", ".join(f"({S.lit(s['id'])}, {S.lit(s['statement'])}, {S.lit(s['expected_direction'])})"
                                     for s in SPECS) + ") AS sp(id, statement, expected_direction)"

VERDICT_SQL = f"""(WITH r AS {HYP_RESULTS},
g AS (SELECT id, count(*) AS groups FROM r GROUP BY id),
s AS (SELECT id, count(*) AS supported, max(mean) - min(mean) AS spread,
  {S.corr('ord', 'mean')} AS direction_corr FROM r WHERE "count" >= 30 GROUP BY id)
SELECT sp.id, sp.statement, sp.expected_direction, coalesce(g.groups, 0) AS groups, coalesce(s.supported, 0) AS supported,
  round(s.spread, 6) AS spread, round(s.direction_corr, 6) AS direction_corr,
  CASE WHEN coalesce(s.supported, 0) < 2 THEN 'INCONCLUSIVE'
       WHEN s.spread >= 0.05 AND coalesce(CASE WHEN sp.expected_direction = 'positive' THEN s.direction_corr > 0
            WHEN sp.expected_direction = 'negative' THEN s.direction_corr < 0 ELSE true END, false) THEN 'TRUE'
       ELSE 'FALSE' END AS verdict
FROM {SPEC_VALUES} LEFT JOIN g ON g.id = sp.id LEFT JOIN s ON s.id = sp.id)"""


def _verdicts(spark, sf):
    return hyp.hypothesis_verdict(_hyp_results(spark, sf), hyp.specs_frame(spark, SPECS), 30, 0.05)


STATISTICS_SQL = f"""(WITH t AS (SELECT id, count(*) AS groups, CAST(sum("count") AS BIGINT) AS n, sum(mean * "count") AS s,
  sum(mean * mean * "count") AS between FROM {HYP_RESULTS} r GROUP BY id)
SELECT id, groups, n, round((between - s * s / n) / (groups - 1) / ((s - between) / (n - groups)), 6) AS f_stat,
  round((between - s * s / n) / (s / n * (1 - s / n)), 6) AS chi2 FROM t)"""


def _statistics(spark, sf):
    return hyp.test_statistics(line_facts(spark, sf), SPECS)


@query("hypothesis_statistics", f"""SELECT id, groups, n, CASE WHEN n > 0 THEN f_stat END AS f_stat, chi2, true AS sound
FROM {STATISTICS_SQL} t""")
def q_hypothesis_statistics(spark, sf):
    """F and chi-square of every hypothesis; ``sound``: the p-values lie in 0 to 1 and the corrected one is not smaller."""
    sound = (F.col("f_p").between(0.0, 1.0) & F.col("chi2_p").between(0.0, 1.0) & F.col("p_holm").between(F.col("p_value"), F.lit(1.0)))
    return round_doubles(_statistics(spark, sf).select("id", "groups", "n", "f_stat", "chi2", F.coalesce(sound, F.lit(False)).alias("sound")))


@query("verdict_by_test")
def q_verdict_by_test(spark, sf):
    results, statistics = hyp.results_and_statistics(line_facts(spark, sf), SPECS)
    return hyp.verdict_by_test(results, statistics, hyp.specs_frame(spark, SPECS))


@query("hypothesis_verdict", f"SELECT * FROM {VERDICT_SQL} v")
def q_hypothesis_verdict(spark, sf):
    return round_doubles(_verdicts(spark, sf).select("id", "statement", "expected_direction", "groups", "supported",
                                                     "spread", "direction_corr", "verdict"))


@query("verdict_counts", f"SELECT verdict, count(*) AS \"count\" FROM {VERDICT_SQL} v GROUP BY verdict")
def q_verdict_counts(spark, sf):
    return hyp.verdict_counts(_verdicts(spark, sf))


@query("confirmed_insights", f"SELECT id, statement FROM {VERDICT_SQL} v WHERE verdict = 'TRUE'")
def q_confirmed_insights(spark, sf):
    return hyp.confirmed_insights(_verdicts(spark, sf))


# -- remaining selection / encoding items ------------------------------------

@query("base_columns", f"SELECT o_totalprice, n_lines, sum_qty, sum_price, avg_discount, avg_tax, c_acctbal, late "
                       f"FROM {STD_FEATS_SQL} s")
def q_base_columns(spark, sf):
    f = _std_frame(spark, sf)
    return f.select(*select.base_columns(f, 8, exclude=("_src_idx",)))


@query("label_decode", f"""SELECT _src_idx, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER)
  AS o_orderpriority_idx, o_orderpriority AS decoded FROM {OF} t""")
def q_label_decode(spark, sf):
    enc, levels = features.label_encode(order_frame(spark, sf).select("_src_idx", "o_orderpriority"), "o_orderpriority")
    return features.label_decode(enc, "o_orderpriority_idx", levels, "decoded").select("_src_idx", "o_orderpriority_idx", "decoded")


LEVEL_COLS = ["l_shipdate", "l_partkey", "l_returnflag", "l_extendedprice"]
_LEVEL_TEXT = {"l_shipdate": "strftime(l_shipdate, '%Y-%m-%d')", "l_partkey": "CAST(l_partkey AS VARCHAR)", "l_returnflag": "l_returnflag",
               "l_extendedprice": "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)"}


def _level_lines(spark, sf):
    li = load_table(spark, sf, "lineitem")
    return li.select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"), F.col("l_partkey").cast("string").alias("l_partkey"),
                     "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("long").cast("string").alias("l_extendedprice"))


@query("level_dictionary", "\nUNION ALL\n".join(
    f"""SELECT {S.lit(c)} AS "column", level, row_number() OVER (ORDER BY level) - 1 AS code, n
FROM (SELECT {_LEVEL_TEXT[c]} AS level, count(*) AS n FROM lineitem GROUP BY 1) t WHERE level IS NOT NULL""" for c in LEVEL_COLS))
def q_level_dictionary(spark, sf):
    """Sorted levels of four text columns, one of them with almost as many levels as rows."""
    return level_dictionary(_level_lines(spark, sf), LEVEL_COLS)


@query("label_encode_wide", f"""SELECT l_orderkey, l_extendedprice, CAST(dense_rank() OVER (ORDER BY l_extendedprice) - 1 AS INTEGER) AS code,
  l_extendedprice AS decoded FROM (SELECT l_orderkey, {_LEVEL_TEXT['l_extendedprice']} AS l_extendedprice FROM lineitem) t""")
def q_label_encode_wide(spark, sf):
    """A column with almost as many levels as rows, encoded and decoded without a level on the driver."""
    enc, levels = features.label_encode(_level_lines(spark, sf).select("l_orderkey", "l_extendedprice"), "l_extendedprice", "code")
    return features.label_decode(enc, "code", levels, "decoded")


@query("one_hot_vector", f"""WITH t AS (SELECT l_orderkey, {_LEVEL_TEXT['l_partkey']} AS l_partkey FROM lineitem)
SELECT l_orderkey, l_partkey, '(' || size || CASE WHEN place >= 0 THEN ',[' || place || '],[1.0])' ELSE ',[],[])' END AS dummies FROM (
  SELECT *, dense_rank() OVER (ORDER BY l_partkey) - 2 AS place, (SELECT count(DISTINCT l_partkey) - 1 FROM t) AS size FROM t) u""")
def q_one_hot_vector(spark, sf):
    """One sparse vector over all levels but the first, shown as (size,[place],[1.0])."""
    out, names = features.one_hot(_level_lines(spark, sf).select("l_orderkey", "l_partkey"), ["l_partkey"], form="vector", drop_source=False)
    return out.select("l_orderkey", "l_partkey", F.col(names[0]).cast("string").alias("dummies"))


@query("target_config", f"""SELECT 'late' AS target_col, CASE WHEN count(DISTINCT late) <= 15 THEN 'classification'
  WHEN count(DISTINCT late) <= 30 THEN 'classification' WHEN count(DISTINCT late) * 1.0 / count(*) < 0.05
  THEN 'classification' ELSE 'regression' END AS problem_type, count(DISTINCT late) AS nunique, count(*) AS n FROM {OF} t""")
def q_target_config(spark, sf):
    """No target given: the last numeric column (older rule), typed by the problem-type rules."""
    f = order_frame(spark, sf)
    t = features.choose_target(f)
    return features.detect_problem_type(f, [t]).select(F.col("column").alias("target_col"), "problem_type",
                                                       "nunique", "n")
