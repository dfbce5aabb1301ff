"""DuckDB SQL text for the oracles: shared sub-queries and per-column generators.

These strings restate the same semantics in plain SQL so an independent
engine can check every registered Spark query.
"""

from __future__ import annotations

LATE_SQL = "CASE WHEN l.l_shipdate > o.o_orderdate + INTERVAL 30 DAY THEN 1 ELSE 0 END"

LINE_LATE = f"""(SELECT l.*, o.*, CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS delay_days,
  {LATE_SQL} AS late FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

LINE_FACTS = f"""(SELECT lf.*, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name FROM {LINE_LATE} lf
  JOIN customer c ON lf.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

# exact sum of a money column as a wide decimal, turned into a double once
MONEY_SUM = "CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE)"

ORDER_FRAME = f"""(WITH lines AS (
  SELECT l.l_orderkey, count(*) AS n_lines, sum(l.l_quantity) AS sum_qty, {MONEY_SUM.format(c="l.l_extendedprice")} AS sum_price,
         {MONEY_SUM.format(c="l.l_discount")} / CAST(count(l.l_discount) AS DOUBLE) AS avg_discount,
         {MONEY_SUM.format(c="l.l_tax")} / CAST(count(l.l_tax) AS DOUBLE) AS avg_tax, avg({LATE_SQL}) AS late_share
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY l.l_orderkey)
SELECT o.o_orderkey AS _src_idx, o.o_totalprice, coalesce(li.n_lines, 0) AS n_lines, coalesce(li.sum_qty, 0.0) AS sum_qty,
       coalesce(li.sum_price, 0.0) AS sum_price, coalesce(li.avg_discount, 0.0) AS avg_discount,
       coalesce(li.avg_tax, 0.0) AS avg_tax, c.c_acctbal, o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, r.r_name,
       n.n_name, CAST(coalesce(li.late_share, 0.0) > 0.5 AS INTEGER) AS late
FROM orders o LEFT JOIN lines li ON o.o_orderkey = li.l_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

ORDER_COLS = [("_src_idx", "bigint"), ("o_totalprice", "double"), ("n_lines", "bigint"), ("sum_qty", "double"),
              ("sum_price", "double"), ("avg_discount", "double"), ("avg_tax", "double"), ("c_acctbal", "double"),
              ("o_orderpriority", "string"), ("o_orderstatus", "string"), ("c_mktsegment", "string"),
              ("r_name", "string"), ("n_name", "string"), ("late", "int")]
ORDER_NUM = ["o_totalprice", "n_lines", "sum_qty", "sum_price", "avg_discount", "avg_tax", "c_acctbal"]

SCORED = f"""(SELECT *, CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') OR n_lines > 4 THEN 1 ELSE 0 END AS DOUBLE)
  AS prediction, round(0.5 + CAST(_src_idx % 50 AS DOUBLE) / 100, 4) AS prediction_proba FROM {ORDER_FRAME} of0)"""

LINEITEM_COLS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")]

NUMERIC_TYPES = {"bigint", "int", "double", "smallint", "tinyint", "float"}


def q(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def skew(x: str) -> str:
    return (f"CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0.0 "
            f"ELSE skewness({x}) END")


def corr(x: str, y: str) -> str:
    xp, yp = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    den = f"(stddev_samp({xp}) * stddev_samp({yp}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE covar_samp({x}, {y}) / {den} END"


def r(expr: str, d: int) -> str:
    return f"round({expr}, {d})"


def column_profile(src: str, cols, d: int = 4) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        x = f"CAST({q(c)} AS DOUBLE)"
        isnum = t in NUMERIC_TYPES
        num = (lambda e: r(e, d)) if isnum else (lambda e: "CAST(NULL AS DOUBLE)")
        parts.append(
            f"SELECT {lit(c)} AS \"column\", {i} AS position, {lit(t)} AS dtype, count(DISTINCT {q(c)}) AS nunique, "
            f"{r(f'CAST(count_if({q(c)} IS NULL) AS DOUBLE) * 100 / count(*)', d)} AS null_pct, "
            f"{num(f'avg({x})')} AS mean, {num(f'stddev_samp({x})')} AS std, {num(f'min({x})')} AS min, "
            f"{num(f'max({x})')} AS max, {num(skew(x))} AS skew FROM {src} s")
    return "\nUNION ALL\n".join(parts)


def describe(src: str, cols, d: int = 4, only_numeric: bool = False) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        x = f"CAST({q(c)} AS DOUBLE)"
        isnum = t in NUMERIC_TYPES
        if isnum:
            qs = [r(f"quantile_cont({x}, {p})", d) for p in (0.25, 0.5, 0.75)]
            body = (f"{r(f'avg({x})', d)} AS mean, {r(f'stddev_samp({x})', d)} AS std, {r(f'min({x})', d)} AS min, "
                    f"{qs[0]} AS q25, {qs[1]} AS q50, {qs[2]} AS q75, {r(f'max({x})', d)} AS max")
            strs = "CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq"
        else:
            body = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
            top = (f"(SELECT v FROM (SELECT {q(c)} AS v, count(*) AS n FROM {src} t2 WHERE {q(c)} IS NOT NULL "
                   f"GROUP BY 1) ORDER BY n DESC, v LIMIT 1)")
            freq = (f"(SELECT n FROM (SELECT {q(c)} AS v, count(*) AS n FROM {src} t2 WHERE {q(c)} IS NOT NULL "
                    f"GROUP BY 1) ORDER BY n DESC, v LIMIT 1)")
            strs = f"count(DISTINCT {q(c)}) AS \"unique\", {top} AS top, {freq} AS freq"
        if only_numeric:
            parts.append(f"SELECT {lit(c)} AS \"column\", {i} AS position, count({q(c)}) AS \"count\", {body} FROM {src} s")
        else:
            parts.append(f"SELECT {lit(c)} AS \"column\", {i} AS position, count({q(c)}) AS \"count\", {strs}, {body} "
                         f"FROM {src} s")
    return "\nUNION ALL\n".join(parts)


def corr_pairs(src: str, cols: list[str], d: int = 6) -> str:
    parts = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            x, y = f"CAST({q(cols[i])} AS DOUBLE)", f"CAST({q(cols[j])} AS DOUBLE)"
            parts.append(f"SELECT {lit(cols[i])} AS col_a, {lit(cols[j])} AS col_b, {i} AS pos_a, {j} AS pos_b, "
                         f"{r(corr(x, y), d)} AS corr FROM {src} s")
    return "\nUNION ALL\n".join(parts)
