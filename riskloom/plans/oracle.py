"""DuckDB SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from riskloom.operators.selection import METHOD_THRESHOLDS
from riskloom.plans.fixtures import CATEGORICAL, NUMERIC, PREDICTORS
from riskloom.plans.queries import (
    CORR_COLUMNS,
    GROUP_METHODS,
    IV_COLUMNS,
    SPEC_NUMERIC,
    TOP,
    USELESS_COLUMNS,
)

FIXTURES = """
WITH perf AS (
  SELECT o_orderkey AS record_id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS funded,
         CASE WHEN o_orderdate >= TIMESTAMP '2000-04-01 00:00:00' THEN 'OOT'
              WHEN o_orderkey % 4 = 0 THEN 'Test' ELSE 'Train' END AS sample_group
  FROM orders),
feat_0 AS (
  SELECT l_orderkey AS record_id, CAST(COUNT(*) AS BIGINT) AS li_cnt, SUM(l_quantity) AS li_qty_sum,
         MAX(l_extendedprice) AS li_price_max, MIN(l_discount) AS li_disc_min,
         MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS li_has_return
  FROM lineitem GROUP BY l_orderkey),
feat_1 AS (
  SELECT o_orderkey AS record_id, o_totalprice AS ord_totalprice,
         o_totalprice * CAST(2.0 AS DOUBLE) + CAST(1.0 AS DOUBLE) AS ord_totalprice_x2,
         CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS ord_price_gappy,
         o_orderpriority AS ord_priority, CAST(1 AS INT) AS ord_const
  FROM orders),
feat_2 AS (
  SELECT o.o_orderkey AS record_id, c.c_acctbal AS cust_acctbal, c.c_mktsegment AS cust_segment,
         n.n_name AS cust_nation, c.c_acctbal / CAST(10.0 AS DOUBLE) AS cust_internal_score_v3,
         c.c_mktsegment AS cust_reason_code_1
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
feat_3 AS (
  SELECT o_orderkey AS record_id,
         CAST(1.0 AS DOUBLE) / CAST(1 + o_orderkey % 97 AS DOUBLE) AS drv_skewed,
         CASE WHEN o_orderkey % 500 = 0 THEN o_totalprice * CAST(100.0 AS DOUBLE) ELSE o_totalprice END AS drv_outlier,
         CASE WHEN o_orderkey % 200 = 0 THEN 'B' ELSE 'A' END AS drv_near_const,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CONCAT('G', CAST(o_custkey % 80 AS VARCHAR)) END AS drv_high_card
  FROM orders),
risk_raw AS (
  SELECT p.*, f0.li_cnt, f0.li_qty_sum, f0.li_price_max, f0.li_disc_min, f0.li_has_return,
         f1.ord_totalprice, f1.ord_totalprice_x2, f1.ord_price_gappy, f1.ord_priority, f1.ord_const,
         f2.cust_acctbal, f2.cust_segment, f2.cust_nation, f2.cust_internal_score_v3, f2.cust_reason_code_1,
         f3.drv_skewed, f3.drv_outlier, f3.drv_near_const, f3.drv_high_card
  FROM perf p LEFT JOIN feat_0 f0 ON p.record_id = f0.record_id
              LEFT JOIN feat_1 f1 ON p.record_id = f1.record_id
              LEFT JOIN feat_2 f2 ON p.record_id = f2.record_id
              LEFT JOIN feat_3 f3 ON p.record_id = f3.record_id),
guarded AS (SELECT * EXCLUDE (cust_internal_score_v3, cust_reason_code_1) FROM risk_raw),
risk_signal AS (
  SELECT *, CASE WHEN (ord_totalprice > 430000 AND record_id % 10 <> 3) OR record_id % 10 = 0
                 THEN 1 ELSE 0 END AS flagged
  FROM risk_raw),
scored AS (
  SELECT record_id, sample_group, flagged AS label,
         CAST(FLOOR(ord_totalprice / CAST(5000.0 AS DOUBLE)) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS score
  FROM risk_signal),
fake_runs AS (
  SELECT p_partkey AS experiment_id, p_brand AS feature_set, p_type AS model_family, p_size AS n_features,
         CAST((p_partkey * 7919) % 1000 AS DOUBLE) / CAST(2000.0 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS oot_roc_auc
  FROM part),
fake_scores AS (
  SELECT p_type AS method, p_brand AS feature,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'Filter'
              WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'Logistic Regression'
              ELSE 'Tree-Based' END AS grp,
         CAST(SUM(p_size) AS DOUBLE) AS score
  FROM part GROUP BY p_type, p_brand)
"""

# Columns of the guarded table with the type names Spark reports.
GUARDED = [
    ("record_id", "bigint"), ("funded", "int"), ("sample_group", "string"), ("li_cnt", "bigint"),
    ("li_qty_sum", "double"), ("li_price_max", "double"), ("li_disc_min", "double"), ("li_has_return", "int"),
    ("ord_totalprice", "double"), ("ord_totalprice_x2", "double"), ("ord_price_gappy", "double"),
    ("ord_priority", "string"), ("ord_const", "int"), ("cust_acctbal", "double"), ("cust_segment", "string"),
    ("cust_nation", "string"), ("drv_skewed", "double"), ("drv_outlier", "double"),
    ("drv_near_const", "string"), ("drv_high_card", "string"),
]
NAMES = [n for n, _ in GUARDED]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

ORACLES: dict[str, str] = {}


def put(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = FIXTURES.replace("WITH", "WITH RECURSIVE", 1) + "".join(f", {c}" for c in ctes) + "\n" + select


def rnd(x: str, dp: int = 6) -> str:
    return f"(FLOOR(CAST({x} AS DOUBLE) * 1e{dp} + 0.5) / 1e{dp})"


def union(parts: Sequence[str]) -> str:
    return "\nUNION ALL ".join(parts)


def long(source: str, columns: Sequence[str], keep: str = "record_id", cast: str = "DOUBLE") -> str:
    return union([f"SELECT {keep}, '{c}' AS \"column\", CAST({c} AS {cast}) AS value FROM {source}" for c in columns])


# -- scans, schema ----------------------------------------------------------

ORACLES["scan_csv_nulls"] = """
SELECT c_custkey,
       CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 3 = 0 OR c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer"""
ORACLES["scan_csv_lenient"] = """
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey
FROM customer"""
ORACLES["scan_parquet"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
ORACLES["schema_columns"] = "SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i} AS INTEGER), '{n}', '{t}', {str(n != 'funded').lower()})" for i, (n, t) in enumerate(GUARDED, start=1)
) + ") t(position, \"column\", data_type, is_feature)"
put("dataset_profile", f"""
SELECT COUNT(*) AS n_rows, CAST({len(GUARDED)} AS BIGINT) AS n_cols,
       {rnd(f"COUNT(*) * {len(GUARDED) * 8} / 1073741824.0")} AS dense_gb FROM guarded""")

# -- projections, filters ---------------------------------------------------

put("prohibited_guard", "SELECT * FROM guarded")
put("drop_useless", "SELECT " + ", ".join(
    c for c in USELESS_COLUMNS if c not in ("record_id", "ord_totalprice", "ord_const")) + " FROM risk_raw")
put("split_filter", "SELECT record_id, funded, sample_group FROM risk_raw WHERE sample_group = 'Train'")
ORACLES["numeric_features"] = """
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'li_cnt'), (2, 'ord_price_gappy'), (3, 'drv_skewed')) t(position, feature)"""
put("fill_zero", """
SELECT record_id, COALESCE(funded, 0) AS funded, COALESCE(li_cnt, 0) AS li_cnt,
       COALESCE(ord_price_gappy, 0.0) AS ord_price_gappy FROM risk_raw""")
DUMMIES = ", ".join(
    f"CAST(CASE WHEN cust_segment = '{s}' THEN 1 ELSE 0 END AS TINYINT) AS cust_segment_{s}" for s in SEGMENTS
)
put("align_features", f"SELECT record_id, ord_price_gappy, {DUMMIES}, funded FROM risk_raw")

# -- joins ------------------------------------------------------------------

put("star_left_join", "SELECT * FROM risk_raw")


def corr(a: str, b: str) -> str:
    r = f"CORR(COALESCE({a}, 0), COALESCE({b}, 0))"
    return f"CASE WHEN isnan({r}) THEN NULL ELSE {r} END"


put("corr_pairs", f"SELECT feature_a, feature_b, {rnd('r')} AS r FROM pairs WHERE ABS(r) > 0.95", "pairs AS (" + union([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {corr(a, b)} AS r FROM risk_raw"
    for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]]) + ")")
put("corr_matrix", f"SELECT feature_a, feature_b, {rnd('r')} AS r FROM pairs", "pairs AS (" + union([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
    + (corr(a, b) if a != b or a == "ord_const" else "CAST(1.0 AS DOUBLE)") + " AS r FROM risk_raw"
    + ("" if a != b or a == "ord_const" else " HAVING COUNT(*) > 0")
    for a in CORR_COLUMNS for b in CORR_COLUMNS]) + ")")
put("experiment_grid", """
SELECT CAST((s.position - 1) * COUNT(*) OVER (PARTITION BY s.feature_set) + c.slot AS BIGINT) AS experiment_id, s.feature_set, s.n_features,
       c.model_id, c.model_label, c.model_family, c.scaler, c.imbalance
FROM sets s CROSS JOIN combos c""",
    """sets AS (SELECT method AS feature_set, COUNT(*) FILTER (WHERE score > 0) AS n_features,
                ROW_NUMBER() OVER (ORDER BY method) AS position FROM fake_scores GROUP BY method)""",
    """models AS (SELECT * FROM (VALUES
      (1, 'LR_L1', 'LR L1 C=0.1', 'Logistic Regression', TRUE), (2, 'LR_L2', 'LR L2 C=1.0', 'Logistic Regression', TRUE),
      (3, 'LR_EN', 'LR ElasticNet l1=0.5', 'Logistic Regression', TRUE), (4, 'DT_d5', 'Decision Tree depth=5', 'Decision Tree', FALSE),
      (5, 'GNB', 'Gaussian Naive Bayes', 'Naive Bayes', FALSE), (6, 'RF_n60_d6', 'Random Forest n=60 depth=6', 'Random Forest', FALSE),
      (7, 'GB_lr0.1_d4', 'Gradient Boosting n=60 depth=4', 'Gradient Boosting', FALSE)) t(m, model_id, model_label, model_family, scaled))""",
    """scalers AS (SELECT * FROM (VALUES (1, 'StandardScaler', TRUE), (2, 'RobustScaler', TRUE), (3, 'MinMaxScaler', TRUE),
      (4, 'No Scaling', FALSE)) t(k, scaler, scaled))""",
    """weights AS (SELECT * FROM (VALUES (1, 'class_weight=balanced'), (2, 'No weighting'), (3, 'RandomUnderSampler')) t(w, imbalance))""",
    """combos AS (SELECT *, ROW_NUMBER() OVER (ORDER BY m, k, w) AS slot FROM models JOIN scalers USING (scaled) CROSS JOIN weights)""")

# -- aggregates -------------------------------------------------------------

put("row_count", "SELECT COUNT(*) AS n_rows FROM risk_raw")
MISSING = "missing AS (SELECT *, " + rnd("missing_count * 100.0 / n", 4) + " AS missing_pct FROM (" + union([
    f"SELECT {i} AS pos, '{c}' AS \"column\", COUNT(*) AS n, COUNT(*) - COUNT({c}) AS missing_count FROM guarded"
    for i, c in enumerate(NAMES)]) + "))"
put("missing_counts", 'SELECT "column", missing_count, missing_pct FROM missing', MISSING)
DISTINCT = "cards AS (" + union([
    f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_unique FROM guarded" for c in NAMES]) + ")"
put("cardinality", 'SELECT "column", n_unique FROM cards', DISTINCT)
SEVERITY = """
SELECT "column", missing_count, missing_pct,
       CASE WHEN missing_pct > 30 THEN 'Critical' WHEN missing_pct > 5 THEN 'High'
            WHEN missing_pct > 0 THEN 'Low' ELSE 'Complete' END AS severity,
       CASE WHEN missing_pct > 60 THEN 'Consider dropping column'
            WHEN missing_pct > 5 THEN 'Impute with median/mode or create missing indicator'
            WHEN missing_pct > 0 THEN 'Simple imputation' ELSE 'No action required' END AS action
FROM missing"""
put("missing_severity", SEVERITY, MISSING)
put("missing_top40", 'SELECT "column", missing_pct FROM missing ORDER BY missing_pct DESC, "column" LIMIT 40', MISSING)


def missing_summary(source: str) -> str:
    return f"""
SELECT COUNT(*) AS n_columns, COUNT(*) FILTER (WHERE missing_pct > 30) AS n_high,
       COUNT(*) FILTER (WHERE missing_pct > 5 AND missing_pct <= 30) AS n_medium,
       COUNT(*) FILTER (WHERE missing_pct > 0 AND missing_pct <= 5) AS n_low,
       COUNT(*) FILTER (WHERE missing_pct = 0) AS n_complete,
       CAST(SUM(missing_count) AS BIGINT) AS total_missing,
       {rnd("SUM(missing_count) / CAST(SUM(n) AS DOUBLE) * 100.0")} AS overall_missing_pct,
       {rnd("1.0 - SUM(missing_count) / CAST(SUM(n) AS DOUBLE)")} AS completeness
FROM {source}"""


put("missing_summary", missing_summary("missing"), MISSING)


def stats_row(c: str) -> str:
    q = ", ".join(
        f"{rnd(f'QUANTILE_CONT({c}, {p})')} AS {n}" for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    )
    return (
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS n, COUNT(*) - COUNT({c}) AS n_missing, {rnd(f'AVG({c})')} AS mean, "
        f"{rnd(f'STDDEV_POP({c})')} AS std, CAST(MIN({c}) AS DOUBLE) AS min, {q}, CAST(MAX({c}) AS DOUBLE) AS max FROM risk_raw"
    )


put("numeric_stats", union([stats_row(c) for c in NUMERIC]))
put("value_counts", f"""
SELECT drv_high_card AS value, COUNT(*) AS count,
       {rnd("COUNT(*) * 100.0 / (SELECT COUNT(*) FROM risk_raw)", 4)} AS pct FROM risk_raw GROUP BY drv_high_card""")
put("target_distribution", f"""
SELECT flagged AS target_value, COUNT(*) AS count, {rnd("COUNT(*) * 100.0 / MAX(n)", 4)} AS pct,
       MAX(ratio) AS imbalance_ratio,
       CASE WHEN MAX(ratio) > 10 THEN 'danger' WHEN MAX(ratio) > 4 THEN 'warning' ELSE 'success' END AS imbalance_level
FROM risk_signal, (SELECT COUNT(*) AS n, {rnd("SUM(1 - flagged) / CAST(SUM(flagged) AS DOUBLE)", 1)} AS ratio FROM risk_signal)
GROUP BY flagged""")
TOPS = (
    "hist AS (SELECT \"column\", value, COUNT(*) AS cnt FROM (" + long("risk_raw", CATEGORICAL, cast="VARCHAR")
    + ') GROUP BY "column", value)',
    f"""tops AS (SELECT "column", COUNT(value) AS n_unique, SUM(cnt) AS n,
             FIRST(value ORDER BY cnt DESC, value ASC NULLS FIRST) AS top_value,
             {rnd('MAX(cnt) * 100.0 / SUM(cnt)', 4)} AS top_pct FROM hist GROUP BY "column")""",
)
put("categorical_summary", """
SELECT "column", n_unique, top_value, top_pct,
       CASE WHEN n_unique <= 10 THEN 'OHE' WHEN n_unique <= 50 THEN 'Ordinal/WoE' ELSE 'WoE/Target Encode' END AS encoding
FROM tops""", *TOPS)
put("near_constant", 'SELECT "column", top_pct AS dominant_pct FROM tops WHERE top_pct > 99', *TOPS)
put("skew_kurtosis", f"""
SELECT "column", {rnd("sk", 4)} AS skewness, {rnd("ku", 4)} AS kurtosis,
       CASE WHEN sk > 2 THEN 'High right skew' WHEN sk < -2 THEN 'High left skew'
            WHEN ABS(sk) > 1 THEN 'Moderate skew' ELSE 'Normal' END AS skew_flag,
       CASE WHEN ABS(sk) > 2 THEN 'Log/Box-Cox transform' WHEN ABS(sk) > 1 THEN 'Optional transform'
            ELSE 'No transform needed' END AS recommend
FROM (SELECT "column", AVG(POWER(value - mu, 3)) / POWER(AVG(POWER(value - mu, 2)), 1.5) AS sk,
             AVG(POWER(value - mu, 4)) / POWER(AVG(POWER(value - mu, 2)), 2) - 3 AS ku
      FROM long JOIN (SELECT "column", AVG(value) AS mu FROM long GROUP BY "column") USING ("column")
      WHERE value IS NOT NULL GROUP BY "column" HAVING COUNT(*) >= 10)""",
    "long AS (" + long("risk_raw", NUMERIC) + ")")
ORACLES["duplicate_rows"] = f"""
WITH g AS (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber, l_quantity)
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
       {rnd("COALESCE(SUM(n) FILTER (WHERE n > 1), 0) * 100.0 / SUM(n)")} AS duplicate_pct FROM g"""


def woe_ctes(columns: Sequence[str]) -> tuple[str, ...]:
    return (
        "binned AS (SELECT \"column\", NTILE(10) OVER (PARTITION BY \"column\" ORDER BY value, record_id) AS bin, flagged FROM ("
        + long("risk_signal", columns, "record_id, flagged") + ") WHERE value IS NOT NULL AND flagged IS NOT NULL)",
        """bins AS (SELECT "column", bin, CAST(SUM(CASE WHEN flagged = 1 THEN 1 ELSE 0 END) AS BIGINT) AS events,
                  CAST(SUM(CASE WHEN flagged = 1 THEN 0 ELSE 1 END) AS BIGINT) AS non_events
                  FROM binned GROUP BY "column", bin)""",
        """dist AS (SELECT *, events / CAST(SUM(events) OVER (PARTITION BY "column") AS DOUBLE) AS de,
                  non_events / CAST(SUM(non_events) OVER (PARTITION BY "column") AS DOUBLE) AS dn FROM bins)""",
        """woes AS (SELECT *, CASE WHEN de > 0 AND dn > 0 THEN LN(de / dn) ELSE 0 END AS w,
                  CASE WHEN de > 0 AND dn > 0 THEN (de - dn) * LN(de / dn) ELSE 0 END AS c FROM dist)""",
        f"""ivs AS (SELECT "column" AS feature, {rnd('SUM(c)')} AS iv FROM woes GROUP BY "column")""",
    )


WOE = woe_ctes(IV_COLUMNS)
STRENGTH = """CASE WHEN iv > 0.5 THEN 'Suspicious' WHEN iv > 0.3 THEN 'Strong' WHEN iv > 0.1 THEN 'Medium'
     WHEN iv > 0.02 THEN 'Weak' ELSE 'Useless' END AS strength"""
put("woe_table", f'SELECT "column", CAST(bin AS BIGINT) AS bin, events, non_events, {rnd("w")} AS woe, {rnd("c")} AS iv_contrib FROM woes', *WOE)
put("iv_numeric", "SELECT feature, iv FROM ivs", *WOE)
put("iv_ranking", f"SELECT feature, iv, {STRENGTH} FROM ivs", *WOE)
_places = ", ".join(f"({k}, '{c}')" for k, c in enumerate(CORR_COLUMNS, start=1))
put(
    "fs_corr_prune",
    """SELECT p.c AS feature, CASE WHEN gone THEN CAST(0.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS score, NOT gone AS selected
    FROM (SELECT p.*, list_contains(taken, i) OR reach IS NOT NULL AS gone FROM reached p, (SELECT taken FROM walk ORDER BY pos DESC LIMIT 1)) p""",
    *woe_ctes(CORR_COLUMNS),
    f"places AS (SELECT * FROM (VALUES {_places}) t(i, c))",
    "ranked AS (SELECT i, c, iv FROM places JOIN ivs ON feature = c)",
    "pairs AS (" + union([
        f"SELECT {i} AS i, {j} AS j, {corr(a, b)} AS r FROM risk_signal"
        for i, a in enumerate(CORR_COLUMNS, start=1) for j, b in enumerate(CORR_COLUMNS, start=1) if i < j]) + ")",
    "linked AS (SELECT p.i, p.j, b.iv > a.iv AS loses FROM pairs p JOIN ranked a ON a.i = p.i JOIN ranked b ON b.i = p.j WHERE ABS(r) > 0.95)",
    "reached AS (SELECT q.i, q.c, MIN(j) FILTER (WHERE loses) AS reach FROM ranked q LEFT JOIN linked l ON l.i = q.i GROUP BY q.i, q.c)",
    """claims AS (SELECT q.i, COALESCE(LIST(l.j) FILTER (WHERE l.j < COALESCE(q.reach, 1000000)), []) AS js
        FROM reached q LEFT JOIN linked l ON l.i = q.i GROUP BY q.i)""",
    """walk AS (SELECT 0 AS pos, CAST([] AS INTEGER[]) AS taken UNION ALL
        SELECT pos + 1, CASE WHEN list_contains(taken, pos + 1) THEN taken ELSE list_concat(taken, js) END
        FROM walk JOIN claims ON claims.i = pos + 1)""",
)
put("leakage_flags", "SELECT feature, iv FROM ivs WHERE iv > 0.8", *WOE)
QUALITY_COLUMNS = ["record_id", "flagged", "li_qty_sum", "ord_const", "ord_price_gappy", "cust_acctbal", "drv_high_card"]
put("quality_score", """
SELECT *, CASE WHEN score >= 85 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 55 THEN 'C'
               WHEN score >= 40 THEN 'D' ELSE 'F' END AS grade
FROM (SELECT *, CAST(GREATEST(0, ROUND_EVEN(100 - LEAST(30, 2 * n_high_missing) - LEAST(10, 0.5 * overall_missing_pct)
             - LEAST(10, 2 * duplicate_pct) - LEAST(10, 5 * n_leakage) - LEAST(10, n_constant), 0)) AS BIGINT) AS score FROM facts)""",
    "qmissing AS (SELECT *, missing_count * 100.0 / n AS missing_pct FROM (" + union([
        f"SELECT COUNT(*) AS n, COUNT(*) - COUNT({c}) AS missing_count FROM risk_signal" for c in QUALITY_COLUMNS]) + "))",
    "qsummary AS (" + missing_summary("qmissing") + ")",
    "qcopies AS (SELECT COUNT(*) AS n FROM risk_signal GROUP BY " + ", ".join(QUALITY_COLUMNS) + ")",
    *woe_ctes(["li_qty_sum", "ord_price_gappy", "cust_acctbal"]),
    "facts AS (SELECT CAST(n_high AS DOUBLE) AS n_high_missing, overall_missing_pct, "
    + "(SELECT COALESCE(SUM(n) FILTER (WHERE n > 1), 0) * 100.0 / SUM(n) FROM qcopies) AS duplicate_pct, "
    + "CAST((SELECT COUNT(*) FROM ivs WHERE iv > 0.8) AS DOUBLE) AS n_leakage, CAST((SELECT "
    + " + ".join(f"CASE WHEN COUNT(DISTINCT {c}) <= 1 THEN 1 ELSE 0 END" for c in QUALITY_COLUMNS if c != "flagged")
    + " FROM risk_signal) AS DOUBLE) AS n_constant FROM qsummary)")
put("split_stats", f"""
SELECT split, n, positives, n - positives AS negatives, {rnd("n * 100.0 / SUM(n) OVER ()", 4)} AS pct,
       {rnd("MAX(CASE WHEN split = 'Train' THEN (n - positives) / CAST(GREATEST(positives, 1) AS DOUBLE) END) OVER ()")} AS train_imbalance,
       CAST(SUM(positives) OVER () // 5 AS BIGINT) AS positives_per_fold,
       CAST(SUM(n - positives) OVER () // 5 AS BIGINT) AS negatives_per_fold
FROM (SELECT sample_group AS split, COUNT(*) AS n, CAST(SUM(flagged) AS BIGINT) AS positives FROM risk_signal GROUP BY sample_group)""")
_number = ", ".join(f"'{n}'" for n, t in GUARDED if t != "string")
# fixed values: the advice for each class of column
_advice = """
WHEN col_type = 'target' THEN 'Use as label — do not include as feature'
WHEN col_type = 'constant' THEN 'Drop — zero variance, no predictive value'
WHEN col_type = 'identifier' THEN 'Drop — uniqueness ≥ 95%, likely ID/key column'
WHEN col_type = 'boolean' THEN 'Encode as 0/1 integer — no other transform needed'
WHEN col_type = 'datetime' THEN 'Extract year/month/day/weekday features or compute age'
WHEN col_type = 'numeric' THEN 'Impute median, winsorise IQR 3×, StandardScaler for LR'"""
CLASSIFY = (
    MISSING,
    DISTINCT,
    "types AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{t}')" for n, t in GUARDED) + ') t("column", data_type))',
    f"""kinds AS (SELECT "column", data_type, n_unique, {rnd('n_unique / CAST(n AS DOUBLE)', 4)} AS uniqueness_ratio, missing_pct,
        CASE WHEN "column" = 'funded' THEN 'target' WHEN n_unique <= 1 THEN 'constant'
             WHEN n_unique / CAST(n AS DOUBLE) > 0.95 THEN 'identifier' WHEN n_unique = 2 THEN 'boolean'
             WHEN regexp_matches("column", '(?i)(date|dt|time|timestamp|created|updated|modified|birth|inception|maturity)') THEN 'datetime'
             WHEN "column" IN ({_number}) AND n_unique > 20 THEN 'numeric' ELSE 'categorical' END AS col_type
        FROM missing JOIN cards USING ("column") JOIN types USING ("column"))""",
)
put("schema_classify", f"""
SELECT "column", col_type, data_type, n_unique, uniqueness_ratio, missing_pct,
       CASE {_advice} WHEN n_unique <= 10 THEN 'OHE (≤10 unique)' WHEN n_unique <= 50 THEN 'Ordinal Encode (≤50 unique)'
            ELSE 'WoE / Target Encode (>50 unique)' END AS suggestion FROM kinds""", *CLASSIFY)
put("schema_summary", "SELECT COUNT(*) AS total_columns, " + ", ".join(
    f"COUNT(*) FILTER (WHERE col_type = '{k}') AS \"{k}\"" for k in
    ("numeric", "categorical", "boolean", "datetime", "identifier", "constant", "target"))
    + ", COUNT(*) FILTER (WHERE col_type NOT IN ('target', 'constant', 'identifier', 'datetime')) AS feature_columns FROM kinds",
    *CLASSIFY)
put("fs_variance", union([
    f"SELECT '{c}' AS feature, CASE WHEN VAR_POP(COALESCE({c}, 0)) < 1000 THEN {rnd(f'VAR_POP(COALESCE({c}, 0))')} "
    f"ELSE FLOOR(VAR_POP(COALESCE({c}, 0)) + 0.5) END AS score, VAR_POP(COALESCE({c}, 0)) > 0.01 AS selected FROM risk_raw"
    for c in PREDICTORS]))
MOMENTS = "moments AS (" + union([
    f"""SELECT '{c}' AS feature, COUNT(*) AS n, SUM(flagged) AS n1, SUM(1 - flagged) AS n0,
        AVG(COALESCE({c}, 0)) AS m, AVG(COALESCE({c}, 0)) FILTER (WHERE flagged = 1) AS m1,
        AVG(COALESCE({c}, 0)) FILTER (WHERE flagged = 0) AS m0,
        VAR_POP(COALESCE({c}, 0)) FILTER (WHERE flagged = 1) AS v1, VAR_POP(COALESCE({c}, 0)) FILTER (WHERE flagged = 0) AS v0,
        CORR(COALESCE({c}, 0), flagged) AS r FROM risk_signal""" for c in PREDICTORS]) + ")"
put("fs_anova_f", f"""
SELECT feature, {rnd("(n1 * POWER(m1 - m, 2) + n0 * POWER(m0 - m, 2)) / ((n1 * v1 + n0 * v0) / (n - 2))", 4)} AS score FROM moments""", MOMENTS)
# psi by its recurrence up to 8 more, then the asymptotic series
def psi(n: str) -> str:
    x = f"(CAST({n} AS DOUBLE) + 8)"
    series = f"LN({x}) - 0.5 / {x} - 1 / (12 * {x} * {x}) + 1 / (120 * POWER({x}, 4)) - 1 / (252 * POWER({x}, 6))"
    return f"({series} - " + " - ".join(f"1.0 / (CAST({n} AS DOUBLE) + {j})" for j in range(8)) + ")"


put(
    "fs_mutual_info_knn",
    f"""SELECT feature, {rnd("GREATEST(0, " + psi("n_all") + " + m)")} AS mi
    FROM (SELECT feature, SUM(n) AS n_all, SUM(n * ({psi("k")} - {psi("size")} - {psi("inside")})) / SUM(n) AS m FROM counted GROUP BY feature)""",
    "cells AS (" + union([f"SELECT '{c}' AS feature, flagged AS y, COALESCE(CAST({c} AS DOUBLE), 0) AS v FROM risk_signal WHERE sample_group = 'Train'" for c in PREDICTORS]) + ")",
    "sized AS (SELECT *, COUNT(*) OVER (PARTITION BY feature, y) AS size FROM cells)",
    """around AS (SELECT DISTINCT feature, y, v, size, LEAST(5, size - 1) AS k, near FROM (
        SELECT feature, y, v, size, COUNT(*) OVER (PARTITION BY feature, y, v) AS n, ROW_NUMBER() OVER (PARTITION BY feature, y, v ORDER BY v) AS copy,
               LIST(v) OVER (PARTITION BY feature, y ORDER BY v ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near FROM sized)
        WHERE copy = 1 OR copy = n)""",
    # the first and the last copy of a value see its neighbours below and above; both see enough copies of itself
    """kth AS (SELECT feature, y, v, size, k, list_sort(list_transform(list_concat(
          list_filter(FIRST(near ORDER BY len(list_filter(near, lambda x: x < v)) DESC), lambda x: x < v),
          list_filter(FIRST(near ORDER BY len(list_filter(near, lambda x: x > v)) DESC), lambda x: x > v)), lambda x: {'d': ABS(x - v), 'x': x})) AS others
        FROM around GROUP BY feature, y, v, size, k)""",
    "copies AS (SELECT feature, y, v, COUNT(*) AS n FROM cells GROUP BY feature, y, v)",
    """ends AS (SELECT kth.*, n, CASE WHEN n - 1 >= k THEN NULL ELSE others[k - n + 1] END AS far FROM kth JOIN copies USING (feature, y, v) WHERE k > 0)""",
    """bounds AS (SELECT feature, y, v, size, k, n, far IS NULL AS here,
          CASE WHEN far IS NULL THEN v WHEN far.x < v THEN far.x ELSE v - far.d END AS low,
          CASE WHEN far IS NULL THEN v WHEN far.x > v THEN far.x ELSE v + far.d END AS high FROM ends)""",
    "rows_at AS (SELECT feature, v, SUM(n) AS n FROM copies GROUP BY feature, v)",
    """counted AS (SELECT b.feature, b.y, b.v, b.size, b.k, b.n, CASE WHEN b.here THEN MAX(o.n) ELSE SUM(r.n) END AS inside
        FROM bounds b JOIN rows_at o ON o.feature = b.feature AND o.v = b.v
        LEFT JOIN rows_at r ON r.feature = b.feature AND r.v > b.low AND r.v < b.high AND NOT b.here
        GROUP BY b.feature, b.y, b.v, b.size, b.k, b.n, b.here)""",
)
put("fs_point_biserial", f"SELECT feature, {rnd('ABS(r)')} AS score, ABS(r) > 0.05 AS selected FROM moments", MOMENTS)
put("fs_mutual_info", f"""
SELECT "column" AS feature, {rnd("SUM(CASE WHEN p > 0 THEN p * LN(p / (pb * py)) ELSE 0 END)")} AS mi
FROM (SELECT "column", bin, y, cnt / CAST(SUM(cnt) OVER (PARTITION BY "column") AS DOUBLE) AS p,
             SUM(cnt) OVER (PARTITION BY "column", bin) / CAST(SUM(cnt) OVER (PARTITION BY "column") AS DOUBLE) AS pb,
             SUM(cnt) OVER (PARTITION BY "column", y) / CAST(SUM(cnt) OVER (PARTITION BY "column") AS DOUBLE) AS py
      FROM (SELECT "column", bin, flagged AS y, COUNT(*) AS cnt FROM binned GROUP BY "column", bin, flagged))
GROUP BY "column" """, *WOE[:1])
put("fs_chi_square", f"""
SELECT "column" AS feature, {rnd("SUM(POWER(o - e, 2) / e)", 4)} AS chi2, COUNT(DISTINCT value) - 1 AS dof
FROM (SELECT g."column", g.value, COALESCE(c.cnt, 0) AS o, g.rt * y.yt / CAST(t.n AS DOUBLE) AS e
      FROM (SELECT "column", value, COUNT(*) AS rt FROM cells GROUP BY ALL) g
      JOIN (SELECT "column", flagged, COUNT(*) AS yt FROM cells GROUP BY ALL) y ON g."column" = y."column"
      JOIN (SELECT "column", COUNT(*) AS n FROM cells GROUP BY ALL) t ON g."column" = t."column"
      LEFT JOIN (SELECT "column", value, flagged, COUNT(*) AS cnt FROM cells GROUP BY ALL) c
        ON c."column" = g."column" AND c.value = g.value AND c.flagged = y.flagged)
GROUP BY "column" """,
    "cells AS (SELECT * FROM (" + long("risk_signal", CATEGORICAL, "record_id, flagged", "VARCHAR") + ") WHERE value IS NOT NULL)")
put("class_counts", f"""
SELECT n_pos, n_neg, {rnd("n_neg / CAST(GREATEST(n_pos, 1) AS DOUBLE)")} AS imbalance_ratio,
       GREATEST(1, n_neg // GREATEST(n_pos, 1)) AS scale_pos_weight
FROM (SELECT CAST(SUM(flagged) AS BIGINT) AS n_pos, CAST(SUM(1 - flagged) AS BIGINT) AS n_neg FROM risk_signal)""")
put("histogram", f"""
SELECT g."column", CAST(g.bin AS BIGINT) AS bin, {rnd("lo + (hi - lo) * g.bin / 30")} AS lower,
       {rnd("lo + (hi - lo) * (g.bin + 1) / 30")} AS upper, COALESCE(c.cnt, 0) AS count
FROM (SELECT ends.*, bin FROM ends, range(30) r(bin)) g
LEFT JOIN (SELECT "column", LEAST(29, CAST(FLOOR((value - lo) / (hi - lo) * 30) AS BIGINT)) AS bin, COUNT(*) AS cnt
           FROM long JOIN ends USING ("column") WHERE value IS NOT NULL GROUP BY 1, 2) c
  ON g."column" = c."column" AND g.bin = c.bin""",
    "long AS (" + long("risk_raw", NUMERIC) + ")",
    'ends AS (SELECT "column", MIN(value) AS lo, MAX(value) AS hi FROM long GROUP BY "column")')
put("boxplot_stats", f"""
SELECT "column", {rnd("q1")} AS q1, {rnd("med")} AS median, {rnd("q3")} AS q3,
       {rnd("LEAST(MIN(CASE WHEN value >= lo THEN value END), q1)")} AS whisker_low,
       {rnd("GREATEST(MAX(CASE WHEN value <= hi THEN value END), q3)")} AS whisker_high,
       COUNT(*) FILTER (WHERE value < lo OR value > hi) AS n_outliers
FROM long JOIN (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT "column", QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS med, QUANTILE_CONT(value, 0.75) AS q3
    FROM long GROUP BY "column")) USING ("column")
GROUP BY "column", q1, med, q3""", "long AS (" + long("risk_raw", NUMERIC) + ")")
put("psi", f"""
SELECT "column" AS feature, {rnd("SUM((q - p) * LN(q / p))")} AS psi FROM (
  SELECT "column", bin, (a + 0.5) / (SUM(a) OVER w + 0.5 * COUNT(*) OVER w) AS p,
         (b + 0.5) / (SUM(b) OVER w + 0.5 * COUNT(*) OVER w) AS q
  FROM (SELECT "column", bin, COUNT(*) FILTER (WHERE sample_group = 'Train') AS a, COUNT(*) FILTER (WHERE sample_group = 'OOT') AS b
        FROM placed GROUP BY "column", bin) WINDOW w AS (PARTITION BY "column"))
GROUP BY "column" """,
    "long AS (SELECT * FROM (" + long("risk_raw", NUMERIC, "record_id, sample_group") + ") WHERE value IS NOT NULL)",
    """tiles AS (SELECT *, NTILE(10) OVER w AS bin, LEAD(value) OVER w AS following FROM long WHERE sample_group = 'Train'
       WINDOW w AS (PARTITION BY "column" ORDER BY value, record_id))""",
    # last (value, id) of each of the first nine tiles; a value that ends with its tile belongs to it whatever the id
    """cuts AS (SELECT "column", bin, MAX({'v': value, 'i': CASE WHEN following = value THEN record_id ELSE 9223372036854775807 END}) AS top
       FROM tiles WHERE bin < 10 GROUP BY "column", bin)""",
    """placed AS (SELECT l."column", l.sample_group, 1 + COUNT(c.bin) AS bin
       FROM long l LEFT JOIN cuts c ON c."column" = l."column" AND {'v': l.value, 'i': l.record_id} > c.top
       WHERE l.sample_group IN ('Train', 'OOT') GROUP BY l."column", l.sample_group, l.record_id)""")

# -- windows, rankings, sets ------------------------------------------------

for _name, _col in (("ntile_bins", "ord_price_gappy"), ("ntile_bins_ties", "li_cnt")):
    put(_name, f"""
SELECT record_id, CAST(NTILE(10) OVER (ORDER BY {_col}, record_id) AS BIGINT) AS bin FROM risk_raw WHERE {_col} IS NOT NULL""")


def curve(by: str = "") -> tuple[str, ...]:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return (
        f"""hist AS (SELECT {keys}score, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
            CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n_neg FROM src GROUP BY {keys}score)""",
        f"""curve AS (SELECT *, CAST(SUM(n_pos) OVER w AS BIGINT) AS cum_pos, CAST(SUM(n_neg) OVER w AS BIGINT) AS cum_neg,
            CAST(SUM(n_pos) OVER ({part}) AS DOUBLE) AS tot_pos, CAST(SUM(n_neg) OVER ({part}) AS DOUBLE) AS tot_neg
            FROM hist WINDOW w AS ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""",
    )


SRC = "src AS (SELECT * FROM scored)"
AUC = "SUM(CAST(n_neg AS DOUBLE) * (cum_pos - n_pos + CAST(0.5 AS DOUBLE) * n_pos)) / (SUM(CAST(n_pos AS DOUBLE)) * SUM(CAST(n_neg AS DOUBLE)))"
AP = "SUM(n_pos * (CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))) / SUM(n_pos)"
put("cum_gains", "SELECT score, n_pos, n_neg, cum_pos, cum_neg FROM curve", SRC, *curve())
put("roc_auc", f"SELECT {rnd(AUC)} AS roc_auc FROM curve", SRC, *curve())
put("pr_auc", f"SELECT {rnd(AP)} AS pr_auc FROM curve", SRC, *curve())
CONFUSION = """cells AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS fp,
  COUNT(*) FILTER (WHERE label <> 1 AND score < 0.5) AS tn, COUNT(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn FROM scored)"""
put("confusion", "SELECT tp, fp, tn, fn FROM cells", CONFUSION)


def at_threshold(dp: int) -> str:
    return (
        f"{rnd('COALESCE(tp / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 0)', dp)} AS precision, "
        f"{rnd('COALESCE(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0)', dp)} AS recall, "
        f"{rnd('COALESCE(2 * tp / CAST(NULLIF(2 * tp + fp + fn, 0) AS DOUBLE), 0)', dp)} AS f1, "
        f"{rnd('tn / CAST(GREATEST(tn + fp, 1) AS DOUBLE)', dp)} AS specificity"
    )


put("threshold_metrics", f"SELECT {at_threshold(6)} FROM cells", CONFUSION)
put("ks_stat", f"""
SELECT {rnd("gap")} AS ks, score AS ks_score FROM (
  SELECT score, FLOOR(ABS(cum_pos / tot_pos - cum_neg / tot_neg) * 1e9 + 0.5) / 1e9 AS gap FROM curve)
ORDER BY gap DESC, score DESC LIMIT 1""", SRC, *curve())
put("roc_points", f"""
SELECT sample_group, score AS threshold, {rnd("cum_neg / tot_neg")} AS fpr, {rnd("cum_pos / tot_pos")} AS tpr FROM curve""",
    SRC, *curve("sample_group"))
put("gain_lift", f"""
SELECT score, {rnd("(cum_pos + cum_neg) / (tot_pos + tot_neg)")} AS pct_population, {rnd("cum_pos / tot_pos")} AS cum_gain,
       {rnd("(cum_pos / tot_pos) / ((cum_pos + cum_neg) / (tot_pos + tot_neg))")} AS lift FROM curve""", SRC, *curve())
put("cv_summary", f"""
SELECT sample_group, {rnd("AVG(a)", 4)} AS cv_mean, {rnd("STDDEV_POP(a)", 4)} AS cv_std
FROM (SELECT sample_group, fold, {rnd(AUC)} AS a FROM curve GROUP BY sample_group, fold) GROUP BY sample_group""",
    "src AS (SELECT *, record_id % 3 AS fold FROM scored)", *curve("sample_group, fold"))
put("metrics_by_split", f"""
SELECT sample_group, roc_auc, pr_auc, ks, {at_threshold(4)}, n FROM (
  SELECT sample_group, {rnd(AUC, 4)} AS roc_auc, {rnd(AP, 4)} AS pr_auc, {rnd("MAX(ABS(cum_pos / tot_pos - cum_neg / tot_neg))", 4)} AS ks,
         COALESCE(SUM(n_pos) FILTER (WHERE score >= 0.5), 0) AS tp, COALESCE(SUM(n_neg) FILTER (WHERE score >= 0.5), 0) AS fp,
         COALESCE(SUM(n_neg) FILTER (WHERE score < 0.5), 0) AS tn, COALESCE(SUM(n_pos) FILTER (WHERE score < 0.5), 0) AS fn,
         CAST(SUM(n_pos + n_neg) AS BIGINT) AS n FROM curve GROUP BY sample_group)""", SRC, *curve("sample_group"))
put("calibration_bins", f"""
SELECT CAST(GREATEST(0, LEAST(9, FLOOR(score * 10))) AS BIGINT) AS bin, COUNT(*) AS n, {rnd("AVG(score)")} AS mean_predicted,
       {rnd("AVG(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END)")} AS fraction_positive FROM scored GROUP BY 1""")
put("prob_metrics", f"""
SELECT {rnd("brier")} AS brier, {rnd("log_loss")} AS log_loss,
       {rnd("(tp * tn - fp * fn) / (SQRT(tp + fp) * SQRT(tp + fn) * SQRT(tn + fp) * SQRT(tn + fn))")} AS mcc
FROM (SELECT AVG(POWER(score - label, 2)) AS brier,
             -AVG(CASE WHEN label = 1 THEN LN(p) ELSE LN(1 - p) END) AS log_loss
      FROM (SELECT *, GREATEST(1e-15, LEAST(1 - 1e-15, score)) AS p FROM scored)),
     (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn FROM cells)""", CONFUSION)

RANKED = "ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY oot_roc_auc DESC, n_features, experiment_id) AS rank FROM fake_runs)"
put("leaderboard", "SELECT experiment_id, n_features, oot_roc_auc, rank FROM ranked", RANKED)
put("top3_per_dim", union([
    f"""SELECT '{d}' AS dimension, {d} AS value, position, experiment_id, rank
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {d} ORDER BY rank) AS position FROM ranked) WHERE position <= 3"""
    for d in ("feature_set", "model_family")]), RANKED)
put("best_per_family", """
SELECT model_family, experiment_id, oot_roc_auc, rank FROM ranked
QUALIFY ROW_NUMBER() OVER (PARTITION BY model_family ORDER BY rank) = 1 ORDER BY rank LIMIT 8""", RANKED)
put("best_experiment", """
SELECT experiment_id, oot_roc_auc, rank, CASE WHEN oot_roc_auc > 0.65 THEN 'Ready' ELSE 'Review' END AS deployment
FROM ranked WHERE rank = 1""", RANKED)
put("best_per_dim", union([
    f"SELECT '{d}' AS dimension, {d} AS value, MAX(oot_roc_auc) AS best FROM fake_runs GROUP BY {d}"
    for d in ("feature_set", "model_family")]))

NORM = """norm AS (SELECT *, CASE WHEN MAX(score) OVER w - MIN(score) OVER w < 1e-12 THEN CAST(0.5 AS DOUBLE)
  ELSE (score - MIN(score) OVER w) / (MAX(score) OVER w - MIN(score) OVER w) END AS norm FROM fake_scores WINDOW w AS (PARTITION BY method))"""
CONSENSUS = (NORM, """agreed AS (SELECT feature, AVG(norm) AS consensus, COUNT(*) FILTER (WHERE norm >= 0.5) AS votes,
  COUNT(*) AS n_methods, COALESCE(AVG(norm) FILTER (WHERE grp = 'Filter'), 0) AS filter_score,
  COALESCE(AVG(norm) FILTER (WHERE grp = 'Logistic Regression'), 0) AS lr_score,
  COALESCE(AVG(norm) FILTER (WHERE grp = 'Tree-Based'), 0) AS tree_score FROM norm GROUP BY feature)""")
SHOWN = ", ".join(f"{rnd(c)} AS {c}" for c in ("consensus", "filter_score", "lr_score", "tree_score"))
TREE = f"tree AS (SELECT feature FROM agreed ORDER BY tree_score DESC, feature LIMIT {TOP})"
LR = f"lr AS (SELECT feature FROM agreed ORDER BY lr_score DESC, feature LIMIT {TOP})"
put("fs_normalise", f"SELECT method, feature, grp, {rnd('score')} AS score, {rnd('norm')} AS norm FROM norm", NORM)
put("avg_rank", """
SELECT method, feature, grp, score, RANK() OVER (PARTITION BY method ORDER BY score DESC)
       + (COUNT(*) OVER (PARTITION BY method, score) - 1) / CAST(2 AS DOUBLE) AS avg_rank FROM fake_scores""")
put("fs_method_summary", f"""
SELECT method, grp, COUNT(*) FILTER (WHERE score > mu) AS n_selected, FIRST(feature ORDER BY score DESC, feature) AS top_feature,
       {rnd("MAX(score)")} AS top_score, {rnd("AVG(score)")} AS mean_score, COUNT(*) FILTER (WHERE score > 1e-9) AS n_nonzero
FROM (SELECT *, AVG(score) OVER (PARTITION BY method) AS mu FROM fake_scores) GROUP BY method, grp""")
put("fs_consensus", f"SELECT feature, votes, n_methods, {SHOWN} FROM agreed", *CONSENSUS)
put("topn_features", f"SELECT feature, {rnd('consensus')} AS consensus FROM agreed ORDER BY agreed.consensus DESC, feature LIMIT {TOP}", *CONSENSUS)
put("fs_both", "SELECT feature FROM tree INTERSECT SELECT feature FROM lr", *CONSENSUS, TREE, LR)
put("fs_tree_only", "SELECT feature FROM tree EXCEPT SELECT feature FROM lr", *CONSENSUS, TREE, LR)
put("fs_lr_only", "SELECT feature FROM lr EXCEPT SELECT feature FROM tree", *CONSENSUS, TREE, LR)
put("fs_vote_consensus", """
SELECT feature, COUNT(*) AS votes FROM norm WHERE norm >= 0.5 GROUP BY feature HAVING COUNT(*) >= 2
ORDER BY votes DESC, feature LIMIT 25""", NORM)
put("fs_agreement", f"""
SELECT ROW_NUMBER() OVER (ORDER BY agreed.consensus DESC, feature) AS rank, feature, votes, n_methods, {SHOWN},
       CASE WHEN feature IN (SELECT feature FROM tree) AND feature IN (SELECT feature FROM lr) THEN 'Both'
            WHEN feature IN (SELECT feature FROM tree) THEN 'Tree' WHEN feature IN (SELECT feature FROM lr) THEN 'LR'
            ELSE '-' END AS agreement FROM agreed""", *CONSENSUS, TREE, LR)
put("fs_quadrant", f"""
SELECT feature, {rnd("t")} AS tree_norm, {rnd("l")} AS lr_norm, {rnd("(t + l) / CAST(2 AS DOUBLE)")} AS mean_norm,
       CASE WHEN t > 0.5 AND l > 0.5 THEN 'Consensus' WHEN t > 0.5 THEN 'Tree-dominant' WHEN l > 0.5 THEN 'LR-dominant'
            ELSE 'Neutral' END AS quadrant
FROM (SELECT feature, (tree_score - MIN(tree_score) OVER ()) / (MAX(tree_score) OVER () - MIN(tree_score) OVER ()) AS t,
             (lr_score - MIN(lr_score) OVER ()) / (MAX(lr_score) OVER () - MIN(lr_score) OVER ()) AS l FROM agreed)""", *CONSENSUS)
put("fs_stability", "SELECT feature, " + ", ".join(
    f"MAX(CASE WHEN method = '{m}' AND norm >= 0.5 THEN 1 ELSE 0 END) AS \"{m}\"" for m in GROUP_METHODS)
    + " FROM norm GROUP BY feature", NORM)
assert not set(METHOD_THRESHOLDS) & set(GROUP_METHODS)

# -- scalar functions and transforms ----------------------------------------

put("scalar_transforms", f"""
SELECT record_id, {rnd("CASE WHEN cust_acctbal > -1 THEN LN(1 + cust_acctbal) END")} AS log1p_bal,
       {rnd("CASE WHEN ord_price_gappy IS NOT NULL THEN GREATEST(50000.0, LEAST(400000.0, ord_price_gappy)) END")} AS clipped,
       {rnd("COALESCE(ord_price_gappy, 0.0)")} AS filled, CASE WHEN ord_price_gappy IS NULL THEN 1 ELSE 0 END AS is_missing,
       {rnd("ABS(cust_acctbal)")} AS abs_bal, {rnd("LN(ord_price_gappy / (ABS(cust_acctbal) + 1.0))")} AS log_ratio,
       {rnd("GREATEST(0.0, cust_acctbal)")} AS at_least_zero, 'abc' AS lowered,
       CASE WHEN ord_price_gappy IS NOT NULL THEN FALSE END AS has_exponent
FROM risk_raw""")
put("fe_missing_indicator", """
SELECT record_id, li_cnt, ord_price_gappy, drv_high_card, CAST(ord_price_gappy IS NULL AS TINYINT) AS ord_price_gappy_is_missing,
       CAST(drv_high_card IS NULL AS TINYINT) AS drv_high_card_is_missing FROM risk_raw""")
put("fe_impute_median", """
SELECT record_id, COALESCE(li_qty_sum, (SELECT QUANTILE_CONT(li_qty_sum, 0.5) FROM risk_raw)) AS li_qty_sum,
       COALESCE(ord_price_gappy, (SELECT QUANTILE_CONT(ord_price_gappy, 0.5) FROM risk_raw)) AS ord_price_gappy FROM risk_raw""")


def mode_of(c: str, source: str) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"


put("fe_impute_mode", f"""
SELECT record_id, COALESCE(drv_high_card, {mode_of('drv_high_card', 'risk_raw')}) AS drv_high_card,
       COALESCE(cust_segment, {mode_of('cust_segment', 'risk_raw')}) AS cust_segment FROM risk_raw""")


def fences(c: str, source: str) -> str:
    return (
        f"SELECT QUANTILE_CONT({c}, 0.25) - 3.0 * (QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25)) AS lo, "
        f"QUANTILE_CONT({c}, 0.75) + 3.0 * (QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25)) AS hi FROM {source}"
    )


def clipped(c: str, f: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN GREATEST({f}.lo, LEAST({f}.hi, {c})) END"


put("fe_winsorise", f"""
SELECT record_id, {rnd(clipped('drv_outlier', 'a'))} AS drv_outlier, {rnd(clipped('ord_price_gappy', 'b'))} AS ord_price_gappy
FROM risk_raw, ({fences('drv_outlier', 'risk_raw')}) a, ({fences('ord_price_gappy', 'risk_raw')}) b""")
put("fe_log1p", f"""
SELECT record_id, {rnd("LN(1 + drv_skewed)")} AS drv_skewed, {rnd("ord_totalprice")} AS ord_totalprice,
       {rnd("cust_acctbal")} AS cust_acctbal FROM risk_raw""")
put("fe_encoding_plan", """
SELECT "column", n_unique, CASE WHEN n_unique <= 10 THEN 'one_hot' WHEN n_unique <= 50 THEN 'ordinal' ELSE 'woe' END AS encoding
FROM tops""", *TOPS)
put("fe_one_hot", f"SELECT record_id, {DUMMIES} FROM risk_raw")
put("fe_ordinal", """
SELECT record_id, CASE WHEN cust_nation IS NOT NULL THEN DENSE_RANK() OVER (ORDER BY cust_nation NULLS LAST) - 1 END AS cust_nation FROM risk_raw""")


def woe_of(c: str, source: str) -> str:
    return f"""SELECT k, CASE WHEN ev > 0 AND nev > 0 THEN LN((ev / CAST(SUM(ev) OVER () AS DOUBLE)) / (nev / CAST(SUM(nev) OVER () AS DOUBLE)))
  ELSE 0 END AS w FROM (SELECT {c} AS k, SUM(flagged) AS ev, SUM(1 - flagged) AS nev FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"""


put("fe_woe_encode", f"SELECT record_id, flagged, {rnd('w')} AS drv_high_card FROM risk_signal LEFT JOIN maps ON drv_high_card = k",
    f"maps AS ({woe_of('drv_high_card', 'risk_signal')})")
put("fe_rare_merge", """
SELECT record_id, CASE WHEN drv_near_const IN (SELECT drv_near_const FROM risk_raw GROUP BY 1
         HAVING COUNT(*) >= 0.01 * (SELECT COUNT(*) FROM risk_raw)) THEN drv_near_const ELSE 'OTHER' END AS drv_near_const FROM risk_raw""")
SCALED = ["li_qty_sum", "cust_acctbal", "ord_const"]


def scaled(centre: str, width: str) -> str:
    fits = ", ".join(
        f"{centre.format(c=c)} AS m_{c}, CASE WHEN {width.format(c=c)} = 0 THEN 1 ELSE {width.format(c=c)} END AS w_{c}" for c in SCALED
    )
    cols = ", ".join(f"{rnd(f'({c} - m_{c}) / w_{c}')} AS {c}" for c in SCALED)
    return f"SELECT record_id, sample_group, {cols} FROM risk_raw, (SELECT {fits} FROM risk_raw WHERE sample_group = 'Train')"


put("scale_standard", scaled("AVG({c})", "STDDEV_POP({c})"))
put("scale_robust", scaled("QUANTILE_CONT({c}, 0.5)", "(QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25))"))
put("scale_minmax", scaled("MIN({c})", "(MAX({c}) - MIN({c}))"))

FIT = "fit AS (SELECT * FROM risk_signal WHERE sample_group = 'Train')"
_remaining = [*SPEC_NUMERIC, *CATEGORICAL, "li_has_return"]
SPEC = (
    FIT,
    "miss AS (" + union([f"SELECT '{c}' AS col, (COUNT(*) - COUNT({c})) * 100.0 / COUNT(*) AS pct FROM fit" for c in _remaining]) + ")",
    "quart AS (" + union([
        f"""SELECT '{c}' AS col, QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS med, QUANTILE_CONT({c}, 0.75) AS q3,
            MIN({c}) AS lo, (SELECT AVG(POWER({c} - mu, 3)) / POWER(AVG(POWER({c} - mu, 2)), 1.5) FROM fit,
            (SELECT AVG({c}) AS mu FROM fit)) AS sk FROM fit""" for c in SPEC_NUMERIC]) + ")",
    "cats AS (" + union([
        f"SELECT '{c}' AS col, COUNT(DISTINCT {c}) AS n, {mode_of(c, 'fit')} AS mode FROM fit" for c in CATEGORICAL]) + ")",
    "plan AS (SELECT *, CASE WHEN n <= 10 THEN 'one_hot' WHEN n <= 50 THEN 'ordinal' ELSE 'woe' END AS enc FROM cats)",
    "vals AS (" + union([f"SELECT DISTINCT '{c}' AS col, {c} AS v FROM fit WHERE {c} IS NOT NULL" for c in CATEGORICAL]) + ")",
    f"filled AS (SELECT flagged, COALESCE(drv_high_card, {mode_of('drv_high_card', 'fit')}) AS drv_high_card FROM fit)",
    f"maps AS ({woe_of('drv_high_card', 'filled')})",
)


def spec_row(step: str, col: str = "col", key: str = "NULL", num: str = "NULL", txt: str = "NULL", pos: str = "NULL", rest: str = "") -> str:
    return (
        f"SELECT '{step}' AS step, {col} AS \"column\", CAST({key} AS VARCHAR) AS key, {rnd(num)} AS num, "
        f"CAST({txt} AS VARCHAR) AS txt, CAST({pos} AS BIGINT) AS position {rest}"
    )


put("fit_spec", union([
    spec_row("drop_constant", "'ord_const'"),
    spec_row("drop_identifier", "'record_id'"),
    spec_row("missing_indicator", rest="FROM miss WHERE pct > 5"),
    spec_row("impute", key="'median'", num="med", rest="FROM quart"),
    spec_row("winsorise", key="'lower'", num="q1 - 3.0 * (q3 - q1)", rest="FROM quart"),
    spec_row("winsorise", key="'upper'", num="q3 + 3.0 * (q3 - q1)", rest="FROM quart"),
    spec_row("log_transform", rest="FROM quart WHERE lo > 0 AND sk > 2"),
    spec_row("impute", key="'mode'", txt="mode", rest="FROM plan"),
    spec_row("encoding", key="enc", rest="FROM plan"),
    spec_row("level", "vals.col", key="v", pos="ROW_NUMBER() OVER (PARTITION BY vals.col ORDER BY v) - 1",
             rest="FROM vals JOIN plan ON vals.col = plan.col WHERE enc <> 'woe'"),
    spec_row("n_features_out", "NULL", num=f"""{len(SPEC_NUMERIC)} + 1 + (SELECT COUNT(*) FROM quart WHERE lo > 0 AND sk > 2)
        + (SELECT COUNT(*) FROM miss WHERE pct > 5) + (SELECT SUM(CASE WHEN enc = 'one_hot' THEN 5 ELSE 1 END) FROM plan)"""),
    spec_row("woe_map", "'drv_high_card'", key="k", num="w", rest="FROM maps"),
]), *SPEC)


def served(c: str) -> str:
    filled = f"COALESCE(CAST({c} AS DOUBLE), {c}_q.med)"
    bounded = (
        f"GREATEST({c}_q.q1 - 3.0 * ({c}_q.q3 - {c}_q.q1), LEAST({c}_q.q3 + 3.0 * ({c}_q.q3 - {c}_q.q1), {filled}))"
    )
    logged = f"CASE WHEN {c}_q.lo > 0 AND {c}_q.sk > 2 THEN LN(1 + {bounded}) ELSE {bounded} END"
    return f"{rnd(logged)} AS {c}"


_priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
put("serve_features", "SELECT record_id, " + ", ".join(served(c) for c in SPEC_NUMERIC)
    + ", CAST(drv_high_card IS NULL AS TINYINT) AS drv_high_card_is_missing, " + ", ".join(
        f"CAST(CASE WHEN ord_priority = '{p}' THEN 1 ELSE 0 END AS TINYINT) AS \"ord_priority_{p}\"" for p in _priorities)
    + ", (SELECT COUNT(*) FROM vals WHERE col = 'cust_nation' AND v < cust_nation) AS cust_nation, "
    + f"{rnd('w')} AS drv_high_card, flagged FROM risk_signal "
    + " ".join(f"JOIN quart {c}_q ON {c}_q.col = '{c}'" for c in SPEC_NUMERIC)
    + f" LEFT JOIN maps ON COALESCE(drv_high_card, {mode_of('drv_high_card', 'fit')}) = k", *SPEC)

# -- sampling ---------------------------------------------------------------

HASH = "CAST('0x' || SUBSTR(MD5('42:' || CAST(record_id AS VARCHAR)), 1, 15) AS BIGINT)"
put("sample_hash", f"SELECT record_id, ord_totalprice FROM risk_raw ORDER BY {HASH}, record_id LIMIT 1000")
put("undersample_hash", f"""
SELECT record_id, flagged FROM risk_signal
QUALIFY flagged = 1 OR ROW_NUMBER() OVER (PARTITION BY flagged ORDER BY {HASH}, record_id)
        <= 3 * (SELECT SUM(flagged) FROM risk_signal)""")
put("class_weights", f"""
SELECT CAST(flagged AS BIGINT) AS label, COUNT(*) AS n, {rnd("SUM(COUNT(*)) OVER () / (2.0 * COUNT(*))")} AS weight
FROM risk_signal GROUP BY flagged""")
put("kfold_assign", f"""
SELECT record_id, flagged, CAST(NTILE(3) OVER (PARTITION BY flagged ORDER BY {HASH}, record_id) - 1 AS INTEGER) AS fold FROM risk_signal""")
put("stratified_split", f"""
SELECT record_id, flagged, CASE WHEN ROW_NUMBER() OVER (PARTITION BY flagged ORDER BY {HASH}, record_id)
  <= FLOOR(0.7 * COUNT(*) OVER (PARTITION BY flagged) + 0.5) THEN 'train' ELSE 'test' END AS part FROM risk_signal""")

# -- operators over real scores, artifacts and streams -----------------------

ORACLES["scan_csv_quoted"] = """
SELECT 'a "' || c_mktsegment || '", b' AS "first", c_custkey,
       CASE WHEN c_custkey % 2 = 0 THEN 'two' || chr(10) || 'lines ' || CAST(c_custkey AS VARCHAR) ELSE '"' END AS "last"
FROM customer"""
ORACLES["scan_parquet_whole"] = "SELECT o_orderkey, o_totalprice FROM orders"
put("column_fill", union([
    f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS \"column\", '{t}' AS data_type, {str(n != 'funded').lower()} AS is_feature, "
    f"COUNT({n}) AS n_values FROM guarded" for i, (n, t) in enumerate(GUARDED, start=1)]))
put("numeric_feature_fill", union([
    f"SELECT CAST({i} AS BIGINT) AS position, '{n}' AS feature, COUNT({n}) AS n_values FROM risk_raw"
    for i, n in enumerate(("li_cnt", "ord_price_gappy", "drv_skewed"), start=1)]))
# F(1, d) exceeds the square of this t quantile with probability 0.05
_Z = 1.959963984540054
_CRITICAL = f"POWER({_Z} + {(_Z**3 + _Z) / 4} / (n - 2), 2)"
put("_anova_rule", f"""
SELECT feature, {rnd("f", 4)} AS score, f > {_CRITICAL} AS selected
FROM (SELECT feature, n, (n1 * POWER(m1 - m, 2) + n0 * POWER(m0 - m, 2)) / ((n1 * v1 + n0 * v0) / (n - 2)) AS f FROM moments)""", MOMENTS)
_FILTERS = "s AS (" + union([
    f"SELECT 'Variance' AS method, 'Filter' AS grp, feature, score, selected FROM ({ORACLES['fs_variance']})",
    f"SELECT 'IV (WoE)', 'Filter', feature, iv, iv >= 0.02 FROM ({ORACLES['iv_numeric']})",
    f"SELECT 'Mutual Info', 'Filter', feature, mi, mi > 0.01 FROM ({ORACLES['fs_mutual_info']})",
    f"SELECT 'ANOVA F-Test', 'Filter', feature, score, selected FROM ({ORACLES.pop('_anova_rule')})",
    f"SELECT 'Point-Biserial r', 'Filter', feature, score, selected FROM ({ORACLES['fs_point_biserial']})",
]) + ")"
ORACLES["fs_method_rules"] = f"""
WITH {_FILTERS}
SELECT method, grp, COUNT(*) FILTER (WHERE selected) AS n_selected, FIRST(feature ORDER BY score DESC, feature) AS top_feature,
       {rnd("MAX(score)")} AS top_score, {rnd("AVG(score)")} AS mean_score, COUNT(*) FILTER (WHERE score > 1e-9) AS n_nonzero
FROM s GROUP BY method, grp"""
ORACLES["fs_consensus_filters"] = f"""
WITH {_FILTERS}, norm AS (
  SELECT *, CASE WHEN MAX(score) OVER w - MIN(score) OVER w < 1e-12 THEN CAST(0.5 AS DOUBLE)
         ELSE (score - MIN(score) OVER w) / (MAX(score) OVER w - MIN(score) OVER w) END AS norm FROM s WINDOW w AS (PARTITION BY method))
SELECT feature, {rnd("AVG(norm)", 5)} AS consensus, COUNT(*) FILTER (WHERE norm >= 0.5) AS votes, COUNT(*) AS n_methods,
       {rnd("AVG(norm)", 5)} AS filter_score, CAST(0 AS DOUBLE) AS lr_score, CAST(0 AS DOUBLE) AS tree_score
FROM norm GROUP BY feature"""
ORACLES["spec_round_trip"] = ORACLES["stream_replay"] = ORACLES["serve_features"]


def filled(value: str) -> str:
    return "SELECT record_id, " + ", ".join(
        f"{rnd(f'COALESCE({c}, {value.format(c=c)})')} AS {c}" for c in ("li_qty_sum", "ord_price_gappy")) + " FROM risk_raw"


put("fe_impute_mean", filled("(SELECT AVG({c}) FROM risk_raw)"))
put("fe_impute_constant", filled("-1.0"))
put("fe_winsorise_zscore", "SELECT record_id, " + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN {rnd(f'GREATEST(b.{c}_m - 1.5 * b.{c}_s, LEAST(b.{c}_m + 1.5 * b.{c}_s, {c}))')} END AS {c}"
    for c in ("li_qty_sum", "ord_price_gappy")) + " FROM risk_raw CROSS JOIN (SELECT " + ", ".join(
    f"AVG({c}) AS {c}_m, STDDEV_POP({c}) AS {c}_s" for c in ("li_qty_sum", "ord_price_gappy")) + " FROM risk_raw) b")

_columns = ("value", "user_id")
# five-day windows begin at whole multiples of five days since 1970
ORACLES["psi_stream"] = f"""
WITH cells AS ({union([f"SELECT ts, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM events WHERE ts IS NOT NULL" for c in _columns])}),
base AS (SELECT feature, v FROM cells WHERE ts < TIMESTAMP '2024-01-06 00:00:00'),
ranked AS (SELECT feature, v, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY v) AS r, COUNT(*) OVER (PARTITION BY feature) AS n FROM base WHERE v IS NOT NULL),
cuts AS (SELECT DISTINCT feature, v AS cut FROM ranked, range(1, 10) g(k) WHERE r = CAST(CEIL(k * n / 10.0) AS BIGINT)),
lists AS (SELECT feature, LIST(cut) AS cuts FROM cuts GROUP BY feature),
binned AS (SELECT ts, feature, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(cuts, lambda c: c < v)) END AS bin FROM cells JOIN lists USING (feature)),
grid AS (SELECT feature, UNNEST(range(0, len(cuts) + 1)) AS bin FROM lists
         UNION SELECT feature, bin FROM binned WHERE ts < TIMESTAMP '2024-01-06 00:00:00'),
known AS (SELECT g.feature, g.bin, COUNT(b.ts) AS n_base FROM grid g LEFT JOIN binned b
          ON b.feature = g.feature AND b.bin = g.bin AND b.ts < TIMESTAMP '2024-01-06 00:00:00' GROUP BY g.feature, g.bin),
counts AS (SELECT make_timestamp(CAST(FLOOR(epoch(ts) / 432000) AS BIGINT) * 432000000000) AS window_start, feature, bin, COUNT(*) AS n FROM binned GROUP BY ALL),
both_ AS (SELECT window_start, feature, bin, COALESCE(n_base, 0) AS n_base, COALESCE(n, 0) AS n
          FROM (SELECT * FROM (SELECT DISTINCT window_start, feature FROM counts) JOIN known USING (feature))
          FULL JOIN counts USING (window_start, feature, bin)),
shares AS (SELECT *, (n_base + 0.5) / (SUM(n_base) OVER w + 0.5 * COUNT(*) OVER w) AS p, (n + 0.5) / (SUM(n) OVER w + 0.5 * COUNT(*) OVER w) AS q
           FROM both_ WINDOW w AS (PARTITION BY window_start, feature))
SELECT window_start, feature, CAST(SUM(n) AS BIGINT) AS n, {rnd("SUM((q - p) * LN(q / p))")} AS psi FROM shares GROUP BY window_start, feature"""
