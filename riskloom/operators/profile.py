"""Profiling: counts, missingness, cardinality, moments, quantiles, value tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions import labels
from riskloom.functions.scalar import half_up, quoted, ratio
from riskloom.operators.kernels import (
    approx_distinct,
    exact_quantiles,
    long_values,
    type_families,
    union_all,
    unpivot_typed,
    value_histogram,
    wide_aggregate,
    wide_aggregate_frame,
)
from riskloom.sources.scratch import small_table


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def schema_columns(df: DataFrame, target: str | None = None) -> DataFrame:
    """One row per column: position, name, type, and whether it is a feature (not the target)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.name != target) for i, f in enumerate(df.schema, start=1)]
    return small_table(df.sparkSession, rows, "position int, column string, data_type string, is_feature boolean")


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and the dense float64 size estimate in GiB."""
    n_cols = len(df.columns)
    dense = F.count(F.lit(1)).cast("double") * F.lit(float(n_cols * 8)) / F.lit(float(2**30))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(n_cols).cast("bigint").alias("n_cols"),
        half_up(dense, 6).alias("dense_gb"),
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column and their share of all rows in percent (4 dp)."""
    columns = list(columns or df.columns)
    raw = wide_aggregate_frame(df, columns, lambda c: {"n": F.count(F.lit(1)), "present": F.count(c)})
    missing = F.col("n") - F.col("present")
    pct = F.coalesce(ratio(missing, F.col("n")), F.lit(0.0)) * F.lit(100.0)
    return raw.select("column", missing.alias("missing_count"), half_up(pct, 4).alias("missing_pct"))


def missing_severity(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing table with severity and action, worst first."""
    pct = F.col("missing_pct")
    return (
        missing_counts(df, columns)
        .withColumn("severity", labels.missing_severity(pct))
        .withColumn("action", labels.missing_action(pct))
        .orderBy(F.desc("missing_pct"), "column")
    )


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Counts of columns per missing band, and completeness over all cells."""
    columns = list(columns or df.columns)
    raw = wide_aggregate_frame(df, columns, lambda c: {"n": F.count(F.lit(1)), "present": F.count(c)})
    pct = half_up(F.coalesce(ratio(F.col("n") - F.col("present"), F.col("n")), F.lit(0.0)) * F.lit(100.0), 4)
    banded = raw.withColumn("pct", pct)

    def columns_where(cond):
        return F.count(F.when(cond, True))

    missing = F.sum(F.col("n") - F.col("present"))
    share = F.coalesce(ratio(missing, F.sum("n")), F.lit(0.0))
    p = F.col("pct")
    return banded.agg(
        F.count(F.lit(1)).alias("n_columns"),
        columns_where(p > 30).alias("n_high"),
        columns_where((p > 5) & (p <= 30)).alias("n_medium"),
        columns_where((p > 0) & (p <= 5)).alias("n_low"),
        columns_where(p <= 0).alias("n_complete"),
        missing.alias("total_missing"),
        half_up(share * F.lit(100.0), 6).alias("overall_missing_pct"),
        half_up(F.lit(1.0) - share, 6).alias("completeness"),
    )


def cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Distinct non-null values per column.

    The exact form is one long distinct over (column, value), hash-spread by
    both; the approximate form is a sketch per column, with no row shuffle.
    """
    columns = list(columns or df.columns)
    if not exact:
        raw = wide_aggregate_frame(df, columns, lambda c: {"n_unique": approx_distinct(c)})
        return raw.select("column", "n_unique")
    counts = []
    for kind, cols in type_families(df, columns).items():
        pairs = unpivot_typed(df, cols, kind).where(F.col("value").isNotNull()).distinct()
        counts.append(pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique")))
    names = small_table(df.sparkSession, [(c,) for c in columns], "column string")
    return (
        names.join(union_all(counts), "column", "left")
        .select("column", F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"))
    )


def numeric_stats(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, **options) -> DataFrame:
    """n, missing, mean, population std, min, quartiles, max per numeric column.

    Quartiles are linear-interpolated and exact; ``exact=False`` takes a sketch
    and the whole table becomes one aggregate.
    """
    columns = list(columns or numeric_columns(df))

    def build(c):
        x = c.cast("double")
        out = {
            "n": F.count(x),
            "n_missing": F.count(F.lit(1)) - F.count(x),
            "mean": half_up(F.avg(x), 6),
            "std": half_up(F.stddev_pop(x), 6),
            "min": F.min(x),
            "max": F.max(x),
        }
        if not exact:
            out["q"] = F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000)
        return out

    order = ["column", "n", "n_missing", "mean", "std", "min", "q1", "median", "q3", "max"]
    if not exact:
        raw = wide_aggregate_frame(df, columns, build)
        picked = [half_up(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q1", "median", "q3"))]
        return raw.select("*", *picked).select(*order)
    stats = wide_aggregate(df, columns, build)
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75), {c: stats[c]["n"] for c in columns}, **options)
    rows = []
    for c in columns:
        s, (q1, med, q3) = stats[c], (_round6(x) for x in quartiles[c])
        rows.append((c, s["n"], s["n_missing"], s["mean"], s["std"], s["min"], q1, med, q3, s["max"]))
    schema = "column string, n bigint, n_missing bigint, mean double, std double, min double, " \
             "q1 double, median double, q3 double, max double"
    return small_table(df.sparkSession, rows, schema)


def _round6(x: float | None) -> float | None:
    if x is None or not math.isfinite(x) or abs(x) >= 1e12:
        return x
    return math.floor(x * 1e6 + 0.5) / 1e6


def value_counts(df: DataFrame, column: str, top_n: int | None = None, n_rows: int | None = None) -> DataFrame:
    """Rows per value (NULL is a value), share of all rows in percent, most frequent first."""
    n = df.count() if n_rows is None else n_rows
    out = (
        df.groupBy(quoted(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("pct", half_up(F.col("count").cast("double") * 100.0 / F.lit(float(max(n, 1))), 4))
        .orderBy(F.desc("count"), "value")
    )
    return out if top_n is None else out.limit(top_n)


def target_distribution(df: DataFrame, target: str, positive=1) -> DataFrame:
    """Value counts of the target plus the negative:positive ratio (1 dp, 0 without positives)."""
    t = df.select(quoted(target).alias("t"))
    totals = t.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("t") == F.lit(positive), True)).alias("pos")).first()
    n, pos = totals["n"], totals["pos"]
    imbalance = math.floor((n - pos) / pos * 10 + 0.5) / 10 if pos else 0.0
    return value_counts(df, target, n_rows=n).select(
        F.col("value").alias("target_value"),
        "count",
        "pct",
        F.lit(imbalance).alias("imbalance_ratio"),
        labels.imbalance_level(F.lit(imbalance)).alias("imbalance_level"),
    )


def _top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct values, rows, and the most frequent value (smallest on a tie)."""
    top = F.min(F.struct((-F.col("count")).alias("neg"), F.col("value").alias("value")))
    return (
        value_histogram(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("n_unique"), F.sum("count").alias("n"), top.alias("top"))
        .select(
            "column",
            "n_unique",
            F.col("top.value").alias("top_value"),
            half_up(ratio(-F.col("top.neg"), F.col("n")) * F.lit(100.0), 4).alias("top_pct"),
        )
    )


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _top_values(df, columns).withColumn("encoding", labels.encoding_advice(F.col("n_unique")))


def near_constant(df: DataFrame, columns: Sequence[str], threshold_pct: float = 99.0) -> DataFrame:
    """Columns where one value takes more than ``threshold_pct`` of the rows."""
    return (
        _top_values(df, columns)
        .where(F.col("top_pct") > threshold_pct)
        .select("column", F.col("top_pct").alias("dominant_pct"))
    )


def skew_kurtosis(df: DataFrame, columns: Sequence[str] | None = None, min_values: int = 10) -> DataFrame:
    """Population skewness and excess kurtosis (4 dp) with flags; short columns are left out."""
    columns = list(columns or numeric_columns(df))
    raw = wide_aggregate_frame(
        df,
        columns,
        lambda c: {"n": F.count(c), "sk": F.skewness(c.cast("double")), "ku": F.kurtosis(c.cast("double"))},
    )
    sk = F.coalesce("sk", F.lit(0.0))
    return raw.where(F.col("n") >= min_values).select(
        "column",
        half_up(sk, 4).alias("skewness"),
        half_up(F.coalesce("ku", F.lit(0.0)), 4).alias("kurtosis"),
        labels.skew_flag(sk).alias("skew_flag"),
        labels.skew_advice(sk).alias("recommend"),
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bin counts from min to max per column; the last bin is closed, empty bins are kept."""
    columns = list(columns)
    clean = df.select(*[F.nanvl(quoted(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    ends = wide_aggregate(clean, columns, lambda c: {"lo": F.min(c), "hi": F.max(c)})
    spans = []
    for c in columns:
        lo, hi = ends[c]["lo"], ends[c]["hi"]
        if lo is not None:
            spans.append((c, lo - 0.5, hi + 0.5) if lo == hi else (c, lo, hi))
    # one row per column
    ranges = F.broadcast(small_table(df.sparkSession, spans, "column string, lo double, hi double"))
    n = F.lit(float(bins))
    slot = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * n)
    counted = (
        long_values(clean, columns, "double")
        .join(ranges, "column")
        .groupBy("column", F.least(slot, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    slots = ranges.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    width = F.col("hi") - F.col("lo")
    return slots.join(counted, ["column", "bin"], "left").select(
        "column",
        "bin",
        half_up(F.col("lo") + width * F.col("bin") / n, 6).alias("lower"),
        half_up(F.col("lo") + width * (F.col("bin") + 1) / n, 6).alias("upper"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], whisker: float = 1.5, **options) -> DataFrame:
    """Quartiles, whisker ends inside ``whisker`` x IQR, and the rows beyond the whiskers."""
    columns = list(columns)
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75), **options)
    frames = []
    known = [c for c in columns if quartiles[c][0] is not None]
    fences = {}
    for c in known:
        q1, _, q3 = quartiles[c]
        fences[c] = (q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1))
    per_select = 30
    for start in range(0, len(known), per_select):
        structs = []
        for c in known[start : start + per_select]:
            x = quoted(c).cast("double")
            lo, hi = (F.lit(v) for v in fences[c])
            q1, med, q3 = (F.lit(v) for v in quartiles[c])
            structs.append(
                F.struct(
                    F.lit(c).alias("column"),
                    half_up(q1, 6).alias("q1"),
                    half_up(med, 6).alias("median"),
                    half_up(q3, 6).alias("q3"),
                    half_up(F.least(F.min(F.when(x >= lo, x)), q1), 6).alias("whisker_low"),
                    half_up(F.greatest(F.max(F.when(x <= hi, x)), q3), 6).alias("whisker_high"),
                    F.count(F.when((x < lo) | (x > hi), True)).alias("n_outliers"),
                )
            )
        frames.append(df.agg(F.array(*structs).alias("r")).select(F.inline("r")))
    return union_all(frames)

