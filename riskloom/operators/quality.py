"""Duplicate rows and the data quality score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions import labels
from riskloom.functions.scalar import half_up, quoted, ratio
from riskloom.operators.kernels import union_all


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that have at least one exact copy: every member of a group of copies counts.

    Rows are screened by hash first, so only suspects are shuffled whole; copies
    collapse map-side before either shuffle, so one row repeated through a third of
    the table costs one record per task.
    """
    columns = list(columns or df.columns)
    rows = df.select(*[quoted(c) for c in columns])
    total = rows.agg(F.lit("n").alias("k"), F.count(F.lit(1)).alias("v"))
    hashed = rows.withColumn("_h", F.xxhash64(*[quoted(c) for c in columns]))
    repeated = hashed.groupBy("_h").count().where(F.col("count") > 1).select("_h")
    suspects = hashed.join(repeated, "_h", "left_semi").drop("_h")
    copies = suspects.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    dup = copies.agg(F.lit("d").alias("k"), F.coalesce(F.sum("_n"), F.lit(0)).alias("v"))
    both = union_all([total, dup]).agg(
        F.max(F.when(F.col("k") == "n", F.col("v"))).alias("n_rows"),
        F.max(F.when(F.col("k") == "d", F.col("v"))).alias("duplicate_rows"),
    )
    pct = F.coalesce(ratio(F.col("duplicate_rows"), F.col("n_rows")), F.lit(0.0)) * F.lit(100.0)
    return both.withColumn("duplicate_pct", half_up(pct, 6))


def quality_score(
    missing: DataFrame, duplicates: DataFrame, leaks: DataFrame, schema_map: DataFrame
) -> DataFrame:
    """0-100 score and grade from ``missing_summary``, ``duplicate_rows``, ``leakage_flags``, ``schema_classify``.

    The four inputs are small; each becomes one (name, value) row.
    """
    facts = union_all(
        [
            missing.select(F.lit("n_high").alias("k"), F.col("n_high").cast("double").alias("v")),
            missing.select(F.lit("missing").alias("k"), F.col("overall_missing_pct").alias("v")),
            duplicates.select(F.lit("dup").alias("k"), F.col("duplicate_pct").alias("v")),
            leaks.agg(F.lit("leak").alias("k"), F.count(F.lit(1)).cast("double").alias("v")),
            schema_map.agg(
                F.lit("const").alias("k"),
                F.count(F.when(F.col("col_type") == "constant", True)).cast("double").alias("v"),
            ),
        ]
    )

    def fact(name: str):
        return F.max(F.when(F.col("k") == name, F.col("v")))

    row = facts.agg(
        fact("n_high").alias("n_high_missing"),
        fact("missing").alias("overall_missing_pct"),
        fact("dup").alias("duplicate_pct"),
        fact("leak").alias("n_leakage"),
        fact("const").alias("n_constant"),
    )
    # fixed values: weight and cap of each penalty
    penalties = (
        ("n_high_missing", 2.0, 30.0),
        ("overall_missing_pct", 0.5, 10.0),
        ("duplicate_pct", 2.0, 10.0),
        ("n_leakage", 5.0, 10.0),
        ("n_constant", 1.0, 10.0),
    )
    left = F.lit(100.0)
    for name, weight, cap in penalties:
        left = left - F.least(F.lit(cap), F.col(name) * F.lit(weight))
    score = F.greatest(F.lit(0.0), F.bround(left, 0))
    return row.withColumn("score", score.cast("bigint")).withColumn("grade", labels.quality_grade(F.col("score")))
