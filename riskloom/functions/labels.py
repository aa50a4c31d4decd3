"""Threshold ladders that turn a number into a label.

The cut points and label texts are fixed values: results must carry them exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def ladder(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    out = None
    for cond, text in steps:
        out = F.when(cond, F.lit(text)) if out is None else out.when(cond, F.lit(text))
    return out.otherwise(F.lit(default))


def missing_severity(pct: Column) -> Column:
    return ladder([(pct > 30, "Critical"), (pct > 5, "High"), (pct > 0, "Low")], "Complete")


def missing_action(pct: Column) -> Column:
    return ladder(
        [
            (pct > 60, "Consider dropping column"),
            (pct > 5, "Impute with median/mode or create missing indicator"),
            (pct > 0, "Simple imputation"),
        ],
        "No action required",
    )


def skew_flag(sk: Column) -> Column:
    return ladder(
        [
            (sk > 2, "High right skew"),
            (sk < -2, "High left skew"),
            (F.abs(sk) > 1, "Moderate skew"),
        ],
        "Normal",
    )


def skew_advice(sk: Column) -> Column:
    return ladder(
        [(F.abs(sk) > 2, "Log/Box-Cox transform"), (F.abs(sk) > 1, "Optional transform")],
        "No transform needed",
    )


def iv_strength(iv: Column) -> Column:
    return ladder(
        [(iv > 0.5, "Suspicious"), (iv > 0.3, "Strong"), (iv > 0.1, "Medium"), (iv > 0.02, "Weak")],
        "Useless",
    )


def encoding_advice(n_unique: Column) -> Column:
    return ladder([(n_unique <= 10, "OHE"), (n_unique <= 50, "Ordinal/WoE")], "WoE/Target Encode")


def imbalance_level(ratio: Column) -> Column:
    return ladder([(ratio > 10, "danger"), (ratio > 4, "warning")], "success")


def quality_grade(score: Column) -> Column:
    return ladder([(score >= 85, "A"), (score >= 70, "B"), (score >= 55, "C"), (score >= 40, "D")], "F")


# Preparation hint per semantic class; categories go by their size.
TRANSFORM_ADVICE = {
    "target": "Use as label — do not include as feature",
    "constant": "Drop — zero variance, no predictive value",
    "identifier": "Drop — uniqueness ≥ 95%, likely ID/key column",
    "boolean": "Encode as 0/1 integer — no other transform needed",
    "datetime": "Extract year/month/day/weekday features or compute age",
    "numeric": "Impute median, winsorise IQR 3×, StandardScaler for LR",
}


def transform_advice(col_type: Column, n_unique: Column) -> Column:
    steps = [(col_type == kind, text) for kind, text in TRANSFORM_ADVICE.items()]
    steps += [(n_unique <= 10, "OHE (≤10 unique)"), (n_unique <= 50, "Ordinal Encode (≤50 unique)")]
    return ladder(steps, "WoE / Target Encode (>50 unique)")
