"""Which columns may be used: name guard, semantic classes, feature lists."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions import labels
from riskloom.functions.scalar import half_up, quoted, ratio
from riskloom.operators.profile import cardinality, missing_counts

# Default name patterns of columns that must not be used.
PROHIBITED = (".*score.*", ".*reason_code.*", ".*reason.*")
# Whole names that mark an identifier.
ID_NAMES = (
    "id", "_id", "uuid", "guid", "row_id", "pk", "primary_key", "account_no", "customer_id",
    "loan_id", "contract_id", "application_id", "user_id", "member_id",
)
from riskloom.sources.scratch import small_table
# Name parts that mark a date or time.
DATE_WORDS = ("date", "dt", "time", "timestamp", "created", "updated", "modified", "birth", "inception", "maturity")
# Lower-case names tried when no target is given.
TARGET_NAMES = ("target", "label", "default", "bad_indicator")
NOT_FEATURES = ("target", "constant", "identifier", "datetime")


def prohibited_columns(names: Iterable[str], patterns: Sequence[str] = PROHIBITED) -> list[str]:
    rules = [re.compile(p, re.IGNORECASE) for p in patterns]
    return [n for n in names if any(r.search(n) for r in rules)]


def prohibited_guard(df: DataFrame, patterns: Sequence[str] = PROHIBITED) -> DataFrame:
    """Drop every column whose name matches a pattern (a projection: no data is touched)."""
    banned = set(prohibited_columns(df.columns, patterns))
    return df.select(*[quoted(c) for c in df.columns if c not in banned])


def drop_useless(df: DataFrame, schema_map: DataFrame, target: str | None = None) -> DataFrame:
    """Drop the constant and identifier columns of a ``schema_classify`` result, never the target."""
    useless = schema_map.where(F.col("col_type").isin("constant", "identifier")).select("column").collect()
    names = {r["column"] for r in useless} - {target}
    return df.select(*[quoted(c) for c in df.columns if c not in names])


def split_filter(df: DataFrame, group: str, label: str) -> DataFrame:
    return df.where(quoted(group) == F.lit(label))


def numeric_features(
    df: DataFrame, wanted: Sequence[str], target: str | None = None
) -> list[str]:
    """Wanted columns that exist, are numeric and are not the target; else all numeric columns."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != target]
    known = set(numeric)
    kept = [c for c in wanted if c in known]
    return kept or numeric


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL to 0 in the model columns (label included)."""
    wanted = set(columns)
    return df.select(*[F.coalesce(quoted(c), F.lit(0)).alias(c) if c in wanted else quoted(c) for c in df.columns])


def align_columns(columns: Sequence[str], features: Sequence[str], target: str | None = None) -> list[str]:
    """Exact columns, else the dummies ``feature_*``, in feature order; the target last if present."""
    present = set(columns)
    out: list[str] = []
    for f in features:
        if f in present:
            out.append(f)
        else:
            out += [c for c in columns if c.startswith(f"{f}_")]
    if target and target in present:
        out.append(target)
    return out


def align_features(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    return df.select(*[quoted(c) for c in align_columns(df.columns, features, target)])


def detect_target(columns: Sequence[str], preferred: str = "target") -> str | None:
    if preferred in columns:
        return preferred
    return next((c for c in columns if c.lower() in TARGET_NAMES), None)


def _type_class(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "number"
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "time"
    return "text"


def schema_classify(
    df: DataFrame,
    target: str | None = None,
    numeric_above: int = 20,
    name_rules: bool = True,
    float_ids: bool = True,
    exact: bool = True,
) -> DataFrame:
    """Semantic class per column; the first rule that fits wins.

    target, constant (<= 1 value), identifier (name, or > 95% distinct), boolean
    (type, or 2 values), datetime (type or name), categorical text, numeric above
    ``numeric_above`` values, else categorical.  ``name_rules=False`` ignores
    names; ``float_ids=False`` keeps near-unique fractional columns as numbers.
    """
    spark = df.sparkSession
    meta = small_table(spark, 
        [
            (i, f.name, f.dataType.simpleString(), _type_class(f.dataType),
             isinstance(f.dataType, (T.FractionalType, T.DecimalType)))
            for i, f in enumerate(df.schema, start=1)
        ],
        "position int, column string, data_type string, kind string, fractional boolean",
    )
    n_rows = df.count()
    known = (
        meta.join(cardinality(df, exact=exact), "column", "left")
        .join(missing_counts(df), "column", "left")
        .withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
        .withColumn("missing_pct", F.coalesce("missing_pct", F.lit(0.0)))
    )
    share = F.coalesce(ratio(F.col("n_unique"), F.lit(n_rows)), F.lit(0.0))
    name = F.lower("column")
    by_name: Column = F.lit(name_rules)
    id_name = by_name & name.isin(*ID_NAMES)
    date_name = by_name & name.rlike("|".join(DATE_WORDS))
    near_unique = share > 0.95
    if not float_ids:
        near_unique = near_unique & ~F.col("fractional")
    n, kind = F.col("n_unique"), F.col("kind")
    col_type = labels.ladder(
        [
            (F.col("column").eqNullSafe(F.lit(target)), "target"),
            (n <= 1, "constant"),
            (id_name | near_unique, "identifier"),
            ((kind == "bool") | (n == 2), "boolean"),
            ((kind == "time") | date_name, "datetime"),
            ((kind == "number") & (n > numeric_above), "numeric"),
        ],
        "categorical",
    )
    return known.withColumn("col_type", col_type).select(
        "column",
        "col_type",
        "data_type",
        "n_unique",
        half_up(share, 4).alias("uniqueness_ratio"),
        "missing_pct",
        labels.transform_advice(F.col("col_type"), n).alias("suggestion"),
    )


def schema_summary(schema_map: DataFrame) -> DataFrame:
    """Columns per class, in total, and usable as features."""
    t = F.col("col_type")

    def n(kind: str) -> Column:
        return F.count(F.when(t == kind, True)).alias(kind)

    kinds = ("numeric", "categorical", "boolean", "datetime", "identifier", "constant", "target")
    return schema_map.agg(
        F.count(F.lit(1)).alias("total_columns"),
        *[n(k) for k in kinds],
        F.count(F.when(~t.isin(*NOT_FEATURES), True)).alias("feature_columns"),
    )


def columns_of(schema_map: DataFrame, *kinds: str) -> list[str]:
    """Column names of the given classes (one entry per table column at most)."""
    return [r["column"] for r in schema_map.where(F.col("col_type").isin(*kinds)).select("column").collect()]


def feature_columns(schema_map: DataFrame) -> list[str]:
    return [r["column"] for r in schema_map.where(~F.col("col_type").isin(*NOT_FEATURES)).select("column").collect()]
