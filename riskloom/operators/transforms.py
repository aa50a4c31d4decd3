"""Fitted feature transforms: fit on one frame, keep a spec, apply anywhere.

A spec is a long table (step, column, key, num, txt, position).  All its steps
but the WoE maps are bounded by the schema and become literals in one
projection; a WoE map has a row per category, so it stays a table and is joined.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from riskloom.functions import scalar
from riskloom.functions.scalar import half_up, is_missing, quoted, ratio
from riskloom.operators.governance import align_columns, columns_of, schema_classify
from riskloom.operators.kernels import exact_quantiles, unpivot_typed, value_histogram, wide_aggregate, with_row_number
from riskloom.sources.scratch import materialise, small_table

SPEC_SCHEMA = "step string, column string, key string, num double, txt string, position int"


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else quoted(c) for c in df.columns])


# -- missing values ---------------------------------------------------------


def sparse_columns(df: DataFrame, columns: Sequence[str], above_pct: float = 5.0) -> list[str]:
    stats = wide_aggregate(df, columns, lambda c: {"n": F.count(F.lit(1)), "present": F.count(c)})
    return [c for c in columns if _missing_pct(stats[c]) > above_pct]


def _missing_pct(s: Mapping[str, int]) -> float:
    return (s["n"] - s["present"]) / max(s["n"], 1) * 100.0


def add_missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select("*", *[is_missing(quoted(c)).alias(f"{c}_is_missing") for c in columns])


def fit_fill(
    df: DataFrame, columns: Sequence[str], strategy: str = "median", constant: float = 0.0, **options
) -> dict[str, float]:
    """Fill value per numeric column: median (exact), mean or a constant; 0 where a column is empty."""
    if strategy == "constant":
        return {c: float(constant) for c in columns}
    if strategy == "mean":
        means = wide_aggregate(df, columns, lambda c: {"m": F.avg(c.cast("double"))})
        return {c: means[c]["m"] or 0.0 for c in columns}
    medians = exact_quantiles(df, columns, (0.5,), **options)
    return {c: medians[c][0] or 0.0 for c in columns}


def impute(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    return _replace(df, {c: F.coalesce(quoted(c), F.lit(v)) for c, v in fills.items()})


def fit_modes(df: DataFrame, columns: Sequence[str], unknown: str = "UNKNOWN") -> dict[str, str]:
    """Most frequent non-null value as text, smallest on a tie; ``unknown`` for an empty column."""
    top = F.min(F.struct((-F.col("count")).alias("neg"), F.col("value").alias("value")))
    rows = (
        value_histogram(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column")
        .agg(top.alias("top"))
        .select("column", "top.value")
        .collect()  # one row per column
    )
    found = {r["column"]: r["value"] for r in rows}
    return {c: found.get(c, unknown) for c in columns}


# -- outliers and skew ------------------------------------------------------


def fit_fences(
    df: DataFrame, columns: Sequence[str], method: str = "iqr", k: float = 3.0, **options
) -> dict[str, tuple[float, float]]:
    """Clip bounds: quartiles -/+ k IQR, or mean -/+ k standard deviations; none for empty columns."""
    if method == "none":
        return {}
    if method == "zscore":
        stats = wide_aggregate(
            df, columns, lambda c: {"m": F.avg(c.cast("double")), "s": F.stddev_pop(c.cast("double"))}
        )
        return {
            c: (s["m"] - k * s["s"], s["m"] + k * s["s"]) for c, s in stats.items() if s["m"] is not None
        }
    quartiles = exact_quantiles(df, columns, (0.25, 0.75), **options)
    return {c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, (q1, q3) in quartiles.items() if q1 is not None}


def winsorise(df: DataFrame, fences: Mapping[str, tuple[float, float]]) -> DataFrame:
    return _replace(df, {c: scalar.clip(quoted(c).cast("double"), lo, hi) for c, (lo, hi) in fences.items()})


def fit_log_columns(df: DataFrame, columns: Sequence[str], skew_above: float = 2.0, min_values: int = 10) -> list[str]:
    """Columns with only positive values and a right skew beyond the bar."""
    stats = wide_aggregate(
        df,
        columns,
        lambda c: {"n": F.count(c), "lo": F.min(c.cast("double")), "sk": F.skewness(c.cast("double"))},
    )
    return [c for c in columns if _takes_log(stats[c], skew_above, min_values)]


def _takes_log(s: Mapping[str, Any], skew_above: float, min_values: int) -> bool:
    return s["n"] >= min_values and s["lo"] > 0 and s["sk"] is not None and s["sk"] > skew_above


def log1p_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, {c: scalar.log1p(quoted(c).cast("double")) for c in columns})


# -- categories -------------------------------------------------------------


def encoding_for(n_unique: int, max_levels: int = 50) -> str:
    return "one_hot" if n_unique <= 10 else "ordinal" if n_unique <= max_levels else "woe"


def encoding_plan(df: DataFrame, columns: Sequence[str], max_levels: int = 50) -> DataFrame:
    n = F.col("n_unique")
    plan = F.when(n <= 10, "one_hot").when(n <= max_levels, "ordinal").otherwise("woe")
    return (
        value_histogram(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("n_unique"))
        .withColumn("encoding", plan)
    )


# Values of a column that may become columns of their own, or reach the driver.
MOST_LEVELS = 1_000


def fit_levels(df: DataFrame, columns: Sequence[str], max_levels: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Sorted non-null values per column; a column of more than ``max_levels`` is refused.

    The row-number filter is pushed below the shuffle, so no task ever holds more than
    max_levels + 1 values of a column.
    """
    if not columns:
        return {}
    w = W.partitionBy("column").orderBy("value")
    values = value_histogram(df, columns).where(F.col("value").isNotNull())
    values = values.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max_levels + 1)
    rows = values.select("column", "value").collect()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        levels[r["column"]].append(r["value"])
    for c, values in levels.items():
        if len(values) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} values; encode it by woe")
        values.sort(key=lambda v: v.encode("utf-8"))
    return levels


def one_hot_exprs(c: Column, name: str, levels: Sequence[str]) -> dict[str, Column]:
    text = c.cast("string")
    return {f"{name}_{v}": F.when(text == F.lit(v), 1).otherwise(0).cast("byte") for v in levels}


def one_hot(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Replace the column by one 0/1 column per level, none dropped."""
    out: list[Column] = []
    for c in df.columns:
        if c == column:
            out += [e.alias(n) for n, e in one_hot_exprs(quoted(c), c, levels).items()]
        else:
            out.append(quoted(c))
    return df.select(*out)


def ordinal_expr(c: Column, levels: Sequence[str]) -> Column:
    """Position of the value among the fitted levels; NULL for an unseen value."""
    text = c.cast("string")
    out = None
    for i, v in enumerate(levels):
        code = F.lit(i).cast("bigint")
        out = F.when(text == F.lit(v), code) if out is None else out.when(text == F.lit(v), code)
    return F.lit(None).cast("bigint") if out is None else out


def ordinal(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    return _replace(df, {c: ordinal_expr(quoted(c), v) for c, v in levels.items()})


def ordinal_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the place of every non-null value among its column's, from 0, in code-point order.

    Any number of values: they are ranked where they are, and none reaches the driver.
    """
    values = value_histogram(df, columns).where(F.col("value").isNotNull()).select("column", "value")
    ranked = with_row_number(values, [F.col("value")], "code", by=["column"])
    return materialise(ranked.withColumn("code", F.col("code") - 1), "codes")


def ordinal_encode(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Columns of ``codes`` (of ``ordinal_codes``) as their values' codes; NULL for NULL and unseen values.

    One join per column; the planner broadcasts small code tables.
    """
    order = df.columns
    for k, r in enumerate(codes.select("column").distinct().collect()):  # one row per encoded column
        c = r["column"]
        own = codes.where(F.col("column") == c).select(F.col("value").alias(f"_value{k}"), F.col("code").alias(f"_code{k}"))
        df = df.join(own, quoted(c).cast("string") == F.col(f"_value{k}"), "left")
        df = df.withColumn(c, F.col(f"_code{k}")).drop(f"_value{k}", f"_code{k}")
    return df.select(*[quoted(c) for c in order])


def woe_map(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, key, woe) per non-null category; 0 where a class is missing.

    Totals come from a second, column-sized aggregate and join back on the column,
    so a column with millions of categories is never one group.
    """
    y = quoted(target)
    event = (y.cast("double") == 1.0).cast("int")
    long = unpivot_typed(df.where(y.isNotNull()).withColumn("_event", event), columns, "string", keep=["_event"])
    cells = (
        long.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("_event").alias("ev"), F.sum(F.lit(1) - F.col("_event")).alias("nev"))
    )
    totals = cells.groupBy("column").agg(F.sum("ev").alias("te"), F.sum("nev").alias("tn"))
    de, dn = ratio(F.col("ev"), F.col("te")), ratio(F.col("nev"), F.col("tn"))
    woe = F.when((de > 0) & (dn > 0), F.log(de / dn)).otherwise(F.lit(0.0))
    # totals: one row per column
    return cells.join(F.broadcast(totals), "column").select("column", F.col("value").alias("key"), woe.alias("woe"))


def apply_woe(df: DataFrame, maps: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their WoE; NULL for an unseen or missing one.

    A plain left join: the planner broadcasts the map when its size allows, and
    adaptive execution splits a hot category otherwise.
    """
    order = df.columns
    for c in columns:
        one = maps.where(F.col("column") == c).select(F.col("key").alias("_key"), F.col("woe").alias("_woe"))
        joined = df.join(one, quoted(c).cast("string") == F.col("_key"), "left")
        df = joined.select(*[F.col("_woe").alias(c) if x == c else quoted(x) for x in order])
    return df


def woe_encode(df: DataFrame, columns: Sequence[str], target: str, fit: DataFrame | None = None) -> DataFrame:
    return apply_woe(df, woe_map(df if fit is None else fit, columns, target), columns)


def rare_merge(
    df: DataFrame, column: str, threshold: float = 0.01, other: str = "OTHER", fit: DataFrame | None = None
) -> DataFrame:
    """Categories below ``threshold`` of the rows become ``other``; NULL stays.

    At most 1 / threshold values can be frequent, so the list of kept ones is short.
    """
    source = df if fit is None else fit
    n = source.count()
    frequent = (
        source.groupBy(quoted(column).cast("string").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= F.lit(threshold * n)) & F.col("v").isNotNull())
    )
    keep = [r["v"] for r in frequent.collect()]
    text = quoted(column).cast("string")
    merged = F.when(text.isNull(), text).when(text.isin(*keep), text).otherwise(F.lit(other))
    return _replace(df, {column: merged})


# -- scaling ----------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str = "standard", **options) -> dict[str, tuple[float, float]]:
    """(centre, width) per column; a width of zero counts as 1.

    standard: mean and population deviation; robust: median and IQR; minmax:
    minimum and range.
    """
    if kind == "robust":
        q = exact_quantiles(df, columns, (0.25, 0.5, 0.75), **options)
        raw = {c: (v[1], v[2] - v[0]) if v[0] is not None else (0.0, 1.0) for c, v in q.items()}
    elif kind == "standard":
        s = wide_aggregate(df, columns, lambda c: {"m": F.avg(c.cast("double")), "w": F.stddev_pop(c.cast("double"))})
        raw = {c: (v["m"] or 0.0, v["w"] or 0.0) for c, v in s.items()}
    elif kind == "minmax":
        s = wide_aggregate(df, columns, lambda c: {"lo": F.min(c.cast("double")), "hi": F.max(c.cast("double"))})
        raw = {c: (v["lo"] or 0.0, (v["hi"] or 0.0) - (v["lo"] or 0.0)) for c, v in s.items()}
    elif kind == "none":
        raw = {c: (0.0, 1.0) for c in columns}
    else:
        raise ValueError(f"unknown scaler: {kind}")
    return {c: (m, w if w and math.isfinite(w) else 1.0) for c, (m, w) in raw.items()}


def scale_expr(name: str, params: tuple[float, float]) -> Column:
    centre, width = params
    return (quoted(name).cast("double") - F.lit(centre)) / F.lit(width)


def scale(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    return _replace(df, {c: scale_expr(c, p) for c, p in params.items()})


# -- spec: fit, apply -------------------------------------------------------


def fit_spec(
    df: DataFrame,
    target: str,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    boolean: Sequence[str] | None = None,
    constant: Sequence[str] | None = None,
    identifier: Sequence[str] | None = None,
    group: str | None = None,
    fit_on: str = "Train",
    indicator_above_pct: float = 5.0,
    outliers: str = "iqr",
    fence: float = 3.0,
    max_levels: int = 50,
    **options,
) -> DataFrame:
    """Fit every transform on one split and return the spec table.

    Column lists that are None come from ``schema_classify`` of the fitted split.
    """
    fit = df if group is None else df.where(quoted(group) == F.lit(fit_on))
    if None in (numeric, categorical, boolean, constant, identifier):
        kinds = schema_classify(fit, target).cache()
        auto = [columns_of(kinds, k) for k in ("numeric", "categorical", "boolean", "constant", "identifier")]
        given = (numeric, categorical, boolean, constant, identifier)
        numeric, categorical, boolean, constant, identifier = (a if g is None else list(g) for a, g in zip(auto, given))
        kinds.unpersist()
        categorical = [c for c in categorical if c != group]
    useless = {*constant, *identifier, target}
    numeric, categorical, boolean = ([c for c in cols if c not in useless] for cols in (numeric, categorical, boolean))
    remaining = [*numeric, *categorical, *boolean]

    rows: list[tuple] = []

    def add(step: str, column: str | None, key: str | None = None, num: float | None = None, txt: str | None = None,
            position: int | None = None) -> None:
        rows.append((step, column, key, None if num is None else float(num), txt, position))

    for c in constant:
        add("drop_constant", c)
    for c in identifier:
        add("drop_identifier", c)

    presence = wide_aggregate(fit, remaining, lambda c: {"n": F.count(F.lit(1)), "present": F.count(c)})
    indicators = [c for c in remaining if _missing_pct(presence[c]) > indicator_above_pct]
    for c in indicators:
        add("missing_indicator", c)

    shape = wide_aggregate(
        fit,
        numeric,
        lambda c: {"n": F.count(c), "lo": F.min(c.cast("double")), "sk": F.skewness(c.cast("double"))},
    )
    quartiles = exact_quantiles(fit, numeric, (0.25, 0.5, 0.75), {c: shape[c]["n"] for c in numeric}, **options)
    for c in numeric:
        add("impute", c, "median", num=quartiles[c][1] or 0.0)
    fences = {}
    if outliers == "iqr":
        for c in numeric:
            q1, _, q3 = quartiles[c]
            if q1 is not None:
                fences[c] = (q1 - fence * (q3 - q1), q3 + fence * (q3 - q1))
    else:
        fences = fit_fences(fit, numeric, outliers, fence)
    for c, (lo, hi) in fences.items():
        add("winsorise", c, "lower", num=lo)
        add("winsorise", c, "upper", num=hi)
    logged = [c for c in numeric if _takes_log(shape[c], 2.0, 10)]
    for c in logged:
        add("log_transform", c)

    plan: dict[str, str] = {}
    modes: dict[str, str] = {}
    if categorical:
        top = F.min(F.struct((-F.col("count")).alias("neg"), F.col("value").alias("value")))
        per_column = (
            value_histogram(fit, categorical)
            .where(F.col("value").isNotNull())
            .groupBy("column")
            .agg(F.count(F.lit(1)).alias("n_unique"), top.alias("top"))
            .select("column", "n_unique", "top.value")
            .collect()
        )
        found = {r["column"]: r for r in per_column}
        for c in categorical:
            modes[c] = found[c]["value"] if c in found else "UNKNOWN"
            plan[c] = encoding_for(found[c]["n_unique"] if c in found else 0, max_levels)
            add("impute", c, "mode", txt=modes[c])
            add("encoding", c, plan[c])
        for c, levels in fit_levels(fit, [c for c in categorical if plan[c] != "woe"]).items():
            for i, v in enumerate(levels):
                add("level", c, v, position=i)

    # size of the output: five dummies per one-hot column
    kinds_of = list(plan.values())
    estimate = (
        len(numeric) + len(logged) + 5 * kinds_of.count("one_hot") + kinds_of.count("ordinal")
        + kinds_of.count("woe") + len(boolean) + len(indicators)
    )
    add("n_features_out", None, num=estimate)

    spec = small_table(df.sparkSession, rows, SPEC_SCHEMA)
    woe_columns = [c for c in categorical if plan[c] == "woe"]
    if woe_columns:
        filled = impute(fit.select(quoted(target), *[quoted(c).cast("string").alias(c) for c in woe_columns]),
                        {c: modes[c] for c in woe_columns})
        maps = woe_map(filled, woe_columns, target).select(
            F.lit("woe_map").alias("step"), "column", "key", F.col("woe").alias("num"),
            F.lit(None).cast("string").alias("txt"), F.lit(None).cast("int").alias("position"),
        )
        spec = spec.unionByName(maps)
    return spec


def serve_features(
    df: DataFrame, spec: DataFrame, features: Sequence[str] | None = None, target: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Replay a spec: drop, indicators, impute, clip, log, encode, align.

    One projection over the input, batch or stream; each WoE column that reaches
    the output adds one join with its map.  ``features`` None keeps everything;
    ``keep`` columns (a key, a split) pass through in front.
    """
    steps: dict[str, list] = {}
    for r in spec.where(F.col("step") != "woe_map").collect():  # bounded by the schema
        steps.setdefault(r["step"], []).append(r)

    def names(step: str) -> list[str]:
        return [r["column"] for r in steps.get(step, [])]

    dropped = ({*names("drop_constant"), *names("drop_identifier")} - {target}) - set(keep)
    exprs = {c: quoted(c) for c in df.columns if c not in dropped}
    types = {f.name: f.dataType for f in df.schema}
    for c in names("missing_indicator"):
        if c in exprs:
            exprs[f"{c}_is_missing"] = is_missing(quoted(c))
    for r in steps.get("impute", []):
        c = r["column"]
        if c not in exprs:
            continue
        if r["txt"] is None:
            exprs[c] = F.coalesce(exprs[c].cast("double"), F.lit(r["num"]))
        elif isinstance(types[c], T.StringType):
            exprs[c] = F.coalesce(exprs[c], F.lit(r["txt"]))
        else:
            exprs[c] = F.coalesce(exprs[c], F.lit(r["txt"]).cast(types[c]))
    bounds: dict[str, dict[str, float]] = {}
    for r in steps.get("winsorise", []):
        bounds.setdefault(r["column"], {})[r["key"]] = r["num"]
    for c, b in bounds.items():
        if c in exprs:
            exprs[c] = scalar.clip(exprs[c], b.get("lower"), b.get("upper"))
    for c in names("log_transform"):
        if c in exprs:
            exprs[c] = scalar.log1p(exprs[c])
    levels: dict[str, list[tuple[int, str]]] = {}
    for r in steps.get("level", []):
        levels.setdefault(r["column"], []).append((r["position"], r["key"]))
    coded: dict[str, Column] = {}
    by_woe: list[str] = []
    plan = {r["column"]: r["key"] for r in steps.get("encoding", [])}
    for c, e in exprs.items():
        ordered = [v for _, v in sorted(levels.get(c, []))]
        if plan.get(c) == "one_hot":
            coded.update(one_hot_exprs(e, c, ordered))
        elif plan.get(c) == "ordinal":
            coded[c] = ordinal_expr(e, ordered)
        else:
            coded[c] = e
            if plan.get(c) == "woe":
                by_woe.append(c)
    wanted = list(coded) if features is None else align_columns(list(coded), features, target)
    wanted = [*keep, *[c for c in dict.fromkeys(wanted) if c not in keep]]
    base = df.select(*[coded[c].alias(c) for c in wanted])
    by_woe = [c for c in by_woe if c in wanted]
    if not by_woe:
        return base
    maps = spec.where(F.col("step") == "woe_map").select("column", "key", F.col("num").alias("woe"))
    return apply_woe(base, maps, by_woe)


def spec_for_report(spec: DataFrame) -> DataFrame:
    """The spec with rounded numbers, for display and comparison."""
    return spec.withColumn("num", half_up(F.col("num"), 6)).withColumn("position", F.col("position").cast("bigint"))
