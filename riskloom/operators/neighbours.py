"""Nearest-neighbour mutual information of a number and a class, by sorts and joins.

Rows are first collapsed to one per (column, class, value), so ties cost nothing.  Within
a class the k nearest rows of a value lie within k distinct values on either side: a
class's order is cut into blocks of ``PLACES`` values, and only the k values at each end
of a block are sent to the next block too.  Rows of any class inside the resulting radius
are counted in blocks of the value line; a radius that crosses a cut is sent to every
block it meets, which is so for some 2k values of a class and cut, and its counts are added.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.scalar import half_up, quoted
from riskloom.operators.kernels import with_row_number
from riskloom.sources.scratch import materialise, small_table

PLACES = 100_000  # values of a block


def digamma(n: Column) -> Column:
    """The digamma function of whole numbers from 1 on: eight steps of its recurrence, then the asymptotic series."""
    x = n.cast("double") + 8
    square = 1.0 / (x * x)
    series = F.log(x) - 0.5 / x - square * (F.lit(1 / 12) - square * (F.lit(1 / 120) - square / 252))
    steps = sum((1.0 / (n.cast("double") + j) for j in range(1, 8)), 1.0 / n.cast("double"))
    return series - steps


def _values(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """column (its place), label, value, n: rows per distinct value; NULL as 0, rows without a target left out."""
    cells = F.array(*[F.struct(F.lit(k).alias("column"), F.coalesce(quoted(c).cast("double"), F.lit(0.0)).alias("value")) for k, c in enumerate(columns)])
    rows = df.where(quoted(target).isNotNull()).select(quoted(target).cast("int").alias("label"), F.explode(cells).alias("c"))
    # both zeros are one value
    return rows.select("label", "c.column", (F.col("c.value") + F.lit(0.0)).alias("value")).groupBy("column", "label", "value").agg(F.count("*").alias("n"))


def _nearest(value: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """low, high, touching for each of a class's values in order: the radius to the ``k``-th nearest other row.

    The radius ends before ``low`` and ``high``; at ``touching`` values it is zero, and
    both are the value itself.
    """
    at = np.arange(len(value))[:, None] + np.arange(-k, k + 1)
    known = (at >= 0) & (at < len(value))
    at = np.clip(at, 0, len(value) - 1)
    with np.errstate(invalid="ignore"):
        d = np.where(known, np.abs(value[at] - value[:, None]), np.nan)
    rows = np.where(known, n[at], 0)
    rows[:, k] -= 1
    order = np.argsort(d, axis=1, kind="stable")  # of equal distances the smaller value first
    place = (np.cumsum(np.take_along_axis(rows, order, 1), axis=1) >= k).argmax(axis=1)
    row = np.arange(len(value))
    place = order[row, place]
    d, end = d[row, place], value[at[row, place]]
    # the end where the neighbour lies is its own value, free of rounding; NaN is above all numbers
    with np.errstate(invalid="ignore"):
        below = (end < value) | (np.isnan(value) & ~np.isnan(end))
        above = (end > value) | (np.isnan(end) & ~np.isnan(value))
        low, high = np.where(below, end, value - d), np.where(above, end, value + d)
    touching = d == 0
    return np.where(touching, value, low), np.where(touching, value, high), touching


def neighbour_radius(ranked: DataFrame, most: int, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """column, label, idx, value, n, low, high, touching, first, last: radii, and the blocks of the value line they meet.

    ``ranked`` (column, label, value, n, idx, k) has the values of each class numbered
    from 1 in order; k is at most ``most`` and the same throughout a class.
    """
    size = max(PLACES, most)
    block, inner = F.expr(f"idx div {size}"), F.col("idx") % size
    to = F.array_compact(F.array(block, F.when(inner < most, block - 1), F.when(inner >= size - most, block + 1)))

    def measure(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        idx, value, n = (group[c].to_numpy() for c in ("idx", "value", "n"))
        column, own = group["column"][0].as_py(), idx // size == group["block"][0].as_py()
        low, high, touching = _nearest(value, n, group["k"][0].as_py())
        line = np.array(cuts[column], float)
        found = {"low": low, "high": high, "touching": touching, "first": np.searchsorted(line, low), "last": np.searchsorted(line, high)}
        kept = group.select(["column", "label", "idx", "value", "n"])
        for name, values in found.items():
            kept = kept.append_column(name, pa.array(values))
        return kept.filter(pa.array(own))

    schema = "column int, label int, idx bigint, value double, n bigint, low double, high double, touching boolean, first bigint, last bigint"
    return ranked.select("*", F.explode(to).alias("block")).groupBy("column", "label", "block").applyInArrow(measure, schema)


def rows_within(radius: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """column, label, m, n: how many rows of a class have ``m`` rows of any class within their radius."""

    def count(group: pa.Table) -> pa.Table:
        group = group.sort_by("value")
        column, block = group["column"][0].as_py(), group["block"][0].as_py()
        value, n, low, high, touching, first, last = (group[c].to_numpy() for c in ("value", "n", "low", "high", "touching", "first", "last"))
        own = np.searchsorted(np.array(cuts[column], float), value) == block
        line, below = value[own], np.concatenate([[0], np.cumsum(n[own])])
        start = np.where(touching, np.searchsorted(line, low), np.searchsorted(line, low, "right"))
        end = np.where(touching, np.searchsorted(line, high, "right"), np.searchsorted(line, high))
        m = below[np.maximum(start, end)] - below[start]
        whole = first == last
        label, idx = group["label"].to_numpy(), group["idx"].to_numpy()
        # whole radii as a row per class and count, the others one by one
        pairs, at = np.unique(np.stack([label[whole], m[whole]]), axis=1, return_inverse=True)
        total = np.bincount(at.ravel(), n[whole], pairs.shape[1])
        out = {
            "label": np.concatenate([pairs[0], label[~whole]]), "m": np.concatenate([pairs[1], m[~whole]]),
            "n": np.concatenate([total, n[~whole]]), "idx": np.concatenate([np.zeros(pairs.shape[1]), idx[~whole]]),
        }
        return pa.table({"column": pa.array(np.full(len(out["m"]), column), pa.int32()), "label": pa.array(out["label"].astype(np.int32)), **{c: pa.array(out[c].astype(np.int64)) for c in ("idx", "m", "n")}})

    sent = radius.select("*", F.explode(F.sequence("first", "last")).alias("block"))
    # idx 0: counts that are whole already
    found = materialise(sent.groupBy("column", "block").applyInArrow(count, "column int, label int, idx bigint, m bigint, n bigint"), "within")
    whole = found.where("idx = 0").groupBy("column", "label", "m").agg(F.sum("n").alias("n"))
    added = found.where("idx > 0").groupBy("column", "label", "idx").agg(F.sum("m").alias("m"), F.max("n").alias("n"))
    return whole.unionByName(added.select("column", "label", "m", "n"))


def _line_cuts(ranked: DataFrame, columns: int) -> list[list[float]]:
    """Per column the values that cut its line into blocks of about ``PLACES`` values; counts do not depend on them."""
    sizes = ranked.groupBy("column").agg(F.count("*").alias("n")).collect()  # a row per column
    blocks = max([-(-r["n"] // PLACES) for r in sizes], default=1)
    out: list[list[float]] = [[] for _ in range(columns)]
    if blocks > 1:
        probs = F.array(*[F.lit(b / blocks) for b in range(1, blocks)])
        for r in ranked.groupBy("column").agg(F.percentile_approx("value", probs, max(10_000, 20 * blocks)).alias("q")).collect():
            out[r["column"]] = sorted({v for v in r["q"] if not math.isnan(v)})
    return out


def mutual_information_knn(df: DataFrame, columns: Sequence[str], target: str, k: int = 5, dp: int = 6) -> DataFrame:
    """feature, mi (nats, at least 0): the k-nearest-neighbour estimate between each column and the class.

    For a row, d is the distance to the k-th nearest other row of its class (k is less
    in a class of at most k rows; a class of one row is left out), and m the rows of any
    class nearer than d, itself included, or at its own value if d is 0.  The estimate
    is psi(N) + mean psi(k) - mean psi(class size) - mean psi(m).  NULL counts as 0.
    """
    values = materialise(_values(df, columns, target), "values")
    sizes = values.where(F.col("column") == 0).groupBy("label").agg(F.sum("n").alias("size")).collect()  # a row per class
    sizes = [(r["label"], r["size"]) for r in sizes if r["size"] > 1]
    total = sum(n for _, n in sizes)
    classes = small_table(df.sparkSession, [(label, n, min(k, n - 1)) for label, n in sizes], "label int, size bigint, k int")
    values = values.join(F.broadcast(classes.drop("size")), "label")
    ranked = materialise(with_row_number(values, [F.col("value")], "idx", by=["column", "label"]), "ranked")
    cuts = _line_cuts(ranked, len(columns))
    rows = rows_within(neighbour_radius(ranked, k, cuts), cuts).join(F.broadcast(classes), "label")
    mean = F.sum(F.col("n") * (digamma(F.col("k")) - digamma(F.col("size")) - digamma(F.col("m")))) / F.lit(max(total, 1))
    mi = rows.groupBy("column").agg(F.greatest(digamma(F.lit(max(total, 1))) + mean, F.lit(0.0)).alias("mi"))
    names = small_table(df.sparkSession, list(enumerate(columns)), "column int, feature string")
    return names.join(mi, "column", "left").select("feature", half_up(F.coalesce("mi", F.lit(0.0)), dp).alias("mi"))
