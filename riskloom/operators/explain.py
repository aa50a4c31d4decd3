"""Why a fitted ensemble scores as it does: Shapley values of every row, and accumulated local effects.

Both take the binned tables of ``growth`` and look at all rows, in Arrow batches with the
model in the task.

* Shapley values (path-dependent tree expectation).  A leaf's share of a prediction,
  given that only some features are known, is its value times a product over the
  features on its path: 1 or 0 for a known feature (does the row follow the path?), the
  share of training rows that follow it for an unknown one.  The Shapley values of such
  a product depend on a row only by which of the path's features it follows, so each
  leaf gets a small table of values by that pattern, and a row is one lookup per leaf.
* Accumulated local effects.  For the rows of each bin, the raw score at the bin minus
  that at the bin before, averaged, summed over bins and centred: the effect of a
  feature without what goes together with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.scalar import half_up
from riskloom.operators import growth
from riskloom.operators.growth import Ensemble, Tree
from riskloom.operators.joint import Linear, features_of, summed
from riskloom.sources.scratch import small_table


@dataclass(frozen=True)
class Leaf:
    """The features on a leaf's path, the range of bins (low, high] that follows it, and Shapley values by pattern."""

    features: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]
    by_pattern: np.ndarray  # 2^m x m; bit j of the pattern: the row follows feature j
    expected: float


def _pattern_values(value: float, shares: Sequence[float]) -> np.ndarray:
    """Shapley values of the product game value * prod(known ? follows : share), for each pattern of follows."""
    m = len(shares)
    weight = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
    out = np.zeros((2**m, m))
    for pattern in range(2**m):
        follows = [(pattern >> j) & 1 for j in range(m)]
        for j in range(m):
            ways = np.array([1.0])  # by how many others are known: the sum of products
            for other in range(m):
                if other != j:
                    ways = np.convolve(ways, [shares[other], follows[other]])
            out[pattern, j] = value * (follows[j] - shares[j]) * float(np.dot(ways, weight))
    return out


def leaves(tree: Tree, n_bins: int) -> list[Leaf]:
    found = []

    def walk(node: int, path: dict[int, tuple[int, int, float]]) -> None:
        if tree.feature[node] < 0:
            names = sorted(path)
            shares = [path[f][2] for f in names]
            value = float(tree.value[node])
            found.append(Leaf(tuple(names), tuple(path[f][0] for f in names), tuple(path[f][1] for f in names), _pattern_values(value, shares), value * math.prod(shares)))
            return
        f, cut = int(tree.feature[node]), int(tree.cut[node])
        low, high, share = path.get(f, (-1, n_bins, 1.0))
        for child, ends in ((2 * node + 1, (low, min(high, cut))), (2 * node + 2, (max(low, cut), high))):
            part = tree.rows[child] / tree.rows[node] if tree.rows[node] else 0.0
            walk(child, path | {f: (*ends, share * part)})

    walk(0, {})
    return found


def _scale(fit: Ensemble, trees: Sequence[Tree]) -> float:
    return fit.rate if fit.boosted else 1.0 / max(len(trees), 1)


def expected_score(fit: Ensemble, trees: Sequence[Tree], start: float, n_bins: int) -> float:
    """The raw score when no feature is known."""
    return (start if fit.boosted else 0.0) + _scale(fit, trees) * sum(leaf.expected for t in trees for leaf in leaves(t, n_bins))


def shapley_of_bins(fit: Ensemble, paths: Sequence[Leaf], scale: float, bins: np.ndarray) -> np.ndarray:
    """rows x features."""
    own = bins[:, list(fit.columns)]
    out = np.zeros(own.shape)
    for leaf in paths:
        pattern = np.zeros(len(own), np.int64)
        for j, (f, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high)):
            pattern |= ((own[:, f] > low) & (own[:, f] <= high)).astype(np.int64) << j
        values = leaf.by_pattern[pattern]
        for j, f in enumerate(leaf.features):
            out[:, f] += values[:, j]
    return scale * out


def shapley_values(table: DataFrame, fit: Ensemble, trees: Sequence[Tree], start: float, n_bins: int = growth.BINS) -> DataFrame:
    """row_key, base and phi (array in the order of ``fit.columns``) of every row; base + the sum of phi is the raw score.

    The raw score is the log-odds of boosted ensembles and the probability of others.
    """
    paths = [leaf for t in trees for leaf in leaves(t, n_bins)]
    scale, base = _scale(fit, trees), expected_score(fit, trees, start, n_bins)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phi = shapley_of_bins(fit, paths, scale, growth.bins_of(batch))
            cells = pa.FixedSizeListArray.from_arrays(pa.array(phi.ravel()), phi.shape[1]).cast(pa.list_(pa.float64()))
            keys = batch.column(batch.schema.get_field_index("row_key"))
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(phi), base)), cells], names=["row_key", "base", "phi"])

    return table.select("bins", "row_key").mapInArrow(explain, "row_key bigint, base double, phi array<double>")


def linear_shapley(table: DataFrame, fit: Linear, beta: np.ndarray) -> DataFrame:
    """base and phi of every row for a linear fit: coefficient times scaled distance from the mean."""
    means = table.agg(*[F.avg(f"x{c}").alias(f"x{c}") for c in fit.columns]).first()
    mean = np.array([means[f"x{c}"] or 0.0 for c in fit.columns])
    slope = beta[1:] / np.array(fit.width)
    base = float(beta[0] + slope @ (mean - np.array(fit.centre)))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phi = (features_of(batch, fit.columns) - mean) * slope
            cells = pa.FixedSizeListArray.from_arrays(pa.array(phi.ravel()), phi.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(phi), base)), cells], names=["base", "phi"])

    return table.mapInArrow(explain, "base double, phi array<double>")


def mean_shapley(values: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, mean_abs and mean_signed over all rows of ``phi``."""
    names = small_table(values.sparkSession, list(enumerate(features)), "at int, feature string")
    long = values.select(F.posexplode("phi").alias("at", "v")).groupBy("at").agg(F.avg(F.abs("v")).alias("mean_abs"), F.avg("v").alias("mean_signed"))
    return names.join(long, "at", "left").select("feature", *[half_up(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in ("mean_abs", "mean_signed")])


def local_effects(table: DataFrame, fit: Ensemble, trees: Sequence[Tree], start: float, features: Sequence[str], n_bins: int = growth.BINS) -> DataFrame:
    """feature, bin, n, effect: the centred accumulated local effect on the raw score; bins without a row have none."""
    scale = _scale(fit, trees)
    columns = list(fit.columns)

    def raw(own: np.ndarray) -> np.ndarray:
        return scale * sum((t.value[t.node(own)] for t in trees), np.zeros(len(own)))

    def partial(batch: pa.RecordBatch):
        own = growth.bins_of(batch)[:, columns]
        for j in range(len(columns)):
            n = np.bincount(own[:, j], minlength=n_bins)
            later = own[own[:, j] > 0]
            before = later.copy()
            before[:, j] -= 1
            change = np.bincount(later[:, j], raw(later) - raw(before), n_bins)
            yield j, np.concatenate([n, change])

    found = summed(table, partial)
    rows = []
    for j, name in enumerate(features):
        if j not in found:
            continue
        n, change = found[j].reshape(2, n_bins)
        ends = np.cumsum(np.where(n > 0, change / np.maximum(n, 1), 0.0))
        starts = np.concatenate([[0.0], ends[:-1]])
        centre = float((n * (starts + ends)).sum() / 2 / max(n.sum(), 1))
        rows += [(name, b, int(n[b]), float(ends[b] - centre)) for b in range(n_bins) if n[b]]
    return small_table(table.sparkSession, rows, "feature string, bin int, n bigint, effect double")


def directions(effects: DataFrame) -> DataFrame:
    """feature, effect_range, trend (correlation of bin and effect over rows) and direction."""
    w = F.col("n")
    mean = {c: F.sum(w * F.col(c)) / F.sum(w) for c in ("bin", "effect")}
    product = F.sum(w * F.col("bin") * F.col("effect")) / F.sum(w) - mean["bin"] * mean["effect"]
    spread = [F.greatest(F.sum(w * F.col(c) * F.col(c)) / F.sum(w) - mean[c] * mean[c], F.lit(0.0)) for c in ("bin", "effect")]
    grouped = effects.groupBy("feature").agg((F.max("effect") - F.min("effect")).alias("effect_range"), product.alias("p"), F.sqrt(spread[0] * spread[1]).alias("s"))
    trend = F.when((F.col("s") > 0) & (F.col("effect_range") > 0), F.col("p") / F.col("s"))
    label = F.when(trend > 0, "Positive risk").when(trend < 0, "Negative risk").otherwise("No effect")
    return grouped.select("feature", half_up(F.col("effect_range"), 6).alias("effect_range"), half_up(trend, 6).alias("trend"), label.alias("direction"))
