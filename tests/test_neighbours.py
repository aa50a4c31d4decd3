"""Nearest-neighbour mutual information against all pairs."""

import numpy as np
import pytest

from riskloom.operators import neighbours
from riskloom.operators.neighbours import mutual_information_knn


def psi(n):
    return sum(1.0 / j for j in range(1, n)) - 0.57721566490153286


def brute(x, y, k):
    kept = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[kept], y[kept]
    total = 0.0
    for v, c in zip(x, y):
        own = np.sort(np.abs(x[y == c] - v))[1:]  # without the row itself
        few = min(k, len(own))
        d = own[few - 1]
        m = (np.abs(x - v) < d).sum() if d > 0 else (x == v).sum()
        total += psi(few) - psi((y == c).sum()) - psi(int(m))
    return max(0.0, psi(len(x)) + total / len(x)) if len(x) else 0.0


@pytest.mark.parametrize("k,parts", [(1, 2), (3, 8), (5, 3)])
def test_all_pairs(spark, k, parts):
    draw = np.random.default_rng(k)
    n = 300
    y = (draw.random(n) < 0.3).astype(int)
    columns = {
        "smooth": draw.normal(size=n) + y,
        "tied": np.floor(draw.normal(size=n) * 4) / 4,  # exact in binary
        "hot": np.where(draw.random(n) < 0.6, 0.0, draw.integers(-8, 9, n) / 8),
        "same": np.zeros(n),
        "class": y.astype(float),
    }
    rows = [tuple(float(v[j]) for v in columns.values()) + (int(y[j]),) for j in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns) + ", y int").repartition(parts)
    got = {r["feature"]: r["mi"] for r in mutual_information_knn(df, list(columns), "y", k, dp=9).collect()}
    assert got == pytest.approx({c: brute(v, y, k) for c, v in columns.items()}, abs=1e-8)


def test_small_classes_and_nulls(spark):
    rows = [(1.0, 0), (None, 0), (2.0, 0), (5.0, 1), (7.0, 1), (9.0, 2), (3.0, None)]
    df = spark.createDataFrame(rows, "x double, y int")
    x = np.array([1.0, 0.0, 2.0, 5.0, 7.0, 9.0])
    assert mutual_information_knn(df, ["x"], "y", 3, dp=9).first()["mi"] == pytest.approx(brute(x, np.array([0, 0, 0, 1, 1, 2]), 3))
    assert mutual_information_knn(df.limit(0), ["x"], "y").first()["mi"] == 0.0


def test_radii_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PLACES", 30)  # blocks of either order far smaller than a radius of the rare class
    draw = np.random.default_rng(9)
    n = 260
    y = np.where(draw.random(n) < 0.04, 2, (draw.random(n) < 0.5).astype(int))
    columns = {"smooth": draw.normal(size=n), "tied": np.floor(draw.normal(size=n) * 8) / 8, "same": np.zeros(n)}
    rows = [tuple(float(v[j]) for v in columns.values()) + (int(y[j]),) for j in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns) + ", y int").repartition(3)
    got = {r["feature"]: r["mi"] for r in mutual_information_knn(df, list(columns), "y", 5, dp=9).collect()}
    assert got == pytest.approx({c: brute(v, y, 5) for c, v in columns.items()}, abs=1e-8)


def test_values_sent_do_not_grow_with_neighbours(spark, monkeypatch):
    """Beyond the ends of blocks a value is sent once, not to 2k + 1 places."""
    monkeypatch.setattr(neighbours, "PLACES", 100)
    ranked = spark.range(1, 1001).selectExpr("0 as column", "0 as label", "cast(id as double) as value", "1L as n", "id as idx", "5 as k")
    radius = neighbours.neighbour_radius(ranked, 5, [[250.0, 500.0]])
    assert radius.count() == 1000
    assert radius.where("first <> last").count() <= 2 * 2 * 5
