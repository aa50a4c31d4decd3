import math
import random

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from riskloom.functions import scalar
from riskloom.operators import kernels as K

BRACKETED = {"accuracy": 200}


@pytest.fixture(scope="module")
def frame(spark):
    """Skewed input: one value fills a third of the rows, plus NULLs, negatives and a big integer column."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        hot = 42.0 if i % 3 == 0 else rng.lognormvariate(3, 2) * (-1 if i % 7 == 0 else 1)
        rows.append((i, hot, None if i % 5 == 0 else float(rng.randrange(4)), 2**60 + rng.randrange(10**6), None))
    df = spark.createDataFrame(rows, "id bigint, hot double, few double, big bigint, empty double")
    return df.repartition(7).cache()


@pytest.mark.parametrize("options", [{}, BRACKETED])
def test_order_statistics_exact(frame, options):
    cols = ["hot", "few", "big"]
    data = {c: sorted(r[0] for r in frame.select(c).where(F.col(c).isNotNull()).collect()) for c in cols}
    counts = {c: len(v) for c, v in data.items()}
    ranks = {c: [1, 2, n // 4, n // 3, n // 2, n - 1, n, n + 5] for c, n in counts.items()}
    got = K.order_statistics(frame, ranks, counts, **options)
    for c in cols:
        for r in ranks[c]:
            if r > counts[c]:
                assert (c, r) not in got
                continue
            x = got[c, r]
            assert x.value == data[c][r - 1]
            assert x.below == sum(v < x.value for v in data[c])
            assert x.equal == data[c].count(x.value)


def test_infinite_ends_and_long_tail(spark):
    values = [float("-inf")] * 3 + [10.0**k for k in range(-200, 300)] + [float("inf")] * 5
    df = spark.createDataFrame([(v,) for v in values], "x double")
    n = len(values)
    got = K.order_statistics(df, {"x": list(range(1, n + 1, 7))}, {"x": n}, accuracy=50)
    assert all(got["x", r].value == values[r - 1] for r in range(1, n + 1, 7))


def test_bracket_miss_falls_back(frame, monkeypatch):
    monkeypatch.setattr(K, "_brackets", lambda long, ranks, *a: {c: [(1e9, 2e9)] for c in ranks})
    n = frame.where("hot is not null").count()
    got = K.order_statistics(frame, {"hot": [n // 2]}, {"hot": n})
    assert got["hot", n // 2].value == sorted(r[0] for r in frame.select("hot").collect())[n // 2 - 1]


@pytest.mark.parametrize("options", [{}, BRACKETED])
def test_quantiles_match_numpy(frame, options):
    qs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = K.exact_quantiles(frame, ["hot", "few", "empty"], qs, **options)
    assert got["empty"] == [None] * len(qs)
    for c in ("hot", "few"):
        values = np.array([r[0] for r in frame.select(c).where(F.col(c).isNotNull()).collect()])
        assert np.allclose(got[c], np.quantile(values, qs), rtol=1e-12)


@pytest.mark.parametrize("options", [{}, BRACKETED])
@pytest.mark.parametrize("k", [3, 10, 7000])
def test_ntile_equals_window(frame, options, k):
    n = frame.where("hot is not null").count()
    small = frame if k < 7000 else frame.where("id < 40")
    n = small.count()
    cuts = K.ordered_cuts(small, {"hot": K.ntile_ranks(n, k)}, {"hot": n}, "id", **options)["hot"]
    bad = small.select(
        K.ntile_column(F.col("hot"), F.col("id"), cuts, n, k).alias("b"), F.ntile(k).over(W.orderBy("hot", "id")).alias("e")
    ).where("b <> e")
    assert bad.count() == 0
    ordered = [cuts[r] for r in sorted(cuts)]
    long = K.binned_long(small, ["hot"], {"hot": ordered}, "id", ["id"])
    truth = small.select("id", F.ntile(k).over(W.orderBy("hot", "id")).alias("e"))
    assert long.join(truth, "id").where("bin <> e").count() == 0


def test_bin_sizes_sum_to_rows(frame):
    n = frame.where("few is not null").count()
    cuts = K.ordered_cuts(frame, {"few": K.ntile_ranks(n, 10)}, {"few": n}, "id")["few"]
    sizes = [r["count"] for r in K.binned_long(frame, ["few"], {"few": [cuts[r] for r in sorted(cuts)]}, "id").groupBy("bin").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("parts", [None, 12])
def test_prefix_and_row_number(frame, parts):
    opts = {"parts": parts}
    numbered = K.with_row_number(frame, [F.col("hot"), F.col("id")], **opts)
    truth = F.row_number().over(W.orderBy("hot", "id"))
    assert numbered.withColumn("e", truth).where("e <> rank").count() == 0
    assert numbered.count() == 6000
    sums = K.with_prefix(frame, [F.col("id")], {"s": F.col("id")}, by=["few"], **opts)
    truth = F.sum("id").over(W.partitionBy("few").orderBy("id"))
    assert sums.withColumn("e", truth).where("NOT (e <=> s)").count() == 0
    assert sums.count() == 6000  # the NULL group is kept


def test_wide_aggregate_chunks(spark):
    df = spark.range(10).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(120)])
    cols = df.columns
    got = K.wide_aggregate(df, cols, lambda c: {"s": F.sum(c), "n": F.count(c)})
    assert [got[f"c{i}"]["s"] for i in range(120)] == [45 * i for i in range(120)]
    frame = K.wide_aggregate_frame(df, cols, lambda c: {"s": F.sum(c)})
    assert {r["column"]: r["s"] for r in frame.collect()} == {f"c{i}": 45 * i for i in range(120)}


def test_row_level_plans_have_no_single_partition(frame):
    n = 6000
    cuts = K.ordered_cuts(frame, {"hot": K.ntile_ranks(n, 10)}, {"hot": n}, "id")["hot"]
    plan = frame.select(K.ntile_column(F.col("hot"), F.col("id"), cuts, n, 10))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_scalars(spark):
    df = spark.createDataFrame([(None, 0.285), (-5.0, 1.005), (500.0, -2.0)], "x double, y double")
    rows = df.select(
        scalar.clip(F.col("x"), 0.0, 100.0), scalar.log1p(F.col("y")), scalar.half_up(F.col("y"), 1)
    ).collect()
    assert [r[0] for r in rows] == [None, 0.0, 100.0]
    assert rows[2][1] is None and math.isclose(rows[1][1], math.log1p(1.005))
    assert [r[2] for r in rows] == [0.3, 1.0, -2.0]
