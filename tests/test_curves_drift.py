"""Learning curves against separate fits, and stability over a stream in any arrival order."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.scalar import hash_order
from riskloom.operators import curves, joint
from riskloom.sources.scratch import scratch_path
from riskloom.streaming import drift


def auc(label, score):
    pos, neg = score[label == 1], score[label != 1]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_learning_curve(spark):
    draw = np.random.default_rng(1)
    n = 600
    x = draw.normal(size=(n, 2))
    y = (x[:, 0] + draw.normal(size=n) > 0).astype(int)
    split = ["Train" if k % 3 else "OOT" for k in range(n)]
    df = spark.createDataFrame([(k, split[k], int(y[k]), float(x[k, 0]), float(x[k, 1])) for k in range(n)], "id bigint, g string, y int, a double, b double")
    shares = (0.3, 1.0)
    got = {(r["share"], r["split"]): r for r in curves.learning_curve(df, ["a", "b"], "y", "g", "id", shares).collect()}
    h = {r["id"]: r["h"] for r in df.select("id", hash_order(F.col("id"), 42).alias("h")).collect()}
    place = np.array([h[k] for k in range(n)]) / float(int("f" * 15, 16))
    train = np.array(split) == "Train"
    scaled = (x - x[train].mean(axis=0)) / x[train].std(axis=0)
    assert set(got) == {(s, name) for s in shares for name in ("train", "OOT")}
    for share in shares:
        own = train & (place < share)
        z = np.column_stack([np.ones(n), scaled])
        beta = np.zeros(3)
        for _ in range(30):
            p = joint.sigmoid(z[own] @ beta)
            ridge = np.array([0, 1, 1]) / own.sum()
            g = z[own].T @ (p - y[own]) / own.sum() + ridge * beta
            beta -= np.linalg.solve((z[own] * (p * (1 - p))[:, None]).T @ z[own] / own.sum() + np.diag(ridge), g)
        for name, rows in (("train", own), ("OOT", ~train)):
            r = got[(share, name)]
            assert r["n"] == own.sum() and r["roc_auc"] == pytest.approx(auc(y[rows], z[rows] @ beta), abs=1e-5)


@pytest.mark.parametrize("order", ["sorted", "reversed", "mixed"])
def test_psi_in_any_arrival_order(spark, order):
    draw = np.random.default_rng(7)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=int(h)), None if h % 17 == 0 else float(draw.integers(0, 50)) + (h > 300) * 10) for h in range(600)]
    schema = "ts timestamp, v double"
    base = spark.createDataFrame(rows[:240], schema)
    cuts = drift.base_cuts(base, ["v"], 5)
    known = sorted(v for _, v in rows[:240] if v is not None)
    assert cuts["v"] == sorted({known[-(-k * len(known) // 5) - 1] for k in range(1, 5)})
    arrive = {"sorted": rows, "reversed": rows[::-1], "mixed": [rows[k] for k in draw.permutation(len(rows))]}[order]
    source, out, marks = (scratch_path(spark, name) for name in ("source", "counts", "marks"))
    for k in range(4):
        spark.createDataFrame(arrive[k * 150 : (k + 1) * 150], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = drift.psi_stream(stream, cuts, "ts", "5 days", "60 days", out, marks)
    query.awaitTermination()
    assert drift.late_rows(query) == 0
    got = {r["window_start"]: (r["n"], r["psi"]) for r in drift.psi_by_window(base, drift.window_counts(spark, out), cuts).collect()}

    def bins(values):
        return np.array([-1 if v is None else sum(c < v for c in cuts["v"]) for v in values])

    whole = bins([v for _, v in rows[:240]])
    expected = {}
    for ts in {datetime(1970, 1, 1) + timedelta(days=5 * ((t - datetime(1970, 1, 1)).days // 5)) for t, _ in rows}:
        own = bins([v for t, v in rows if ts <= t < ts + timedelta(days=5)])
        names = sorted(set(range(len(cuts["v"]) + 1)) | set(whole) | set(own))
        p = np.array([(whole == b).sum() + 0.5 for b in names]) / (len(whole) + 0.5 * len(names))
        q = np.array([(own == b).sum() + 0.5 for b in names]) / (len(own) + 0.5 * len(names))
        expected[ts] = (len(own), pytest.approx(((q - p) * np.log(q / p)).sum(), abs=1e-6))
    assert got == expected


def test_late_rows_are_counted(spark):
    schema = "ts timestamp, v double"
    source, out, marks = (scratch_path(spark, name) for name in ("source", "counts", "marks"))
    days = [[1, 2], [40, 41], [3, 42]]
    for own in days:
        spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(days=d), 1.0) for d in own], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = drift.psi_stream(stream, {"v": [0.5]}, "ts", "1 day", "2 days", out, marks)
    query.awaitTermination()
    late = drift.late_rows(query)
    assert drift.window_counts(spark, out).agg(F.sum("n")).first()[0] == 6 - late and late <= 1
