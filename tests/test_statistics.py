import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskloom.operators import governance, leaderboard as board, metrics, profile, quality, selection, stats, woe


def iv_of(df, **kw):
    return {r["feature"]: r["iv"] for r in woe.information_value(df, ["x"], "y", "id", **kw).collect()}["x"]


def test_woe_toy(spark):
    # two bins of four: (1 event, 3 non) and (3 events, 1 non)
    df = spark.createDataFrame([(i, float(i), int(i in (0, 4, 5, 6))) for i in range(8)], "id bigint, x double, y int")
    rows = {r["bin"]: r for r in woe.woe_table(df, ["x"], "y", "id", n_bins=2).collect()}
    assert rows[1]["events"] == 1 and rows[2]["events"] == 3
    assert math.isclose(rows[1]["woe"], round(math.log(0.25 / 0.75), 6))
    assert math.isclose(iv_of(df, n_bins=2), round(2 * 0.5 * math.log(3), 6), abs_tol=1e-6)


def test_zero_event_bin_adds_nothing_unless_smoothed(spark):
    df = spark.createDataFrame([(i, float(i), int(i >= 4)) for i in range(8)], "id bigint, x double, y int")
    assert iv_of(df, n_bins=2) == 0.0
    assert iv_of(df, n_bins=2, smoothing=0.5) > 0.8


def test_single_class_and_empty_column(spark):
    df = spark.createDataFrame([(i, float(i), 0, None) for i in range(8)], "id bigint, x double, y int, e double")
    assert woe.woe_table(df, ["x"], "y", "id").count() == 0
    got = {r["feature"]: r["iv"] for r in woe.information_value(df, ["x", "e"], "y", "id").collect()}
    assert got == {"x": 0.0, "e": 0.0}


def test_quantile_method_keeps_ties_together(spark):
    df = spark.createDataFrame([(i, float(i % 3), i % 2) for i in range(300)], "id bigint, x double, y int")
    rows = woe.woe_table(df, ["x"], "y", "id", method="quantile").collect()
    assert sum(r["events"] + r["non_events"] for r in rows) == 300
    assert len(rows) <= 3


def test_leakage(spark):
    df = spark.createDataFrame(
        [(i, float(i), float(i % 10), int((i > 50) != (i % 9 == 0))) for i in range(100)], "id bigint, x double, z double, y int"
    )
    assert [r["feature"] for r in woe.leakage_flags(df, ["x", "z"], "y", "id").collect()] == ["x"]


def brute_swap(aucs, nf):
    rows = [[a, n, i] for i, (a, n) in enumerate(zip(aucs, nf))]
    for i, j in itertools.combinations(range(len(rows)), 2):
        if abs(rows[i][0] - rows[j][0]) <= 0.01 and rows[j][1] < rows[i][1]:
            rows[i], rows[j] = rows[j], rows[i]
    return [r[2] for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 6)), min_size=0, max_size=25))
def test_tiebreak_pass_equals_plain_loop(pairs):
    pairs = sorted(pairs, key=lambda p: (-p[0], p[1]))
    m = np.array([p[0] / 1000 for p in pairs])
    f = np.array([p[1] for p in pairs], dtype=int)
    assert board.swap_pass(m, f).tolist() == brute_swap(m.tolist(), f.tolist())


def test_tiebreak_frame(spark):
    df = spark.createDataFrame(
        [(1, 20, 0.900), (2, 5, 0.895), (3, 2, 0.889), (4, 1, 0.5)], "experiment_id bigint, n_features int, oot_roc_auc double"
    )
    got = [r["experiment_id"] for r in board.leaderboard_tiebreak(df).orderBy("rank").collect()]
    assert got == [df.collect()[i]["experiment_id"] for i in brute_swap([0.900, 0.895, 0.889, 0.5], [20, 5, 2, 1])]


def test_prune_order():
    cols = ["a", "b", "c"]
    m = [[1, 0.99, 0.1], [0.99, 1, 0.97], [0.1, 0.97, 1]]
    # b loses to a, and stays dropped without comparing c
    assert stats.prune_correlated(cols, m, {"a": 1, "b": 0.5, "c": 0.9}) == ["a", "c"]
    # a loses to b; then b loses to c
    assert stats.prune_correlated(cols, m, {"a": 0.1, "b": 0.5, "c": 0.9}) == ["c"]
    # equal IV keeps the first
    assert stats.prune_correlated(cols, m, {"a": 1, "b": 1, "c": 1}) == ["a", "c"]


def test_f_tail():
    # 95% points of F(1, d)
    for d, crit in ((10, 4.964603), (60, 4.001191), (1000, 3.850775)):
        assert math.isclose(stats.f_upper_tail(crit, d), 0.05, rel_tol=1e-5)
    assert stats.f_upper_tail(0.0, 10) == 1.0


def test_correlation_fill_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 6.0, 5.0)], "a double, b double, k double")
    zero = {(r["feature_a"], r["feature_b"]): r["r"] for r in stats.corr_matrix(df, ["a", "b", "k"]).collect()}
    assert math.isclose(zero["a", "b"], np.corrcoef([1, 2, 3], [2, 0, 6])[0, 1], abs_tol=1e-6)
    assert zero["k", "k"] is None and zero["a", "k"] is None and zero["a", "a"] == 1.0
    mean = {(r["feature_a"], r["feature_b"]): r["r"] for r in stats.corr_matrix(df, ["a", "b"], nulls="mean").collect()}
    assert math.isclose(mean["a", "b"], np.corrcoef([1, 2, 3], [2, 4, 6])[0, 1], abs_tol=1e-6)


def test_duplicates_wide_and_narrow_agree(spark):
    df = spark.range(1000).select(*[(F.col("id") % 700 * i).alias(f"c{i}") for i in range(20)])
    wide = quality.duplicate_rows(df).first()
    assert wide["duplicate_rows"] == 600 and wide["n_rows"] == 1000
    assert quality.duplicate_rows(df, ["c1"]).first()["duplicate_rows"] == 600
    assert quality.duplicate_rows(df.where("id < 0"), ["c1"]).first()["duplicate_rows"] == 0


def test_normalise_constant_and_ranks(spark):
    df = spark.createDataFrame([("m", "F", "a", 2.0), ("m", "F", "b", 2.0), ("n", "F", "a", 1.0), ("n", "F", "b", 3.0)],
                               "method string, grp string, feature string, score double")
    got = {(r["method"], r["feature"]): r["norm"] for r in selection.fs_normalise(df).collect()}
    assert got == {("m", "a"): 0.5, ("m", "b"): 0.5, ("n", "a"): 0.0, ("n", "b"): 1.0}
    ranks = {(r["method"], r["feature"]): r["avg_rank"] for r in selection.avg_rank(df).collect()}
    assert ranks["m", "a"] == ranks["m", "b"] == 1.5 and ranks["n", "b"] == 1.0


def test_votes_fall_back(spark):
    sets = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "x")], "feature_set string, feature string")
    assert [r["feature"] for r in selection.fs_vote_consensus(sets).collect()] == ["x"]
    fell = selection.fs_vote_consensus(sets, fallback="A")
    assert sorted(r["feature"] for r in fell.collect()) == ["x", "y"]


def test_method_rules(spark):
    df = spark.createDataFrame(
        [("IV (WoE)", "Filter", "a", 0.02), ("IV (WoE)", "Filter", "b", 0.01), ("Random Forest", "Tree-Based", "a", 0.7),
         ("Random Forest", "Tree-Based", "b", 0.3)], "method string, grp string, feature string, score double")
    got = {r["method"]: r for r in selection.method_summary(df).collect()}
    assert got["IV (WoE)"]["n_selected"] == 1 and got["Random Forest"]["n_selected"] == 1
    assert got["Random Forest"]["top_feature"] == "a"
    forced = selection.method_summary(df.withColumn("selected", F.lit(True)))
    assert {r["n_selected"] for r in forced.collect()} == {2}


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(3000), 2)
    y = (rng.random(3000) < s).astype(int)
    g = rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, g)], "label int, score double, g int")
    return df.cache(), y, s


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))


def test_auc_and_ks_brute_force(scores):
    df, y, s = scores
    auc = metrics.roc_auc(df, "label", "score").first()["roc_auc"]
    assert math.isclose(auc, brute_auc(y, s), abs_tol=1e-6)
    flipped = metrics.roc_auc(df.withColumn("score", -F.col("score")), "label", "score").first()["roc_auc"]
    assert math.isclose(auc + flipped, 1.0, abs_tol=2e-6)
    ks = max(abs((s[y == 1] >= t).mean() - (s[y == 0] >= t).mean()) for t in np.unique(s))
    assert math.isclose(metrics.ks_stat(df, "label", "score").first()["ks"], ks, abs_tol=1e-6)


def test_range_partitioned_curve_equals_window(scores):
    df, _, _ = scores
    one = {tuple(r) for r in metrics.score_curve(df, "label", "score", ["g"]).collect()}
    many = {tuple(r) for r in metrics.score_curve(df, "label", "score", ["g"], parts=9).collect()}
    assert one == many and len(one) > 150


def test_metrics_agree_with_single_ones(scores):
    df, _, _ = scores
    whole = metrics.metrics_by_split(df.withColumn("s", F.lit(1)), "label", "score", ["s"], dp=6).first()
    assert whole["roc_auc"] == metrics.roc_auc(df, "label", "score").first()["roc_auc"]
    assert whole["pr_auc"] == metrics.pr_auc(df, "label", "score").first()["pr_auc"]
    assert whole["f1"] == metrics.threshold_metrics(df, "label", "score").first()["f1"]


def test_metrics_undefined_cases(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    assert metrics.roc_auc(df, "label", "score").first()["roc_auc"] is None
    row = metrics.threshold_metrics(df, "label", "score").first()
    assert row["precision"] == row["recall"] == row["f1"] == 0.0 and row["specificity"] == 1.0


def test_detect_target_and_alignment():
    assert governance.detect_target(["a", "Label"]) == "Label"
    assert governance.detect_target(["default", "target"]) == "target"
    assert governance.detect_target(["a"]) is None
    cols = ["x", "seg_A", "seg_B", "y"]
    assert governance.align_columns(cols, ["seg", "x", "none"], "y") == ["seg_A", "seg_B", "x", "y"]


def test_classification_rules(spark):
    df = spark.range(100).select(
        F.col("id").alias("user_id"), (F.col("id") % 2).alias("flag"), (F.col("id") % 3).alias("width"),
        (F.col("id") % 50).alias("num"), (F.col("id") % 4).cast("string").alias("cat"), (F.col("id") * 1.5).alias("price"),
        F.lit(None).cast("string").alias("nothing"), (F.col("id") % 2).alias("y"),
    )
    got = {r["column"]: r["col_type"] for r in governance.schema_classify(df, "y").collect()}
    assert got == {"user_id": "identifier", "flag": "boolean", "width": "datetime", "num": "numeric", "cat": "categorical",
                   "price": "identifier", "nothing": "constant", "y": "target"}
    plain = {r["column"]: r["col_type"] for r in governance.schema_classify(df, "y", name_rules=False, float_ids=False).collect()}
    assert plain["width"] == "categorical" and plain["price"] == "numeric" and plain["user_id"] == "identifier"


def test_histogram_constant_and_nan(spark):
    df = spark.createDataFrame([(1.0, 5.0), (float("nan"), 5.0), (3.0, 5.0), (None, 5.0)], "a double, k double")
    got = profile.histogram(df, ["a", "k"], bins=2).collect()
    assert {(r["column"], r["bin"]): r["count"] for r in got} == {("a", 0): 1, ("a", 1): 1, ("k", 0): 0, ("k", 1): 4}


def test_numeric_stats_sketch_close(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    exact, sketch = profile.numeric_stats(df, ["x"]).first(), profile.numeric_stats(df, ["x"], exact=False).first()
    assert exact["median"] == 500.0 and abs(sketch["median"] - 500.0) <= 1
    assert exact["std"] == sketch["std"]
