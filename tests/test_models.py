import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import grid, learners, selection

FEATURES = ["signal", "weak", "noise"]


@pytest.fixture(scope="module")
def toy(spark):
    """``signal`` nearly separates the classes, ``weak`` leans, ``noise`` does nothing."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    g = F.pmod(F.xxhash64("id", F.lit("n")), F.lit(1000)) / 1000.0
    y = (F.pmod(F.xxhash64("id", F.lit("y")), F.lit(10)) < 3).cast("int")
    df = spark.range(1500).select(
        "id", y.alias("y"), (y * 2.0 + h).alias("signal"), (y * 0.2 + g).alias("weak"),
        (F.pmod(F.xxhash64("id", F.lit("z")), F.lit(1000)) / 1000.0).alias("noise"),
        F.when(F.col("id") % 5 == 0, "Test").when(F.col("id") % 5 == 1, "OOT").otherwise("Train").alias("split"),
    )
    return df.cache()


def ranked(scores, col="score"):
    return [r["feature"] for r in scores.orderBy(F.desc(col)).collect()]


def test_linear_scores(toy):
    assert ranked(learners.fs_lr_l1(toy, FEATURES, "y"))[0] == "signal"
    assert ranked(learners.fs_lr_l2(toy, FEATURES, "y"))[0] == "signal"
    assert ranked(learners.fs_lr_en(toy, FEATURES, "y"))[0] == "signal"
    cv = learners.fs_lr_l1_cv(toy, FEATURES, "y", "id", n_cs=3, max_iter=10)
    assert ranked(cv)[0] == "signal" and cv.first()["best_c"] > 0


def test_tree_scores(toy):
    assert ranked(learners.fs_rf(toy, FEATURES, "y", trees=10, depth=4))[0] == "signal"
    assert ranked(learners.fs_gbt(toy, FEATURES, "y", rounds=3))[0] == "signal"
    splits = learners.fs_gbt_splits(toy, FEATURES, "y", rounds=3)
    assert splits.count() == 3 and ranked(splits, "gain")[0] == "signal"


def test_permutation(toy):
    scores = {r["feature"]: r["score"] for r in
              learners.fs_permutation(toy, FEATURES, "y", "id", repeats=2, trees=10, depth=4).collect()}
    assert scores["signal"] > 0.2 and scores["noise"] < 0.05 and min(scores.values()) >= 0.0


def test_score_table_to_consensus(toy):
    table = learners.score_table(toy, FEATURES, "y", "id", trees=5, depth=3, rounds=2, repeats=1, max_iter=5).cache()
    assert table.select("method").distinct().count() == 15
    best = selection.consensus(table).orderBy(F.desc("consensus")).first()
    assert best["feature"] == "signal" and best["votes"] >= 13
    assert selection.method_summary(table).count() == 15
    sets = grid.sets_from_frame(learners.selected_sets(selection.consensus(table), 2))
    assert "signal" in sets["Selected"]
    assert selection.selection_artifact(selection.consensus(table), 2).count() == 2


def test_feature_sets(toy):
    sets = grid.sets_from_frame(learners.feature_sets(toy, FEATURES, "y", "id", top_n=2, trees=5, depth=3, rounds=2))
    assert len(sets) == 7 and sets["FS1_All"] == FEATURES
    assert sets["FS3_MutualInfo"][0] == sets["FS5_RandomForest"][0] == sets["FS6_Boosted"][0] == "signal"


def test_combinations_and_ids(spark):
    combos = grid.combinations()
    assert len(combos) == (3 * 3 + 4) * 3
    sets = spark.createDataFrame([("A", 1, 3), ("B", 2, 5)], "feature_set string, position int, n_features int")
    rows = grid.experiment_grid(sets, combos).collect()
    assert sorted(r["experiment_id"] for r in rows) == list(range(1, 2 * len(combos) + 1))


def test_grid_ranks_and_survives_failures(toy, monkeypatch):
    combos = [c for c in grid.combinations() if c["model_id"] in ("LR_L2", "DT_d5", "GNB") and c["scaler_id"] in ("standard", "none")]
    real = grid.estimator

    def flaky(model_id, *a, **kw):
        if model_id == "GNB":
            raise RuntimeError("no such model " + "x" * 200)
        return real(model_id, *a, **kw)

    monkeypatch.setattr(grid, "estimator", flaky)
    run = grid.run_grid(toy, {"all": FEATURES, "weak": ["weak"]}, "y", "split", "id", combos, folds=2, sizes={"iters": 20, "trees": 5})
    rows = run.results.orderBy("rank").collect()
    curves = grid.family_curves(run)
    assert {r["model_family"] for r in curves.select("model_family").distinct().collect()} == {"Logistic Regression", "Decision Tree"}
    assert curves.agg(F.max("tpr")).first()[0] == 1.0
    assert [r["rank"] for r in rows] == list(range(1, len(combos) * 2 + 1))
    good = [r for r in rows if not r["error"]]
    assert len(good) == 12 and len(rows) == 18
    assert rows[0]["feature_set"] == "all" and rows[0]["oot_roc_auc"] > 0.95 and rows[0]["cv_roc_auc_mean"] > 0.9
    for r in rows:
        if r["error"]:
            assert len(r["error"]) <= 100 and r["oot_roc_auc"] == 0.0 and r["cv_roc_auc_mean"] == 0.0
    assert all(0.3 < r["oot_roc_auc"] < 0.9 for r in good if r["feature_set"] == "weak")


def test_grid_query_runs_the_whole_catalogue(spark, monkeypatch):
    from riskloom.plans import queries

    asked = {}

    def run(df, sets, target, group, ident, combos=None, **options):
        asked.update(sets=sets, combos=grid.combinations() if combos is None else combos, options=options)
        return grid.GridRun(df, df)

    names = [f"FS{k}" for k in range(1, 8)]
    frame = spark.createDataFrame([(n, 1, "cust_acctbal") for n in names], "feature_set string, position int, feature string")
    monkeypatch.setattr(queries.learners, "feature_sets", lambda *a, **kw: frame)
    monkeypatch.setattr(queries.grid, "run_grid", run)
    queries.q_grid_search(spark, "/root/testdata/sf0.001")
    assert list(asked["sets"]) == names and not asked["options"]
    assert asked["combos"] == grid.combinations() and len(asked["combos"]) == 39


def test_grid_search_query_ends(spark, monkeypatch):
    """The registered query over its real sets, with small ensembles: every experiment has a rank and no error."""
    from riskloom.plans import queries

    real = grid.estimator
    monkeypatch.setattr(grid, "estimator", lambda model_id, n, seed, **kw: real(model_id, n, seed, trees=2))
    sets = {"FS1_All": queries.PREDICTORS, "FS2": queries.PREDICTORS[::-1], "FS3": queries.PREDICTORS[:3]}
    rows = [(s, k, c) for s, cols in sets.items() for k, c in enumerate(cols)]
    frame = spark.createDataFrame(rows, "feature_set string, position int, feature string")
    monkeypatch.setattr(queries.learners, "feature_sets", lambda *a, **kw: frame)
    found = queries.q_grid_search(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 3 * 39 + 1)) and not any(r["error"] for r in found)
    by = {(r["feature_set"], r["model_id"], r["scaler"], r["imbalance"]): r["oot_roc_auc"] for r in found}
    assert all(v == by[("FS2", *k[1:])] for k, v in by.items() if k[0] == "FS1_All")  # the same columns in another order
    assert all(r["oot_roc_auc"] > 0.5 for r in found if r["feature_set"] == "FS1_All" and r["model_id"].startswith("LR_L2"))


def test_a_grid_of_failures_is_raised(toy, monkeypatch):
    def broken(*a, **kw):
        raise RuntimeError("nothing works")

    monkeypatch.setattr(grid, "estimator", broken)
    with pytest.raises(ValueError, match="nothing works"):
        grid.run_grid(toy, {"all": FEATURES}, "y", "split", "id", grid.combinations()[:2], folds=2)


def test_selected_sets_query(spark):
    from riskloom.plans import queries

    found = {r["feature_set"] for r in queries.q_selected_sets(spark, "/root/testdata/sf0.001").select("feature_set").distinct().collect()}
    assert "Selected" in found


def test_l1_search_shares_its_passes(spark, monkeypatch):
    """All fits of the search are made together, and C is chosen by exact AUC of the folds."""
    draw = np.random.default_rng(4)
    n = 300
    x = draw.normal(size=(n, 2))
    y = (x[:, 0] + 2 * draw.normal(size=n) > 0).astype(int)
    df = spark.createDataFrame([(k, float(x[k, 0]), float(x[k, 1]), int(y[k])) for k in range(n)], "id bigint, a double, b double, y int")
    asked, real = [], learners.joint.fit_linear
    monkeypatch.setattr(learners.joint, "fit_linear", lambda table, fits, **options: asked.append(len(fits)) or real(table, fits, **options))
    got = learners.fs_lr_l1_cv(df, ["a", "b"], "y", "id", n_cs=5).collect()
    assert asked == [15]
    fold = {r["id"]: r["fold"] for r in learners.kfold_assign(df, "y", "id", 3, 42).collect()}
    fold = np.array([fold[k] for k in range(n)])
    z, balance = (x - x.mean(axis=0)) / x.std(axis=0), np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    cs, mean = [1e-4, 1e-2, 1.0, 1e2, 1e4], []
    for c in cs:
        aucs = []
        for f in range(3):
            inside, w = fold != f, np.zeros(3)
            d = np.column_stack([np.ones(n), z])
            for _ in range(3_000):  # proximal gradient
                p = 1 / (1 + np.exp(-d[inside] @ w))
                w = w - d[inside].T @ (balance[inside] * (p - y[inside])) / balance[inside].sum()
                w[1:] = np.sign(w[1:]) * np.maximum(np.abs(w[1:]) - 1 / (c * (n * 2 // 3)), 0)
            s, t = d[~inside] @ w, y[~inside]
            pos, neg = s[t == 1], s[t == 0]
            aucs.append(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))
        mean.append(np.mean(aucs))
    assert {r["best_c"] for r in got} == {cs[int(np.argmax(np.round(mean, 12)))]}
