"""Model-based feature scores, trained with ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.scalar import hash_order, quoted
from riskloom.operators import growth, joint
from riskloom.operators.joint import Rows
from riskloom.operators.kernels import quantile_edges, union_all, with_row_number
from riskloom.operators.metrics import metrics_from_histogram, score_histogram
from riskloom.operators.rankings import Scores, ranking_metrics
from riskloom.operators.sampling import kfold_assign, stratified_split, with_class_weight
from riskloom.operators.selection import (
    fs_both,
    fs_lr_only,
    fs_tree_only,
    fs_vote_consensus,
    score_rows,
    top_names,
)
from riskloom.operators.stats import anova_f, fs_corr_prune, fs_variance, point_biserial, with_anova_p
from riskloom.operators.transforms import fit_scaler, scale_expr
from riskloom.operators.woe import Bins, fit_bins, information_value, mutual_information
from riskloom.sources.scratch import materialise, scratch_path, small_table


def model_frame(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    scaler: str = "none",
    keep: Sequence[str] = (),
    params: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """(keep..., label, features): NULL as 0, scaled by expression, assembled."""
    filled = df.select(
        *[quoted(k) for k in keep],
        F.coalesce(quoted(target).cast("double"), F.lit(0.0)).alias("label"),
        *[F.coalesce(quoted(c).cast("double"), F.lit(0.0)).alias(c) for c in features if c not in keep],
    )
    if params is None and scaler != "none":
        params = fit_scaler(filled, features, scaler)
    exprs = [(scale_expr(c, params[c]) if params else quoted(c)).alias(f"_x{i}") for i, c in enumerate(features)]
    wide = filled.select(*[quoted(k) for k in keep], "label", *exprs)
    out = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(features))], outputCol="features").transform(wide)
    return out.select(*[quoted(k) for k in keep], "label", "features")


def _scores(df: DataFrame, features: Sequence[str], values: Sequence[float]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return small_table(df.sparkSession, rows, "feature string, score double")


def logistic(c: float, l1_ratio: float, n: int, max_iter: int = 100) -> LogisticRegression:
    """C multiplies the summed loss; Spark's penalty sits beside the mean loss, hence 1 / (C n)."""
    return LogisticRegression(
        regParam=1.0 / (c * max(n, 1)),
        elasticNetParam=l1_ratio,
        maxIter=max_iter,
        standardization=False,
        weightCol="weight",
    )


def _training(df: DataFrame, features: Sequence[str], target: str, scaler: str, keep: Sequence[str] = ()) -> DataFrame:
    return with_class_weight(model_frame(df, features, target, scaler, keep), "label")


def fs_logistic(
    df: DataFrame, features: Sequence[str], target: str, c: float, l1_ratio: float, max_iter: int = 100
) -> DataFrame:
    """|coefficient| of a balanced logistic model on standardised features."""
    train = _training(df, features, target, "standard").persist()
    model = logistic(c, l1_ratio, train.count(), max_iter).fit(train)
    train.unpersist()
    return _scores(df, features, [abs(x) for x in model.coefficients.toArray()])


def fs_lr_l1(df: DataFrame, features: Sequence[str], target: str, c: float = 0.1, **options) -> DataFrame:
    return fs_logistic(df, features, target, c, 1.0, **options)


def fs_lr_l2(df: DataFrame, features: Sequence[str], target: str, c: float = 1.0, **options) -> DataFrame:
    return fs_logistic(df, features, target, c, 0.0, **options)


def fs_lr_en(df: DataFrame, features: Sequence[str], target: str, c: float = 0.5, **options) -> DataFrame:
    return fs_logistic(df, features, target, c, 0.5, **options)


def sparsity_pct(scores: DataFrame, zero: float = 1e-6) -> DataFrame:
    """Share of coefficients a sparse model set to zero, in percent."""
    return scores.agg(
        (F.lit(100.0) * F.avg(F.when(F.col("score") > zero, 0.0).otherwise(1.0))).alias("sparsity_pct")
    )


def fs_lr_l1_cv(
    df: DataFrame, features: Sequence[str], target: str, ident: str, n_cs: int = 10, folds: int = 3,
    max_iter: int = 100, seed: int = 42, parallelism: int = 4,
) -> DataFrame:
    """L1 with C chosen among 1e-4..1e4 by ROC AUC over stratified folds; carries the chosen C.

    All fits of the search share their passes over one written table, and all folds are
    scored in one; AUC is exact, and of equal means the smallest C wins.  The model of
    the chosen C is fitted by ``pyspark.ml``.  ``parallelism`` has no effect any more.
    """
    names = [f"x{k}" for k in range(len(features))]
    filled = materialise(
        df.select(
            quoted(ident).alias("id"),
            F.coalesce(quoted(target).cast("double"), F.lit(0.0)).alias("label"),
            *[F.coalesce(quoted(c).cast("double"), F.lit(0.0)).alias(n) for c, n in zip(features, names)],
        ),
        "cv-input",
    )
    params = fit_scaler(filled, names)
    centre, width = tuple(params[c][0] for c in names), tuple(params[c][1] for c in names)
    table = materialise(kfold_assign(filled, "label", "id", folds, seed).select("label", "fold", *names), "cv")
    weights = _balanced(table)
    rows = table.count()
    n = rows * (folds - 1) // folds  # rows of one fit
    cs = [10 ** (-4 + 8 * i / max(n_cs - 1, 1)) for i in range(n_cs)]
    columns = tuple(range(len(features)))
    fits = [joint.Linear(columns, centre, width, Rows("fold", fold, weights), 1.0 / (c * max(n, 1)), 1.0) for fold in range(folds) for c in cs]
    betas = joint.fit_linear(table, fits, rounds=max_iter)

    def scores(batch: pa.RecordBatch) -> Scores:
        x, positive, at = joint.features_of(batch, columns), joint.numbers(batch, "label") == 1, joint.numbers(batch, "fold")
        for k, (fit, beta) in enumerate(zip(fits, betas)):
            own = at == fit.rows.held_out
            yield k, joint.linear_scores(x[own], fit, beta), positive[own]

    found = {r["at"]: r["roc_auc"] or 0.0 for r in ranking_metrics(table, scores, rows, dp=12).collect()}  # a row per fit
    mean = [sum(found.get(fold * len(cs) + i, 0.0) for fold in range(folds)) / folds for i in range(len(cs))]
    best = max(range(len(cs)), key=lambda i: mean[i])
    train = _training(filled, names, "label", "standard").persist()
    model = logistic(cs[best], 1.0, rows, max_iter).fit(train)
    train.unpersist()
    return _scores(df, features, [abs(x) for x in model.coefficients.toArray()]).withColumn("best_c", F.lit(float(cs[best])))


def boosted(
    rounds: int = 100, depth: int = 4, rate: float = 0.1, subsample: float = 0.8, min_leaf: int = 20, seed: int = 42
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, minInstancesPerNode=min_leaf, seed=seed
    )


def _forest(features: Sequence[str], rows: Rows, trees: int, depth: int, min_leaf: int, subsample: float, seed: int) -> growth.Ensemble:
    few = max(1, math.ceil(math.sqrt(len(features))))
    return growth.Ensemble(
        tuple(range(len(features))), rows, trees, depth, min_leaf, bag="poisson", share=subsample, features_a_node=few, seed=seed
    )


def fs_rf(
    df: DataFrame, features: Sequence[str], target: str,
    trees: int = 200, depth: int = 8, min_leaf: int = 20, subsample: float = 0.6, seed: int = 42,
) -> DataFrame:
    """Mean decrease in impurity of a balanced random forest, without splits that change no prediction; every tree that splits counts alike.

    Rows are numbered as they are written, and bags follow those numbers, so copies of a
    row are drawn apart.  A row of the written table is its bins, whatever the number of trees.
    """
    table, _ = binned_frame(df, features, target, None)
    fit = _forest(features, Rows("fold", None, _balanced(table)), trees, depth, min_leaf, subsample, seed)
    trees_of = [growth.pruned(t) for t in growth.grow(table, [fit], [0.0])[0]]
    gain = sum((_shares(growth.importances(fit, [t])["gain"]) for t in trees_of), np.zeros(len(features)))
    return _scores(df, features, _shares(gain))


def _shares(values: np.ndarray) -> np.ndarray:
    return values / (values.sum() or 1.0)


def fs_gbt(df: DataFrame, features: Sequence[str], target: str, **options) -> DataFrame:
    # not cached here: the fit keeps rows of its own, and both together outgrow the executors
    model = boosted(**options).fit(model_frame(df, features, target))
    return _scores(df, features, model.featureImportances.toArray())


def tree_nodes(model, df: DataFrame) -> DataFrame:
    """Node table of a fitted tree ensemble, read from its saved form."""
    path = scratch_path(df.sparkSession, "trees")
    model.write().save(path)
    return df.sparkSession.read.parquet(f"{path}/data")


def fs_gbt_splits(df: DataFrame, features: Sequence[str], target: str, **options) -> DataFrame:
    """Split count and total gain per feature over all boosted trees; features never used score 0."""
    model = boosted(**options).fit(model_frame(df, features, target))
    used = (
        tree_nodes(model, df)
        .select(F.col("nodeData.split.featureIndex").alias("i"), F.col("nodeData.gain").alias("gain"))
        .where(F.col("i") >= 0)
        .groupBy("i")
        .agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
    )
    names = small_table(df.sparkSession, list(enumerate(features)), "i int, feature string")
    return names.join(used, "i", "left").select(
        "feature",
        F.coalesce("splits", F.lit(0)).cast("bigint").alias("splits"),
        F.coalesce("gain", F.lit(0.0)).alias("gain"),
    )


def binned_frame(
    df: DataFrame, features: Sequence[str], target: str, ident: str | None, bins: int = growth.BINS, keep: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, list[float]]]:
    """A written table of bins for ``growth``, NULL as 0, every row in the one sampling ``fold``; and the cuts by feature."""
    filled = df.select(
        *[quoted(c) for c in keep],
        (F.monotonically_increasing_id() if ident is None else F.xxhash64(quoted(ident))).alias("key"),
        F.lit(0).alias("fold"),
        F.coalesce(quoted(target).cast("double"), F.lit(0.0)).alias("label"),
        *[F.coalesce(quoted(c).cast("double"), F.lit(0.0)).alias(f"x{k}") for k, c in enumerate(features)],
    )
    names = [f"x{k}" for k in range(len(features))]
    edges = quantile_edges(filled, names, bins)
    table = growth.with_bins(filled, [np.array(edges[n], float) for n in names], "key").select(*[quoted(c) for c in keep], "label", "fold", "bins", "row_key")
    return materialise(table, "binned"), {c: edges[n] for c, n in zip(features, names)}


def _balanced(table: DataFrame) -> tuple[float, float]:
    n = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}  # two rows
    total, neg, pos = sum(n.values()), n.get(0.0, 0), n.get(1.0, 0)
    return (total / (2 * neg), total / (2 * pos)) if neg and pos else (1.0, 1.0)


def fs_extra_trees(
    df: DataFrame, features: Sequence[str], target: str, ident: str,
    trees: int = 200, depth: int = 8, min_leaf: int = 20, seed: int = 42,
) -> DataFrame:
    """Mean decrease in impurity of balanced extremely randomised trees: one hashed threshold per node and feature.

    Scores sum to 1.  Thresholds are drawn among the cuts of ``growth.BINS`` equal-count bins.
    """
    table, _ = binned_frame(df, features, target, ident)
    rows = Rows("fold", None, _balanced(table))
    few = max(1, round(math.sqrt(len(features))))
    fit = growth.Ensemble(tuple(range(len(features))), rows, trees, depth, min_leaf, features_a_node=few, random_cuts=True, seed=seed)
    gain = growth.importances(fit, growth.grow(table, [fit], [0.0])[0])["gain"]
    return _scores(df, features, gain / (gain.sum() or 1.0))


def fs_boosted(
    df: DataFrame, features: Sequence[str], target: str, ident: str,
    rounds: int = 100, depth: int = 4, rate: float = 0.1, lam: float = 1.0, min_leaf: int = 20, share: float = 0.8, seed: int = 42,
) -> DataFrame:
    """gain, splits and cover (Hessian sum) per feature of second-order boosted trees; features never used score 0."""
    table, _ = binned_frame(df, features, target, ident)
    fit = growth.Ensemble(
        tuple(range(len(features))), Rows("fold"), rounds, depth, min_leaf, True, rate, lam, "bernoulli" if share < 1 else "none", share, seed=seed
    )
    mean = table.agg(F.avg("label")).first()[0] or 0.0
    start = math.log(mean / (1 - mean)) if 0 < mean < 1 else 0.0
    found = growth.importances(fit, growth.grow(table, [fit], [start])[0])
    rows = [(c, float(g), int(w), float(h)) for c, g, w, h in zip(features, found["gain"], found["weight"], found["cover"])]
    return small_table(df.sparkSession, rows, "feature string, gain double, splits bigint, cover double")


def positive_score(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn("score", vector_to_array("probability")[1])


def permutation_importance(
    holdout: DataFrame, fit: growth.Ensemble, trees: Sequence[growth.Tree], features: Sequence[str], repeats: int = 10, seed: int = 42
) -> DataFrame:
    """Mean drop in AUC when a feature is shuffled, floored at 0.

    ``holdout`` has (row_key, label, bins).  Rows get an index in hash order; a repeat
    takes every feature's shuffled bin from the row a fixed distance further round that
    order: one equi-join on a unique index, a row per repeat whatever the number of
    features.  A task then scores each feature's change from the trees that use it,
    and all (repeat, feature) AUCs come from one histogram.
    """
    p = len(features)
    base = holdout.select("row_key", "label", "bins", hash_order(F.col("row_key"), seed).alias("_h"))
    rows = materialise(with_row_number(base, [F.col("_h"), F.col("row_key")], "idx"), "holdout")
    n = rows.count()
    if n < 2:
        return _scores(holdout, features, [0.0] * p)
    step = max(1, (n - 1) // (repeats + 1))
    shifts = F.array(*[F.struct(F.lit(k).alias("rep"), F.lit(1 + (k * step) % (n - 1)).alias("by")) for k in range(repeats)])
    wanted = rows.select("label", "bins", "idx", F.explode(shifts).alias("s")).select(
        "label", "bins", F.col("s.rep").alias("rep"), ((F.col("idx") - 1 + F.col("s.by")) % n + 1).alias("donor")
    )
    donors = rows.select(F.col("idx").alias("donor"), F.col("bins").alias("donor_bins"))
    columns = list(fit.columns)
    used = [[k for k, t in enumerate(trees) if (t.feature == j).any()] for j in range(p)]
    boxes = [growth.boxes(t, p) for t in trees]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = growth.bins_of(batch.select(["bins"]))[:, columns]
            other = growth.bins_of(batch.select(["donor_bins"]).rename_columns(["bins"]))[:, columns]
            rep = batch.column(batch.schema.get_field_index("rep")).to_numpy(zero_copy_only=False)
            label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
            leaf = [t.node(own) for t in trees]
            whole = sum((t.value.take(at) for t, at in zip(trees, leaf)), np.zeros(len(own)))
            for j in range(-1, p):
                now = whole
                if j >= 0:
                    now, changed, bin_now = whole.copy(), own.copy(), other[:, j]
                    changed[:, j] = bin_now
                    for k in used[j]:  # rows that stay in the box of their leaf keep their value
                        low, high = boxes[k]
                        left = np.flatnonzero((bin_now <= low[j].take(leaf[k])) | (bin_now > high[j].take(leaf[k])))
                        value = trees[k].value
                        now[left] += value.take(trees[k].node(changed.take(left, axis=0))) - value.take(leaf[k].take(left))
                # rounded, so that equal scores summed in another order stay equal
                values = np.round(now / len(trees), 12)
                here = np.ones(len(rep), bool) if j >= 0 else rep == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rep[here].astype(np.int32) if j >= 0 else np.full(here.sum(), -1, np.int32)),
                        pa.array(np.full(here.sum(), j, np.int32)), pa.array(values[here]), pa.array(label[here]),
                    ],
                    names=["rep", "j", "score", "label"],
                )

    scored = wanted.join(donors, "donor").mapInArrow(score, "rep int, j int, score double, label double")
    table = materialise(score_histogram(scored, "label", "score", ["rep", "j"]), "permuted")
    aucs = metrics_from_histogram(table, ["rep", "j"], dp=9).select("rep", "j", "roc_auc").collect()  # repeats x features
    base_auc = next((r["roc_auc"] for r in aucs if r["rep"] < 0), None) or 0.0
    drops: list[list[float]] = [[] for _ in features]
    for r in aucs:
        if r["rep"] >= 0:
            drops[r["j"]].append(base_auc - (r["roc_auc"] or 0.0))
    return _scores(holdout, features, [max(0.0, math.fsum(d) / len(d)) if d else 0.0 for d in drops])


def fs_permutation(
    df: DataFrame, features: Sequence[str], target: str, ident: str, repeats: int = 10, test_share: float = 0.3,
    seed: int = 42, trees: int = 200, depth: int = 8, min_leaf: int = 20, subsample: float = 0.6,
) -> DataFrame:
    """Permutation importance of a balanced forest fitted on the stratified 70% part, measured on the rest."""
    parted = stratified_split(df.withColumn("_y", F.coalesce(quoted(target).cast("double"), F.lit(0.0))), "_y", ident, test_share, seed)
    table, _ = binned_frame(parted, features, "_y", ident, keep=["part"])
    train = table.where(F.col("part") == "train")
    few = max(1, round(math.sqrt(len(features))))
    fit = growth.Ensemble(
        tuple(range(len(features))), Rows("fold", None, _balanced(train)), trees, depth, min_leaf, bag="poisson", share=subsample, features_a_node=few, seed=seed
    )
    grown = growth.grow(train, [fit], [0.0])[0]
    return permutation_importance(table.where(F.col("part") == "test"), fit, grown, features, repeats, seed)


def score_table(
    df: DataFrame, features: Sequence[str], target: str, ident: str, bins: Bins | None = None,
    trees: int = 200, depth: int = 8, rounds: int = 100, repeats: int = 10, max_iter: int = 100,
) -> DataFrame:
    """Every selection method's scores in one long table (method, grp, feature, score)."""
    bins = bins or fit_bins(df, features, ident, 10, where=quoted(target).isNotNull())
    iv = information_value(df, features, target, ident, bins=bins)
    iv_of = {r["feature"]: r["iv"] for r in iv.collect()}  # one row per feature
    splits = fs_gbt_splits(df, features, target, rounds=rounds)
    filters, linear, trees_grp = "Filter", "Logistic Regression", "Tree-Based"
    return union_all(
        [
            score_rows(fs_variance(df, features), "Variance", filters),
            score_rows(iv, "IV (WoE)", filters, "iv"),
            score_rows(mutual_information(df, features, target, ident, bins=bins), "Mutual Info", filters, "mi"),
            score_rows(with_anova_p(anova_f(df, features, target)), "ANOVA F-Test", filters),
            score_rows(point_biserial(df, features, target), "Point-Biserial r", filters),
            score_rows(fs_corr_prune(df, features, iv_of), "Corr Pruning", filters),
            score_rows(fs_lr_l1(df, features, target, max_iter=max_iter), "LR L1 (Lasso)", linear),
            score_rows(fs_lr_l1_cv(df, features, target, ident, max_iter=max_iter), "LR L1-CV", linear),
            score_rows(fs_lr_l2(df, features, target, max_iter=max_iter), "LR L2 (Ridge)", linear),
            score_rows(fs_lr_en(df, features, target, max_iter=max_iter), "LR Elastic Net", linear),
            score_rows(fs_rf(df, features, target, trees=trees, depth=depth), "Random Forest", trees_grp),
            score_rows(fs_gbt(df, features, target, rounds=rounds), "Gradient Boost", trees_grp),
            score_rows(splits, "Boosted (gain)", trees_grp, "gain"),
            score_rows(splits, "Boosted (split)", trees_grp, "splits"),
            score_rows(
                fs_permutation(df, features, target, ident, repeats, trees=trees, depth=depth), "Permutation", trees_grp
            ),
        ]
    )


def feature_sets(
    df: DataFrame, features: Sequence[str], target: str, ident: str, top_n: int = 25, corr_above: float = 0.02,
    trees: int = 50, depth: int = 5, rounds: int = 50, fallback: Sequence[str] | None = None, least: int = 5,
) -> DataFrame:
    """The seven candidate sets as rows (feature_set, position, feature).

    The filter that keeps nothing, and the sparse model that keeps fewer than ``least``,
    give the ``fallback`` features, by default all.
    """
    spark = df.sparkSession
    features = list(features)
    fallback = features if fallback is None else list(fallback)
    top_n = min(top_n, len(features))

    def best(scores: DataFrame, col: str) -> list[str]:
        return [r["feature"] for r in scores.orderBy(F.desc(col), "feature").limit(top_n).collect()]

    def above(scores: DataFrame, bar: float) -> set[str]:
        return {r["feature"] for r in scores.where(F.col("score") > bar).select("feature").collect()}

    correlated = above(point_biserial(df, features, target), corr_above)
    sparse = above(fs_lr_l1(df, features, target), 1e-6)
    chosen = {
        "FS1_All": features,
        "FS2_IV_Filter": [c for c in features if c in correlated] or fallback,
        "FS3_MutualInfo": best(mutual_information(df, features, target, ident), "mi"),
        "FS4_L1_Lasso": [c for c in features if c in sparse] if len(sparse) >= least else fallback,
        "FS5_RandomForest": best(fs_rf(df, features, target, trees=trees, depth=depth, min_leaf=1, subsample=1.0), "score"),
        "FS6_Boosted": best(fs_gbt(df, features, target, rounds=rounds, depth=3, rate=0.2, subsample=1.0, min_leaf=1), "score"),
    }
    rows = [(s, i, c) for s, cols in chosen.items() for i, c in enumerate(cols, start=1)]
    sets = small_table(spark, rows, "feature_set string, position int, feature string")
    voted = fs_vote_consensus(
        sets.where(F.col("feature_set") != "FS1_All"), top_n, fallback="FS5_RandomForest"
    ).orderBy(F.desc("votes"), "feature").collect()
    rows += [("FS7_Consensus", i, r["feature"]) for i, r in enumerate(voted, start=1)]
    return small_table(spark, rows, "feature_set string, position int, feature string")


def selected_sets(ranked: DataFrame, n: int = 200) -> DataFrame:
    """The sets a finished selection gives: selected, both, tree only, LR only."""
    parts = {
        "Selected": top_names(ranked, "consensus", n),
        "BothConsensus": fs_both(ranked, n),
        "TreeOnly": fs_tree_only(ranked, n),
        "LROnly": fs_lr_only(ranked, n),
    }
    return union_all([d.select(F.lit(k).alias("feature_set"), "feature") for k, d in parts.items()])
