"""Feature score matrices: normalising, consensus, votes, set differences.

A score table is long: (method, grp, feature, score).  It has methods x features
rows, so its windows are small whatever the data behind the scores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.functions import labels
from riskloom.functions.scalar import half_up, quoted, ratio

# Each method's own rule for a selected feature.
METHOD_THRESHOLDS: dict[str, tuple[str, float]] = {
    "Variance": (">", 0.01),
    "IV (WoE)": (">=", 0.02),
    "Mutual Info": (">", 0.01),
    "Point-Biserial r": (">", 0.05),
    "LR L1 (Lasso)": (">", 1e-6),
    "LR L1-CV": (">", 1e-6),
    "LR L2 (Ridge)": (">=", 0.0),
    "LR Elastic Net": (">", 1e-6),
    "Random Forest": (">mean", 0.0),
    "Gradient Boost": (">mean", 0.0),
    "Boosted (gain)": (">", 0.0),
    "Boosted (split)": (">", 0.0),
    "Permutation": (">", 0.001),
    "Corr Pruning": (">", 0.5),
}
GROUPS = ("Filter", "Logistic Regression", "Tree-Based")


def fs_normalise(scores: DataFrame) -> DataFrame:
    """Min-max per method; a constant method (range below 1e-12) gives 0.5."""
    w = W.partitionBy("method")
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    norm = F.when(hi - lo < F.lit(1e-12), F.lit(0.5)).otherwise(F.try_divide(F.col("score") - lo, hi - lo))
    return scores.withColumn("norm", norm)


def avg_rank(scores: DataFrame) -> DataFrame:
    """Rank per method, 1 = highest score, ties share their average rank."""
    w = W.partitionBy("method").orderBy(F.desc("score"))
    ties = F.count(F.lit(1)).over(W.partitionBy("method", "score"))
    rank = F.rank().over(w).cast("double") + (ties.cast("double") - F.lit(1.0)) / F.lit(2.0)
    return scores.withColumn("avg_rank", rank)


def consensus(scores: DataFrame) -> DataFrame:
    """Mean normalised score over all methods, votes (norm >= 0.5), and the mean per method group; not rounded."""
    norm = fs_normalise(scores)

    def group_mean(name: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col("grp") == name, F.col("norm"))), F.lit(0.0))

    return norm.groupBy("feature").agg(
        F.avg("norm").alias("consensus"),
        F.count(F.when(F.col("norm") >= 0.5, True)).alias("votes"),
        F.count(F.lit(1)).alias("n_methods"),
        group_mean("Filter").alias("filter_score"),
        group_mean("Logistic Regression").alias("lr_score"),
        group_mean("Tree-Based").alias("tree_score"),
    )


def top_features(ranked: DataFrame, score: str, n: int = 200) -> DataFrame:
    """The n best features by a score; ties by name."""
    return ranked.orderBy(F.desc(score), "feature").limit(n)


def top_names(ranked: DataFrame, score: str, n: int) -> DataFrame:
    return top_features(ranked, score, n).select("feature")


def fs_both(ranked: DataFrame, n: int = 200) -> DataFrame:
    return top_names(ranked, "tree_score", n).intersect(top_names(ranked, "lr_score", n))


def fs_tree_only(ranked: DataFrame, n: int = 200) -> DataFrame:
    return top_names(ranked, "tree_score", n).subtract(top_names(ranked, "lr_score", n))


def fs_lr_only(ranked: DataFrame, n: int = 200) -> DataFrame:
    return top_names(ranked, "lr_score", n).subtract(top_names(ranked, "tree_score", n))


def fs_agreement(ranked: DataFrame, n: int = 200, limit: int | None = None) -> DataFrame:
    """Ranking table with the agreement label Both / Tree / LR / -; ``limit`` is the report length."""
    tree = top_names(ranked, "tree_score", n).withColumn("_t", F.lit(True))
    lr = top_names(ranked, "lr_score", n).withColumn("_l", F.lit(True))
    w = W.partitionBy(F.lit(0)).orderBy(F.desc("consensus"), "feature")  # one row per feature
    tagged = ranked.join(tree, "feature", "left").join(lr, "feature", "left")
    in_tree, in_lr = F.col("_t").isNotNull(), F.col("_l").isNotNull()
    label = labels.ladder([(in_tree & in_lr, "Both"), (in_tree, "Tree"), (in_lr, "LR")], "-")
    shown = [half_up(F.col(c), 6).alias(c) for c in ("consensus", "tree_score", "lr_score", "filter_score")]
    out = tagged.select(
        F.row_number().over(w).cast("bigint").alias("rank"),
        "feature", shown[0], "votes", "n_methods", *shown[1:],
        label.alias("agreement"),
    )
    return out if limit is None else out.where(F.col("rank") <= limit)


def fs_vote_consensus(
    sets: DataFrame, n: int = 25, min_votes: int = 2, fallback: str | None = None, least: int = 5
) -> DataFrame:
    """Features in at least ``min_votes`` sets, most votes first; the ``fallback`` set if fewer than ``least``.

    ``sets`` is long: (feature_set, feature).
    """
    votes = (
        sets.select("feature_set", "feature").distinct()
        .groupBy("feature").agg(F.count(F.lit(1)).alias("votes"))
        .where(F.col("votes") >= min_votes)
    )
    top = votes.orderBy(F.desc("votes"), "feature").limit(n)
    if fallback is not None and top.count() < least:
        counted = sets.where(F.col("feature_set") == fallback).select("feature").distinct()
        return counted.join(votes, "feature", "left").select("feature", F.coalesce("votes", F.lit(1)).alias("votes"))
    return top


def fs_quadrant(ranked: DataFrame) -> DataFrame:
    """Tree and linear consensus rescaled to [0, 1], the quadrant they fall in, and their mean."""
    w = W.partitionBy(F.lit(0))  # one row per feature

    def rescale(name: str) -> Column:
        lo, hi = F.min(name).over(w), F.max(name).over(w)
        return F.when(hi > lo, (F.col(name) - lo) / (hi - lo)).otherwise(F.col(name))

    base = ranked.select("feature", rescale("tree_score").alias("t"), rescale("lr_score").alias("l"))
    tree, lr = F.col("t") > 0.5, F.col("l") > 0.5
    return base.select(
        "feature",
        half_up(F.col("t"), 6).alias("tree_norm"),
        half_up(F.col("l"), 6).alias("lr_norm"),
        half_up((F.col("t") + F.col("l")) / F.lit(2.0), 6).alias("mean_norm"),
        labels.ladder([(tree & lr, "Consensus"), (tree, "Tree-dominant"), (lr, "LR-dominant")], "Neutral").alias("quadrant"),
    ).orderBy(F.desc("mean_norm"), "feature")


def fs_stability(scores: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Feature x method matrix: 1 where the normalised score is at least 0.5."""
    flag = F.when(F.col("norm") >= 0.5, 1).otherwise(0)
    return (
        fs_normalise(scores)
        .withColumn("_f", flag)
        .groupBy("feature")
        .pivot("method", list(methods))
        .agg(F.max("_f"))
        .na.fill(0)
    )


def method_summary(scores: DataFrame, thresholds: Mapping[str, tuple[str, float]] | None = None) -> DataFrame:
    """Per method: selected count by its own rule, top feature and score, mean score, non-zero count.

    A method without a rule selects every feature above its mean score; a boolean
    ``selected`` column (a p-value rule, say) wins over the rules where not NULL.
    """
    rules = METHOD_THRESHOLDS if thresholds is None else thresholds
    mean = F.avg("score").over(W.partitionBy("method"))
    picked = F.col("score") > F.col("_mean")
    for method, (op, value) in rules.items():
        if op == ">mean":
            continue
        hit = F.col("score") >= value if op == ">=" else F.col("score") > value
        picked = F.when(F.col("method") == method, hit).otherwise(picked)
    if "selected" in scores.columns:
        picked = F.coalesce(F.col("selected"), picked)
    top = F.min(F.struct((-F.col("score")).alias("neg"), F.col("feature").alias("feature")))
    return (
        scores.withColumn("_mean", mean)
        .groupBy("method", "grp")
        .agg(
            F.count(F.when(picked, True)).alias("n_selected"),
            top.alias("_top"),
            half_up(F.avg("score"), 6).alias("mean_score"),
            F.count(F.when(F.col("score") > 1e-9, True)).alias("n_nonzero"),
        )
        .select(
            "method", "grp", "n_selected",
            F.col("_top.feature").alias("top_feature"),
            half_up(-F.col("_top.neg"), 6).alias("top_score"),
            "mean_score", "n_nonzero",
        )
    )


def score_rows(frame: DataFrame, method: str, grp: str, score: str = "score") -> DataFrame:
    """Bring one method's (feature, score[, selected]) frame into the long score table."""
    known = F.col("selected") if "selected" in frame.columns else F.lit(None)
    return frame.select(
        F.lit(method).alias("method"), F.lit(grp).alias("grp"), "feature", quoted(score).cast("double").alias("score"),
        known.cast("boolean").alias("selected"),
    )


def selection_artifact(ranked: DataFrame, n: int = 200) -> DataFrame:
    """Selected features with rank and set memberships: the table later steps reload."""
    return fs_agreement(ranked, n).where(F.col("rank") <= n).withColumn(
        "vote_share", half_up(ratio(F.col("votes"), F.col("n_methods")), 6)
    )
