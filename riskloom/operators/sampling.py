"""Samples, folds, splits and class weights.

Reproducible choices order rows by (md5 of seed and id, id).  A prefix of that
order is found through exact cut points, so rows are filtered where they are:
no sort, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.functions.scalar import half_up, hash_order, quoted, ratio
from riskloom.operators.kernels import Cut, ntile_column, ntile_ranks, ordered_cuts


def sample_bernoulli(
    df: DataFrame, n: int, seed: int = 42, columns: Sequence[str] | None = None, n_rows: int | None = None
) -> DataFrame:
    """Each row with probability n / rows; columns are projected before sampling."""
    if columns:
        df = df.select(*[quoted(c) for c in columns])
    n_rows = df.count() if n_rows is None else n_rows
    return df.sample(withReplacement=False, fraction=min(1.0, n / max(n_rows, 1)), seed=seed)


def _hash_cuts(
    df: DataFrame, ident: str, seed: int, classes: dict[str, Column], ranks: dict[str, Sequence[int]],
    counts: dict[str, int], **options,
) -> dict[str, dict[int, Cut]]:
    """Cut points of the hash order within each class (class name -> membership condition)."""
    h = hash_order(quoted(ident), seed)
    keyed = df.select(quoted(ident).alias("_id"), *[F.when(cond, h).alias(name) for name, cond in classes.items()])
    return ordered_cuts(keyed, ranks, counts, "_id", **options)


def _class_sizes(df: DataFrame, classes: dict[str, Column]) -> dict[str, int]:
    row = df.agg(*[F.count(F.when(cond, True)).alias(name) for name, cond in classes.items()]).first()
    return row.asDict()


def _two_classes(target: str) -> dict[str, Column]:
    y = F.coalesce(quoted(target).cast("double"), F.lit(0.0))
    return {"pos": y == 1.0, "neg": y != 1.0}


def sample_hash(df: DataFrame, n: int, ident: str, seed: int = 42, **options) -> DataFrame:
    """Exactly min(n, rows) rows without replacement; the same rows on every run."""
    everything = {"all": F.lit(True)}
    sizes = _class_sizes(df, everything)
    if n >= sizes["all"]:
        return df
    cut = _hash_cuts(df, ident, seed, everything, {"all": [n]}, sizes, **options)["all"][n]
    return df.where(cut.covers(hash_order(quoted(ident), seed), quoted(ident)))


def undersample_condition(
    df: DataFrame, target: str, ident: str, ratio_neg: float = 3.0, seed: int = 42, **options
) -> Column:
    """Row condition that keeps all positives and exactly min(ratio x positives, negatives) negatives."""
    classes = _two_classes(target)
    sizes = _class_sizes(df, classes)
    keep = min(int(sizes["pos"] * ratio_neg), sizes["neg"])
    if keep == sizes["neg"]:
        return F.lit(True)
    if keep == 0:
        return classes["pos"]
    cut = _hash_cuts(df, ident, seed, {"neg": classes["neg"]}, {"neg": [keep]}, sizes, **options)["neg"][keep]
    return classes["pos"] | cut.covers(hash_order(quoted(ident), seed), quoted(ident))


def undersample_hash(
    df: DataFrame, target: str, ident: str, ratio_neg: float = 3.0, seed: int = 42, **options
) -> DataFrame:
    return df.where(undersample_condition(df, target, ident, ratio_neg, seed, **options))


def undersample_fraction(df: DataFrame, target: str, ratio_neg: float = 2.0, seed: int = 42) -> DataFrame:
    """Approximate form in one pass: negatives kept with probability min(1, ratio x pos / neg)."""
    sizes = _class_sizes(df, _two_classes(target))
    share = min(1.0, ratio_neg * sizes["pos"] / max(sizes["neg"], 1))
    y = F.coalesce(quoted(target).cast("int"), F.lit(0))
    return df.withColumn("_y", y).sampleBy("_y", {1: 1.0, 0: share}, seed).drop("_y")


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights n / (2 n_c) per class (6 dp)."""
    y = F.when(F.coalesce(quoted(target).cast("double"), F.lit(0.0)) == 1.0, 1).otherwise(0)
    sizes = df.groupBy(y.cast("bigint").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))  # two rows
    return sizes.withColumn("weight", half_up(ratio(total, F.lit(2.0) * F.col("n")), 6))


def with_class_weight(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    sizes = _class_sizes(df, _two_classes(target))
    n = sizes["pos"] + sizes["neg"]
    w = {c: n / (2.0 * s) if s else 1.0 for c, s in sizes.items()}
    return df.withColumn(name, F.when(_two_classes(target)["pos"], F.lit(w["pos"])).otherwise(F.lit(w["neg"])))


def fold_column(df: DataFrame, target: str, ident: str, k: int = 3, seed: int = 42, **options) -> Column:
    """Fold 0..k-1 as an expression: equal-count slices of the hash order within each class."""
    classes = _two_classes(target)
    sizes = _class_sizes(df, classes)
    ranks = {c: ntile_ranks(n, k) for c, n in sizes.items()}
    cuts = _hash_cuts(df, ident, seed, classes, ranks, sizes, **options)
    h, tie = hash_order(quoted(ident), seed), quoted(ident)

    def slices(c: str) -> Column:
        return ntile_column(h, tie, cuts.get(c, {}), sizes[c], k) if sizes[c] else F.lit(1)

    fold = F.when(classes["pos"], slices("pos")).otherwise(slices("neg"))
    return (fold - F.lit(1)).cast("int")


def kfold_assign(df: DataFrame, target: str, ident: str, k: int = 3, seed: int = 42, **options) -> DataFrame:
    return df.withColumn("fold", fold_column(df, target, ident, k, seed, **options))


def stratified_split(
    df: DataFrame, target: str, ident: str, test_share: float = 0.3, seed: int = 42, **options
) -> DataFrame:
    """Add ``part``: 'train' for the first round((1 - share) n_c) rows of each class in hash order, else 'test'."""
    classes = _two_classes(target)
    sizes = _class_sizes(df, classes)
    ranks = {c: int((1.0 - test_share) * n + 0.5) for c, n in sizes.items()}
    cuts = _hash_cuts(df, ident, seed, classes, {c: [r] for c, r in ranks.items()}, sizes, **options)
    h, tie = hash_order(quoted(ident), seed), quoted(ident)
    train = F.lit(False)
    for c, cond in classes.items():
        if ranks[c] in cuts.get(c, {}):
            train = train | (cond & cuts[c][ranks[c]].covers(h, tie))
    return df.withColumn("part", F.when(train, "train").otherwise("test"))


def split_stats(df: DataFrame, group: str, target: str, folds: int = 5, train: str = "Train") -> DataFrame:
    """Rows and classes per split, share of the total, Train imbalance, and classes per fold."""
    y = F.coalesce(quoted(target).cast("int"), F.lit(0))
    per = df.groupBy(quoted(group).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).cast("bigint").alias("positives")
    )
    w = W.partitionBy(F.lit(0))  # one row per split from here on
    n, p = F.sum("n").over(w), F.sum("positives").over(w)
    odds = ratio(F.col("n") - F.col("positives"), F.greatest(F.col("positives"), F.lit(1).cast("bigint")))
    return per.select(
        "split",
        "n",
        "positives",
        (F.col("n") - F.col("positives")).alias("negatives"),
        half_up(ratio(F.col("n"), n) * F.lit(100.0), 4).alias("pct"),
        half_up(F.max(F.when(F.col("split") == train, odds)).over(w), 6).alias("train_imbalance"),
        F.floor(p / F.lit(folds)).alias("positives_per_fold"),
        F.floor((n - p) / F.lit(folds)).alias("negatives_per_fold"),
    )
