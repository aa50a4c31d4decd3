"""Every operator as a query over the driver tables: name -> function(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from riskloom.functions import scalar
from riskloom.functions.scalar import half_up, quoted
from riskloom.operators import (
    curves,
    descent,
    explain,
    governance,
    grid,
    growth,
    leaderboard as board,
    learners,
    metrics,
    neighbours,
    profile,
    quality,
    sampling,
    selection,
    sketches,
    stats,
    transforms,
    woe,
)
from riskloom.operators.joint import Rows
from riskloom.plans.fixtures import (
    CATEGORICAL,
    NUMERIC,
    PREDICTORS,
    fake_runs,
    fake_scores,
    feature_tables,
    perf,
    risk,
    scored,
    table,
)
from riskloom.operators.star import star_left_join
from riskloom.operators.kernels import union_all
from riskloom.sources.readers import input_size, read_delimited, read_lenient, read_parquet
from riskloom.sources.scratch import materialise, scratch_path, small_table
from riskloom.sources.sinks import load_artifact, save_artifact, write_csv
from riskloom.streaming import drift
from riskloom.streaming.serve import serve_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

IV_COLUMNS = ["li_qty_sum", "li_price_max", "ord_totalprice", "ord_price_gappy", "cust_acctbal", "drv_skewed"]
USELESS_COLUMNS = ["record_id", "funded", "sample_group", "li_cnt", "ord_totalprice", "ord_const", "cust_segment", "drv_skewed"]
SPEC_NUMERIC = ["li_qty_sum", "ord_price_gappy", "cust_acctbal", "drv_skewed", "drv_outlier"]
CORR_COLUMNS = ["li_qty_sum", "ord_totalprice", "ord_totalprice_x2", "ord_price_gappy", "cust_acctbal", "drv_skewed", "ord_const"]
GROUP_METHODS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
TOP = 10


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__.removeprefix("q_")] = fn
    return fn


def _r(df: DataFrame, dp: int = 6) -> DataFrame:
    """Round every double column, so float summing order does not show."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.select(*[half_up(quoted(c), dp).alias(c) if c in doubles else quoted(c) for c in df.columns])


# -- scans, schema ----------------------------------------------------------


@query
def q_scan_csv_nulls(spark, sf):
    key = F.col("c_custkey")
    text = table(spark, sf, "customer").select(
        key.cast("string").alias("c_custkey"),
        F.when(key % 5 == 0, "NA").when(key % 7 == 0, "null").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(key % 3 == 0, "N/A").when(key % 11 == 0, "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    path = scratch_path(spark, "csv")
    write_csv(text, path)
    return read_delimited(spark, path)


@query
def q_scan_csv_lenient(spark, sf):
    key = F.col("c_custkey")
    text = table(spark, sf, "customer").select(
        key.cast("string").alias("c_custkey"),
        F.when(key % 5 == 0, "bad").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(key % 3 == 0, "4x").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
    )
    path = scratch_path(spark, "csv")
    write_csv(text, path)
    schema = T.StructType().add("c_custkey", T.LongType()).add("c_acctbal", T.DoubleType()).add("c_nationkey", T.IntegerType())
    return read_lenient(spark, path, schema)


@query
def q_scan_parquet(spark, sf):
    return read_parquet(spark, f"{sf}/orders.parquet").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query
def q_schema_columns(spark, sf):
    return profile.schema_columns(governance.prohibited_guard(risk(spark, sf)), target="funded")


@query
def q_dataset_profile(spark, sf):
    return profile.dataset_profile(governance.prohibited_guard(risk(spark, sf)))


# -- projections, filters ---------------------------------------------------


@query
def q_prohibited_guard(spark, sf):
    return governance.prohibited_guard(risk(spark, sf))


@query
def q_drop_useless(spark, sf):
    df = risk(spark, sf, USELESS_COLUMNS, keep=True)
    return governance.drop_useless(df, governance.schema_classify(df, "funded"), "funded")


@query
def q_split_filter(spark, sf):
    return governance.split_filter(risk(spark, sf, ["record_id", "funded", "sample_group"]), "sample_group", "Train")


@query
def q_numeric_features(spark, sf):
    df = risk(spark, sf)
    wanted = ["li_cnt", "cust_segment", "no_such_column", "funded", "ord_price_gappy", "drv_skewed"]
    names = governance.numeric_features(df, wanted, "funded")
    return small_table(spark, list(enumerate(names, start=1)), "position bigint, feature string")


@query
def q_fill_zero(spark, sf):
    df = risk(spark, sf, ["record_id", "funded", "li_cnt", "ord_price_gappy"])
    return governance.fill_zero(df, ["funded", "li_cnt", "ord_price_gappy"])


@query
def q_align_features(spark, sf):
    df = risk(spark, sf, ["record_id", "funded", "cust_segment", "ord_price_gappy", "li_cnt"], keep=True)
    levels = transforms.fit_levels(df, ["cust_segment"])["cust_segment"]
    wide = transforms.one_hot(df, "cust_segment", levels)
    return governance.align_features(wide, ["record_id", "ord_price_gappy", "cust_segment", "no_such_column"], "funded")


# -- joins ------------------------------------------------------------------


@query
def q_star_left_join(spark, sf):
    return star_left_join(perf(spark, sf), feature_tables(spark, sf), "record_id")


@query
def q_corr_pairs(spark, sf):
    return stats.corr_pairs(risk(spark, sf, CORR_COLUMNS), CORR_COLUMNS)


@query
def q_experiment_grid(spark, sf):
    sets = fake_scores(spark, sf).groupBy(F.col("method").alias("feature_set")).agg(
        F.count(F.when(F.col("score") > 0, True)).alias("n_features")
    )
    by_name = W.partitionBy(F.lit(0)).orderBy("feature_set")  # one row per feature set
    return grid.experiment_grid(sets.withColumn("position", F.row_number().over(by_name)), grid.combinations())


# -- aggregates -------------------------------------------------------------


@query
def q_row_count(spark, sf):
    return profile.row_count(risk(spark, sf, ["record_id"]))


@query
def q_missing_counts(spark, sf):
    return profile.missing_counts(governance.prohibited_guard(risk(spark, sf)))


@query
def q_cardinality(spark, sf):
    return profile.cardinality(governance.prohibited_guard(risk(spark, sf, keep=True)))


@query
def q_cardinality_approx(spark, sf):
    return profile.cardinality(governance.prohibited_guard(risk(spark, sf)), exact=False)


@query
def q_profile_merged(spark, sf):
    """Profile of a table that came in four parts, from the merged sketches."""
    df = materialise(risk(spark, sf, ["record_id", *NUMERIC], keep=True))
    path = scratch_path(spark, "sketches")
    for k in range(4):
        sketches.add_part(df.where(F.col("record_id") % 4 == k), path, f"p{k}", NUMERIC)
    return sketches.merged_profile(sketches.read_parts(spark, path)).select("column", "n_rows", "n_missing", "n_unique", "mean", "std", "min", "max", "q25", "q50", "q75")


@query
def q_numeric_stats(spark, sf):
    return profile.numeric_stats(risk(spark, sf, ["record_id", *NUMERIC], keep=True), NUMERIC)


@query
def q_value_counts(spark, sf):
    return profile.value_counts(risk(spark, sf, ["drv_high_card"]), "drv_high_card")


@query
def q_target_distribution(spark, sf):
    return profile.target_distribution(risk(spark, sf, ["flagged"]), "flagged")


@query
def q_categorical_summary(spark, sf):
    return profile.categorical_summary(risk(spark, sf, CATEGORICAL), CATEGORICAL)


@query
def q_skew_kurtosis(spark, sf):
    return profile.skew_kurtosis(risk(spark, sf, NUMERIC), NUMERIC)


@query
def q_missing_severity(spark, sf):
    return profile.missing_severity(governance.prohibited_guard(risk(spark, sf)))


@query
def q_missing_summary(spark, sf):
    return profile.missing_summary(governance.prohibited_guard(risk(spark, sf)))


@query
def q_missing_top40(spark, sf):
    return profile.missing_severity(governance.prohibited_guard(risk(spark, sf))).select("column", "missing_pct").limit(40)


@query
def q_duplicate_rows(spark, sf):
    return quality.duplicate_rows(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    )


@query
def q_near_constant(spark, sf):
    return profile.near_constant(risk(spark, sf, CATEGORICAL), CATEGORICAL)


def _iv_table(spark, sf):
    return risk(spark, sf, ["record_id", "flagged", *IV_COLUMNS], keep=True)


@query
def q_woe_table(spark, sf):
    return woe.woe_table(_iv_table(spark, sf), IV_COLUMNS, "flagged", "record_id")


@query
def q_iv_numeric(spark, sf):
    return woe.information_value(_iv_table(spark, sf), IV_COLUMNS, "flagged", "record_id")


@query
def q_iv_ranking(spark, sf):
    return woe.iv_ranking(_iv_table(spark, sf), IV_COLUMNS, "flagged", "record_id")


@query
def q_leakage_flags(spark, sf):
    return woe.leakage_flags(_iv_table(spark, sf), IV_COLUMNS, "flagged", "record_id")


@query
def q_quality_score(spark, sf):
    df = risk(spark, sf, ["record_id", "flagged", "li_qty_sum", "ord_const", "ord_price_gappy", "cust_acctbal", "drv_high_card"], keep=True)
    features = ["li_qty_sum", "ord_price_gappy", "cust_acctbal"]
    return quality.quality_score(
        profile.missing_summary(df),
        quality.duplicate_rows(df),
        woe.leakage_flags(df, features, "flagged", "record_id"),
        governance.schema_classify(df, "flagged"),
    )


@query
def q_split_stats(spark, sf):
    return sampling.split_stats(risk(spark, sf, ["sample_group", "flagged"]), "sample_group", "flagged")


@query
def q_schema_classify(spark, sf):
    return governance.schema_classify(governance.prohibited_guard(risk(spark, sf, keep=True)), "funded")


@query
def q_schema_summary(spark, sf):
    df = governance.prohibited_guard(risk(spark, sf, keep=True))
    return governance.schema_summary(governance.schema_classify(df, "funded"))


@query
def q_corr_matrix(spark, sf):
    return stats.corr_matrix(risk(spark, sf, CORR_COLUMNS), CORR_COLUMNS)


def _variances(df):
    score = F.col("score")
    shown = F.when(score < 1000, half_up(score, 6)).otherwise(F.floor(score + F.lit(0.5)).cast("double"))
    return stats.fs_variance(df, PREDICTORS).withColumn("score", shown)


@query
def q_fs_variance(spark, sf):
    return _variances(risk(spark, sf, PREDICTORS))


@query
def q_fs_anova_f(spark, sf):
    scores = stats.anova_f(risk(spark, sf, ["flagged", *PREDICTORS]), PREDICTORS, "flagged")
    return scores.select("feature", half_up(F.col("score"), 4).alias("score"))


@query
def q_fs_anova_p(spark, sf):
    scores = stats.anova_f(risk(spark, sf, ["flagged", *PREDICTORS]), PREDICTORS, "flagged")
    return stats.with_anova_p(scores)


@query
def q_fs_point_biserial(spark, sf):
    return _r(stats.point_biserial(risk(spark, sf, ["flagged", *PREDICTORS]), PREDICTORS, "flagged"))


@query
def q_fs_mutual_info(spark, sf):
    return woe.mutual_information(_iv_table(spark, sf), IV_COLUMNS, "flagged", "record_id")


@query
def q_fs_chi_square(spark, sf):
    return stats.chi_square(risk(spark, sf, ["flagged", *CATEGORICAL]), CATEGORICAL, "flagged")


@query
def q_fs_corr_prune(spark, sf):
    df = risk(spark, sf, ["record_id", "flagged", *CORR_COLUMNS], keep=True)
    iv = woe.information_value(df, CORR_COLUMNS, "flagged", "record_id").collect()
    return stats.fs_corr_prune(df, CORR_COLUMNS, {r["feature"]: r["iv"] for r in iv})


@query
def q_class_counts(spark, sf):
    return stats.class_counts(risk(spark, sf, ["flagged"]), "flagged")


@query
def q_histogram(spark, sf):
    return profile.histogram(risk(spark, sf, NUMERIC, keep=True), NUMERIC, bins=30)


@query
def q_boxplot_stats(spark, sf):
    return profile.boxplot_stats(risk(spark, sf, NUMERIC, keep=True), NUMERIC)


@query
def q_psi(spark, sf):
    df = risk(spark, sf, ["record_id", "sample_group", *NUMERIC], keep=True)
    train = governance.split_filter(df, "sample_group", "Train")
    return woe.psi(train, governance.split_filter(df, "sample_group", "OOT"), NUMERIC, "record_id")


# -- windows, rankings, sets ------------------------------------------------


@query
def q_ntile_bins(spark, sf):
    df = risk(spark, sf, ["record_id", "ord_price_gappy"], keep=True)
    return woe.ntile_bins(df, "ord_price_gappy", "record_id").select("record_id", "bin")


@query
def q_ntile_bins_ties(spark, sf):
    df = risk(spark, sf, ["record_id", "li_cnt"], keep=True)
    return woe.ntile_bins(df, "li_cnt", "record_id").select("record_id", "bin")


@query
def q_cum_gains(spark, sf):
    return metrics.cum_gains(scored(spark, sf), "label", "score")


@query
def q_fs_normalise(spark, sf):
    return _r(selection.fs_normalise(fake_scores(spark, sf)))


@query
def q_avg_rank(spark, sf):
    return selection.avg_rank(fake_scores(spark, sf))


@query
def q_fs_method_summary(spark, sf):
    return selection.method_summary(fake_scores(spark, sf))


def _ranked_runs(spark, sf):
    return board.leaderboard(fake_runs(spark, sf))


@query
def q_leaderboard(spark, sf):
    return _ranked_runs(spark, sf).select("experiment_id", "n_features", "oot_roc_auc", "rank")


@query
def q_leaderboard_tiebreak(spark, sf):
    return board.leaderboard_tiebreak(fake_runs(spark, sf), by=["run_id"])


@query
def q_top3_per_dim(spark, sf):
    return board.top_per_group(_ranked_runs(spark, sf), ["feature_set", "model_family"])


@query
def q_best_per_family(spark, sf):
    return board.best_per_family(_ranked_runs(spark, sf)).select("model_family", "experiment_id", "oot_roc_auc", "rank")


@query
def q_best_experiment(spark, sf):
    return board.best_experiment(_ranked_runs(spark, sf)).select("experiment_id", "oot_roc_auc", "rank", "deployment")


@query
def q_best_per_dim(spark, sf):
    runs = fake_runs(spark, sf)
    return board.best_per_dim(runs, "feature_set").unionByName(board.best_per_dim(runs, "model_family"))


@query
def q_fs_consensus(spark, sf):
    return _r(selection.consensus(fake_scores(spark, sf)))


@query
def q_topn_features(spark, sf):
    return selection.top_features(selection.consensus(fake_scores(spark, sf)), "consensus", TOP).select("feature", half_up(F.col("consensus"), 6).alias("consensus"))


@query
def q_fs_both(spark, sf):
    return selection.fs_both(selection.consensus(fake_scores(spark, sf)), TOP)


@query
def q_fs_tree_only(spark, sf):
    return selection.fs_tree_only(selection.consensus(fake_scores(spark, sf)), TOP)


@query
def q_fs_lr_only(spark, sf):
    return selection.fs_lr_only(selection.consensus(fake_scores(spark, sf)), TOP)


def _fake_sets(spark, sf):
    norm = selection.fs_normalise(fake_scores(spark, sf))
    return norm.where(F.col("norm") >= 0.5).select(F.col("method").alias("feature_set"), "feature")


@query
def q_fs_vote_consensus(spark, sf):
    return selection.fs_vote_consensus(_fake_sets(spark, sf), 25)


@query
def q_fs_agreement(spark, sf):
    return selection.fs_agreement(selection.consensus(fake_scores(spark, sf)), TOP)


@query
def q_fs_quadrant(spark, sf):
    return selection.fs_quadrant(selection.consensus(fake_scores(spark, sf)))


@query
def q_fs_stability(spark, sf):
    return selection.fs_stability(fake_scores(spark, sf), GROUP_METHODS)


# -- scalar functions and transforms ----------------------------------------


@query
def q_scalar_transforms(spark, sf):
    x = F.col("ord_price_gappy")
    return _r(
        risk(spark, sf, ["record_id", "ord_price_gappy", "cust_acctbal"]).select(
            "record_id",
            scalar.log1p(F.col("cust_acctbal")).alias("log1p_bal"),
            scalar.clip(x, 50000.0, 400000.0).alias("clipped"),
            F.coalesce(x, F.lit(0.0)).alias("filled"),
            scalar.is_missing(x).cast("int").alias("is_missing"),
            F.abs("cust_acctbal").alias("abs_bal"),
            F.log(scalar.ratio(x, F.abs("cust_acctbal") + F.lit(1.0))).alias("log_ratio"),
            F.greatest(F.lit(0.0), F.col("cust_acctbal")).alias("at_least_zero"),
            F.lower(F.lit("ABC")).alias("lowered"),
            x.cast("string").rlike("(?i)e").alias("has_exponent"),
        )
    )


@query
def q_fe_missing_indicator(spark, sf):
    df = risk(spark, sf, ["record_id", "li_cnt", "ord_price_gappy", "drv_high_card"], keep=True)
    cols = transforms.sparse_columns(df, ["li_cnt", "ord_price_gappy", "drv_high_card"])
    return transforms.add_missing_indicators(df, cols)


@query
def q_fe_impute_median(spark, sf):
    df = risk(spark, sf, ["record_id", "li_qty_sum", "ord_price_gappy"], keep=True)
    return transforms.impute(df, transforms.fit_fill(df, ["li_qty_sum", "ord_price_gappy"]))


@query
def q_fe_impute_mode(spark, sf):
    df = risk(spark, sf, ["record_id", "drv_high_card", "cust_segment"], keep=True)
    return transforms.impute(df, transforms.fit_modes(df, ["drv_high_card", "cust_segment"]))


@query
def q_fe_winsorise(spark, sf):
    df = risk(spark, sf, ["record_id", "drv_outlier", "ord_price_gappy"], keep=True)
    return _r(transforms.winsorise(df, transforms.fit_fences(df, ["drv_outlier", "ord_price_gappy"])))


@query
def q_fe_log1p(spark, sf):
    df = risk(spark, sf, ["record_id", "drv_skewed", "ord_totalprice", "cust_acctbal"], keep=True)
    cols = transforms.fit_log_columns(df, ["drv_skewed", "ord_totalprice", "cust_acctbal"])
    return _r(transforms.log1p_columns(df, cols))


@query
def q_fe_encoding_plan(spark, sf):
    return transforms.encoding_plan(risk(spark, sf, CATEGORICAL), CATEGORICAL)


@query
def q_fe_one_hot(spark, sf):
    df = risk(spark, sf, ["record_id", "cust_segment"], keep=True)
    return transforms.one_hot(df, "cust_segment", transforms.fit_levels(df, ["cust_segment"])["cust_segment"])


@query
def q_fe_ordinal(spark, sf):
    df = risk(spark, sf, ["record_id", "cust_nation"], keep=True)
    return transforms.ordinal_encode(df, transforms.ordinal_codes(df, ["cust_nation"]))


@query
def q_fe_woe_encode(spark, sf):
    df = risk(spark, sf, ["record_id", "flagged", "drv_high_card"], keep=True)
    return _r(transforms.woe_encode(df, ["drv_high_card"], "flagged"))


@query
def q_fe_rare_merge(spark, sf):
    df = risk(spark, sf, ["record_id", "drv_near_const"], keep=True)
    return transforms.rare_merge(df, "drv_near_const")


def _scaled(spark, sf, kind):
    cols = ["li_qty_sum", "cust_acctbal", "ord_const"]
    df = risk(spark, sf, ["record_id", "sample_group", *cols], keep=True)
    train = governance.split_filter(df, "sample_group", "Train")
    return _r(transforms.scale(df, transforms.fit_scaler(train, cols, kind)))


@query
def q_scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query
def q_scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query
def q_scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


def _spec_input(spark, sf):
    return risk(spark, sf, ["record_id", "sample_group", "flagged", "ord_const", "li_has_return", *SPEC_NUMERIC, *CATEGORICAL], keep=True)


def _fit_spec(df):
    return transforms.fit_spec(
        df, "flagged", numeric=SPEC_NUMERIC, categorical=CATEGORICAL, boolean=["li_has_return"],
        constant=["ord_const"], identifier=["record_id"], group="sample_group",
    )


@query
def q_fit_spec(spark, sf):
    return transforms.spec_for_report(_fit_spec(_spec_input(spark, sf)))


@query
def q_serve_features(spark, sf):
    df = _spec_input(spark, sf)
    spec = materialise(_fit_spec(df), "spec")
    features = [*SPEC_NUMERIC, "drv_high_card_is_missing", "ord_priority", "cust_nation", "drv_high_card"]
    return _r(transforms.serve_features(df, spec, features, "flagged", keep=["record_id"]))


# -- sampling ---------------------------------------------------------------


@query
def q_sample_bernoulli(spark, sf):
    return sampling.sample_bernoulli(risk(spark, sf, ["record_id", "ord_totalprice"]), 1000)


@query
def q_sample_hash(spark, sf):
    return sampling.sample_hash(risk(spark, sf, ["record_id", "ord_totalprice"], keep=True), 1000, "record_id")


@query
def q_undersample_hash(spark, sf):
    return sampling.undersample_hash(risk(spark, sf, ["record_id", "flagged"], keep=True), "flagged", "record_id", 3.0)


@query
def q_undersample_fraction(spark, sf):
    return sampling.undersample_fraction(risk(spark, sf, ["record_id", "flagged"]), "flagged")


@query
def q_class_weights(spark, sf):
    return sampling.class_weights(risk(spark, sf, ["flagged"]), "flagged")


@query
def q_kfold_assign(spark, sf):
    return sampling.kfold_assign(risk(spark, sf, ["record_id", "flagged"], keep=True), "flagged", "record_id", 3)


@query
def q_stratified_split(spark, sf):
    return sampling.stratified_split(risk(spark, sf, ["record_id", "flagged"], keep=True), "flagged", "record_id")


# -- metrics ----------------------------------------------------------------


@query
def q_roc_auc(spark, sf):
    return metrics.roc_auc(scored(spark, sf), "label", "score")


@query
def q_pr_auc(spark, sf):
    return metrics.pr_auc(scored(spark, sf), "label", "score")


@query
def q_confusion(spark, sf):
    return metrics.confusion(scored(spark, sf), "label", "score")


@query
def q_threshold_metrics(spark, sf):
    return metrics.threshold_metrics(scored(spark, sf), "label", "score")


@query
def q_ks_stat(spark, sf):
    return metrics.ks_stat(scored(spark, sf), "label", "score")


@query
def q_roc_points(spark, sf):
    return metrics.roc_points(scored(spark, sf), "label", "score", ["sample_group"])


@query
def q_gain_lift(spark, sf):
    return metrics.gain_lift(scored(spark, sf), "label", "score")


@query
def q_cv_summary(spark, sf):
    folded = scored(spark, sf).withColumn("fold", F.col("record_id") % 3)
    aucs = metrics.roc_auc(folded, "label", "score", ["sample_group", "fold"])
    return metrics.cv_summary(aucs, "roc_auc", ["sample_group"])


@query
def q_metrics_by_split(spark, sf):
    return metrics.metrics_by_split(scored(spark, sf), "label", "score", ["sample_group"])


@query
def q_calibration_bins(spark, sf):
    return metrics.calibration_bins(scored(spark, sf), "label", "score")


@query
def q_prob_metrics(spark, sf):
    return metrics.prob_metrics(scored(spark, sf), "label", "score")


# -- models -----------------------------------------------------------------


def _model_table(spark, sf):
    return risk(spark, sf, ["record_id", "sample_group", "flagged", *PREDICTORS], keep=True)


def _train(spark, sf):
    return governance.split_filter(_model_table(spark, sf), "sample_group", "Train")


@query
def q_fs_lr_l1(spark, sf):
    return learners.fs_lr_l1(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_lr_l1_cv(spark, sf):
    return learners.fs_lr_l1_cv(_train(spark, sf), PREDICTORS, "flagged", "record_id", n_cs=10)


@query
def q_fs_lr_l2(spark, sf):
    return learners.fs_lr_l2(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_lr_en(spark, sf):
    return learners.fs_lr_en(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_rf(spark, sf):
    return learners.fs_rf(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_gbt(spark, sf):
    return learners.fs_gbt(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_gbt_splits(spark, sf):
    return learners.fs_gbt_splits(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_lr_sgd(spark, sf):
    return descent.fs_lr_sgd(_train(spark, sf), PREDICTORS, "flagged", "record_id")


@query
def q_fs_mutual_info_knn(spark, sf):
    return neighbours.mutual_information_knn(_train(spark, sf), PREDICTORS, "flagged")


@query
def q_fs_boosted(spark, sf):
    """Second-order boosting: gain, split count and cover."""
    return learners.fs_boosted(_train(spark, sf), PREDICTORS, "flagged", "record_id", rounds=40, rate=0.2)


@query
def q_fs_extra_trees(spark, sf):
    return learners.fs_extra_trees(_train(spark, sf), PREDICTORS, "flagged", "record_id")


def _explained(spark, sf):
    """A boosted model of the training rows, with what it was fitted on."""
    table, _ = learners.binned_frame(_train(spark, sf), PREDICTORS, "flagged", "record_id")
    fit = growth.Ensemble(tuple(range(len(PREDICTORS))), Rows("fold"), 25, 3, 20, boosted=True, rate=0.2, lam=1.0)
    return table, fit, growth.grow(table, [fit], [0.0])[0]


@query
def q_shap_importance(spark, sf):
    table, fit, trees = _explained(spark, sf)
    return explain.mean_shapley(explain.shapley_values(table, fit, trees, 0.0), PREDICTORS)


@query
def q_effect_direction(spark, sf):
    table, fit, trees = _explained(spark, sf)
    return explain.directions(explain.local_effects(table, fit, trees, 0.0, PREDICTORS))


@query
def q_fs_permutation(spark, sf):
    return learners.fs_permutation(_train(spark, sf), PREDICTORS, "flagged", "record_id")


@query
def q_feature_sets(spark, sf):
    return learners.feature_sets(_train(spark, sf), PREDICTORS, "flagged", "record_id")


@query
def q_selected_sets(spark, sf):
    return learners.selected_sets(selection.consensus(fake_scores(spark, sf)), TOP)


@query
def q_grid_search(spark, sf):
    """The whole catalogue over the seven candidate sets: 39 experiments a set."""
    sets = grid.sets_from_frame(q_feature_sets(spark, sf))
    return grid.run_grid(_model_table(spark, sf), sets, "flagged", "sample_group", "record_id").results


# -- operators over real scores, artifacts and streams -----------------------


@query
def q_scan_csv_quoted(spark, sf):
    """Separators, doubled quotes and line ends in cells of every text column, the last one included."""
    key = F.col("c_custkey")
    text = table(spark, sf, "customer").select(
        F.concat(F.lit('a "'), F.col("c_mktsegment"), F.lit('", b')).alias("first"),
        key.cast("string").alias("c_custkey"),
        F.when(key % 2 == 0, F.concat(F.lit("two\nlines "), key.cast("string"))).otherwise(F.lit('"')).alias("last"),
    )
    path = scratch_path(spark, "csv")
    write_csv(text, path)
    return read_delimited(spark, path)


@query
def q_input_size(spark, sf):
    return input_size(read_parquet(spark, f"{sf}/orders.parquet")).select("n_files", "size_bytes")


@query
def q_scan_parquet_whole(spark, sf):
    return read_parquet(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice")


@query
def q_column_fill(spark, sf):
    """The column list with the filled rows of each."""
    df = governance.prohibited_guard(risk(spark, sf))
    filled = df.agg(*[F.count(quoted(c)).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "n_values")
    return profile.schema_columns(df, target="funded").join(filled, "column")


@query
def q_numeric_feature_fill(spark, sf):
    """The numeric features wanted, with the filled rows of each."""
    df = risk(spark, sf)
    wanted = ["li_cnt", "cust_segment", "no_such_column", "funded", "ord_price_gappy", "drv_skewed"]
    names = governance.numeric_features(df, wanted, "funded")
    filled = df.agg(*[F.count(quoted(c)).alias(c) for c in names]).unpivot([], names, "feature", "n_values")
    return small_table(spark, list(enumerate(names, start=1)), "position bigint, feature string").join(filled, "feature")


def _filter_scores(spark, sf):
    """What five filter methods give, as their own queries show it, from one written table and one fit of bins."""
    df = risk(spark, sf, ["record_id", "flagged", *PREDICTORS, *IV_COLUMNS], keep=True)
    bins = woe.fit_bins(df, IV_COLUMNS, "record_id", 10, where=F.col("flagged").isNotNull())
    anova = stats.with_anova_p(stats.anova_f(df, PREDICTORS, "flagged"))
    parts = [
        selection.score_rows(_variances(df), "Variance", "Filter"),
        selection.score_rows(woe.information_value(df, IV_COLUMNS, "flagged", "record_id", bins=bins), "IV (WoE)", "Filter", "iv"),
        selection.score_rows(woe.mutual_information(df, IV_COLUMNS, "flagged", "record_id", bins=bins), "Mutual Info", "Filter", "mi"),
        selection.score_rows(anova.withColumn("score", half_up(F.col("score"), 4)), "ANOVA F-Test", "Filter"),
        selection.score_rows(_r(stats.point_biserial(df, PREDICTORS, "flagged")), "Point-Biserial r", "Filter"),
    ]
    return materialise(union_all(parts), "filters")


@query
def q_fs_consensus_filters(spark, sf):
    return _r(selection.consensus(_filter_scores(spark, sf)), 5)


@query
def q_fs_method_rules(spark, sf):
    return selection.method_summary(_filter_scores(spark, sf))


def _served(spark, sf, spec):
    features = [*SPEC_NUMERIC, "drv_high_card_is_missing", "ord_priority", "cust_nation", "drv_high_card"]
    return _r(transforms.serve_features(_spec_input(spark, sf), spec, features, "flagged", keep=["record_id"]))


@query
def q_spec_round_trip(spark, sf):
    path = scratch_path(spark, "spec")
    save_artifact(_fit_spec(_spec_input(spark, sf)), path)
    return _served(spark, sf, load_artifact(spark, path))


@query
def q_stream_replay(spark, sf):
    """The spec over a stream of the same rows: what is there is drained, and the result read back."""
    df = _spec_input(spark, sf)
    spec = materialise(_fit_spec(df), "spec")
    source, out, marks = (scratch_path(spark, name) for name in ("source", "served", "marks"))
    df.write.parquet(source)
    features = [*SPEC_NUMERIC, "drv_high_card_is_missing", "ord_priority", "cust_nation", "drv_high_card"]
    stream = spark.readStream.schema(df.schema).parquet(source)
    serve_stream(stream, spec, out, marks, features, "flagged", ["record_id"]).awaitTermination()
    return _r(spark.read.parquet(out))


@query
def q_psi_stream(spark, sf):
    """Stability of five-day windows of an event stream against its first five days."""
    events = table(spark, sf, "events").select("ts", "value", "user_id")
    base = events.where("ts < timestamp '2024-01-06 00:00:00'")
    cuts = drift.base_cuts(base, ["value", "user_id"])
    source, out, marks = (scratch_path(spark, name) for name in ("source", "counts", "marks"))
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    drift.psi_stream(stream, cuts, "ts", "5 days", "40 days", out, marks).awaitTermination()
    return drift.psi_by_window(base, drift.window_counts(spark, out), cuts)


@query
def q_learning_curve(spark, sf):
    return curves.learning_curve(_model_table(spark, sf), PREDICTORS, "flagged", "sample_group", "record_id")


def _fill_input(spark, sf):
    return risk(spark, sf, ["record_id", "li_qty_sum", "ord_price_gappy"], keep=True)


@query
def q_fe_impute_mean(spark, sf):
    df = _fill_input(spark, sf)
    return _r(transforms.impute(df, transforms.fit_fill(df, ["li_qty_sum", "ord_price_gappy"], "mean")))


@query
def q_fe_impute_constant(spark, sf):
    df = _fill_input(spark, sf)
    return _r(transforms.impute(df, transforms.fit_fill(df, ["li_qty_sum", "ord_price_gappy"], "constant", -1.0)))


@query
def q_fe_winsorise_zscore(spark, sf):
    df = _fill_input(spark, sf)
    return _r(transforms.winsorise(df, transforms.fit_fences(df, ["li_qty_sum", "ord_price_gappy"], "zscore", 1.5)))
