"""Risk-shaped frames over the driver tables: a fact table, feature tables, scores, runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.star import star_left_join
from riskloom.sources.readers import read_parquet
from riskloom.sources.scratch import materialise

NUMERIC = ["li_qty_sum", "li_price_max", "ord_totalprice", "ord_price_gappy", "cust_acctbal", "drv_skewed", "drv_outlier"]
PREDICTORS = ["li_qty_sum", "li_cnt", "li_disc_min", "ord_price_gappy", "ord_totalprice", "cust_acctbal", "drv_skewed", "drv_outlier"]
CATEGORICAL = ["ord_priority", "cust_segment", "cust_nation", "drv_near_const", "drv_high_card"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def perf(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    oot = F.col("o_orderdate") >= F.lit("2000-04-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(
        key.alias("record_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("funded"),
        F.when(oot, "OOT").when(key % 4 == 0, "Test").otherwise("Train").alias("sample_group"),
    )


def feature_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    orders = table(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    items = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("record_id"))
        .agg(
            F.count(F.lit(1)).alias("li_cnt"),
            F.sum("l_quantity").alias("li_qty_sum"),
            F.max("l_extendedprice").alias("li_price_max"),
            F.min("l_discount").alias("li_disc_min"),
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("li_has_return"),
        )
    )
    order = orders.select(
        key.alias("record_id"),
        price.alias("ord_totalprice"),
        (price * F.lit(2.0) + F.lit(1.0)).alias("ord_totalprice_x2"),
        F.when(key % 8 != 0, price).alias("ord_price_gappy"),
        F.col("o_orderpriority").alias("ord_priority"),
        F.lit(1).alias("ord_const"),
    )
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    cust = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("record_id"),
        F.col("c_acctbal").alias("cust_acctbal"),
        F.col("c_mktsegment").alias("cust_segment"),
        F.col("n_name").alias("cust_nation"),
        (F.col("c_acctbal") / F.lit(10.0)).alias("cust_internal_score_v3"),
        F.col("c_mktsegment").alias("cust_reason_code_1"),
    )
    group = F.concat(F.lit("G"), (F.col("o_custkey") % 80).cast("string"))
    derived = orders.select(
        key.alias("record_id"),
        (F.lit(1.0) / (F.lit(1) + key % 97).cast("double")).alias("drv_skewed"),
        F.when(key % 500 == 0, price * F.lit(100.0)).otherwise(price).alias("drv_outlier"),
        F.when(key % 200 == 0, "B").otherwise("A").alias("drv_near_const"),
        F.when(key % 9 != 0, group).alias("drv_high_card"),
    )
    return [items, order, cust, derived]


def risk(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, keep: bool = False) -> DataFrame:
    """The joined modelling table, limited to ``columns``; ``keep`` writes it once for several passes.

    ``flagged``, a target with signal, is derived where asked for.
    """
    wanted = None if columns is None else list(dict.fromkeys(columns))
    needs_flag = wanted is not None and "flagged" in wanted
    pulled = None if wanted is None else [c for c in wanted if c != "flagged"] + (["ord_totalprice"] if needs_flag else [])
    df = star_left_join(perf(spark, sf_dir), feature_tables(spark, sf_dir), "record_id", pulled)
    if needs_flag:
        key = F.col("record_id")
        hot = ((F.col("ord_totalprice") > 430000) & (key % 10 != 3)) | (key % 10 == 0)
        df = df.withColumn("flagged", F.when(hot, 1).otherwise(0))
    if wanted is not None:
        df = df.select(*wanted)
    return materialise(df, "risk") if keep else df


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = risk(spark, sf_dir, ["record_id", "sample_group", "flagged", "ord_totalprice"])
    score = F.floor(F.col("ord_totalprice") / F.lit(5000.0)).cast("double") / F.lit(100.0)
    return df.select("record_id", "sample_group", F.col("flagged").alias("label"), score.alias("score"))


def fake_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaderboard-shaped rows from the part table; ``run_id`` groups them into boards."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("experiment_id"),
        F.col("p_brand").alias("feature_set"),
        F.col("p_type").alias("model_family"),
        F.col("p_size").alias("n_features"),
        ((key * 7919 % 1000).cast("double") / F.lit(2000.0) + F.lit(0.5)).alias("oot_roc_auc"),
        F.floor(key / F.lit(200)).cast("bigint").alias("run_id"),
    )


def fake_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    grp = (
        F.when(F.col("p_type").isin("ECONOMY", "LARGE"), "Filter")
        .when(F.col("p_type").isin("MEDIUM", "PROMO"), "Logistic Regression")
        .otherwise("Tree-Based")
    )
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("method"), F.col("p_brand").alias("feature"), grp.alias("grp"))
        .agg(F.sum("p_size").cast("double").alias("score"))
    )
