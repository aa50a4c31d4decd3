"""Result and artifact sinks, and their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def save_artifact(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Fitted specs, score matrices, selections and leaderboards: typed Parquet."""
    df.write.mode(mode).parquet(path)


def load_artifact(spark: SparkSession, path: str) -> DataFrame:
    """Reload a saved artifact, so a later step can run alone."""
    return spark.read.parquet(path)


def load_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
