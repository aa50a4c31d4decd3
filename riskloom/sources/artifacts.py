"""JSON documents of fitted artifacts: feature spec, selected features, split info, model results.

The documents hold only what is bounded by the schema or by the grid.  Maps with
a row per category (WoE) stay in the Parquet spec of ``save_artifact``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.transforms import SPEC_SCHEMA, fit_levels, impute, woe_map
from riskloom.sources.scratch import small_table



def save_document(spark: SparkSession, doc: Mapping[str, Any], path: str, mode: str = "overwrite") -> None:
    """One JSON document, written through Spark so any supported file system works."""
    text = json.dumps(doc, indent=2, default=str)
    small_table(spark, [(text,)], "value string").coalesce(1).write.mode(mode).text(path)


def load_document(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read a document saved here, or a plain JSON file."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


# -- feature spec -----------------------------------------------------------


def spec_document(spec: DataFrame) -> dict[str, Any]:
    doc: dict[str, Any] = {
        "dropped_constant": [], "dropped_identifier": [], "imputation": {}, "log_transform": [],
        "winsorisation": {}, "encoding": {}, "missing_indicators": [], "feature_names_out": [], "levels": {},
    }
    lists = {
        "drop_constant": "dropped_constant", "drop_identifier": "dropped_identifier",
        "log_transform": "log_transform", "missing_indicator": "missing_indicators",
    }
    levels: dict[str, list[tuple[int, str]]] = {}
    for r in spec.where(F.col("step") != "woe_map").collect():  # bounded by the schema
        step, column = r["step"], r["column"]
        if step in lists:
            doc[lists[step]].append(column)
        elif step == "impute":
            fill = r["num"] if r["txt"] is None else r["txt"]
            doc["imputation"][column] = {"strategy": r["key"], "fill_value": fill}
        elif step == "winsorise":
            doc["winsorisation"].setdefault(column, {})[r["key"]] = r["num"]
        elif step == "encoding":
            doc["encoding"][column] = r["key"]
        elif step == "level":
            levels.setdefault(column, []).append((r["position"], r["key"]))
    doc["levels"] = {c: [v for _, v in sorted(pairs)] for c, pairs in levels.items()}
    return doc


def spec_from_document(
    spark: SparkSession, doc: Mapping[str, Any], fit: DataFrame | None = None, target: str | None = None
) -> DataFrame:
    """The spec table of a document.

    A document without category levels (or any with WoE columns) is completed from
    ``fit``: levels from its values, WoE from its ``target``.
    """
    rows: list[tuple] = []

    def add(step, column, key=None, num=None, txt=None, position=None):
        rows.append((step, column, key, None if num is None else float(num), txt, position))

    for c in doc.get("dropped_constant", []):
        add("drop_constant", c)
    for c in doc.get("dropped_identifier", []):
        add("drop_identifier", c)
    for c in doc.get("missing_indicators", []):
        add("missing_indicator", c)
    for c, how in doc.get("imputation", {}).items():
        fill = how["fill_value"]
        if isinstance(fill, str):
            add("impute", c, how.get("strategy"), txt=fill)
        else:
            add("impute", c, how.get("strategy"), num=fill)
    for c, bounds in doc.get("winsorisation", {}).items():
        for side in ("lower", "upper"):
            if bounds.get(side) is not None:
                add("winsorise", c, side, num=bounds[side])
    for c in doc.get("log_transform", []):
        add("log_transform", c)
    encoding = doc.get("encoding", {})
    levels = dict(doc.get("levels", {}))
    filled = None
    if fit is not None:
        texts = {
            c: how["fill_value"] for c, how in doc.get("imputation", {}).items()
            if c in encoding and c in fit.columns and isinstance(how["fill_value"], str)
        }
        filled = impute(fit, texts)
        unknown = [c for c, e in encoding.items() if e != "woe" and c not in levels and c in fit.columns]
        levels.update(fit_levels(filled, unknown))
    for c, kind in encoding.items():
        add("encoding", c, kind)
        for i, v in enumerate(levels.get(c, [])):
            add("level", c, v, position=i)
    spec = small_table(spark, rows, SPEC_SCHEMA)
    by_woe = [c for c, e in encoding.items() if e == "woe" and filled is not None and c in filled.columns]
    if by_woe and target:
        maps = woe_map(filled, by_woe, target)
        spec = spec.unionByName(
            maps.select(
                F.lit("woe_map").alias("step"), "column", "key", F.col("woe").alias("num"),
                F.lit(None).cast("string").alias("txt"), F.lit(None).cast("int").alias("position"),
            )
        )
    return spec


# -- selection, split, results ----------------------------------------------


def selection_document(agreement: DataFrame, n: int = 200, methods: Sequence[str] = ()) -> dict[str, Any]:
    """From ``fs_agreement`` (one row per feature): the selection and its tree / linear overlap."""
    rows = sorted(agreement.collect(), key=lambda r: r["rank"])

    def labelled(*kinds: str) -> list[str]:
        return [r["feature"] for r in rows if r["agreement"] in kinds]

    return {
        "selected_features": [r["feature"] for r in rows[:n]],
        "both_consensus": labelled("Both"),
        "tree_only": labelled("Tree"),
        "lr_only": labelled("LR"),
        "n_methods_tried": max((r["n_methods"] for r in rows), default=0),
        "method_names": list(methods),
        "consensus_scores": {r["feature"]: r["consensus"] for r in rows},
    }


def split_document(splits: DataFrame, features: Sequence[str], seed: int = 42, folds: int = 5) -> dict[str, Any]:
    """From ``split_stats``: sizes, seed, folds, Train imbalance and the features used."""
    rows = {r["split"]: r for r in splits.collect()}

    def size(name: str) -> int:
        return rows[name]["n"] if name in rows else 0

    ratio = next((r["train_imbalance"] for r in rows.values()), None)
    return {
        "n_train": size("Train"), "n_val": size("Test"), "n_test": size("OOT"), "n_features": len(features),
        "seed": seed, "cv_folds": folds, "imbalance_ratio": ratio, "selected_features": list(features),
    }


def results_document(results: DataFrame, length: int | None = None) -> dict[str, Any]:
    """From ranked grid results (one row per experiment): the winner, its parts, and the ranking or its first ``length`` rows."""
    ranked = results.orderBy("rank")
    top = [r.asDict() for r in (ranked if length is None else ranked.limit(length)).collect()]
    best = top[0] if top else {}
    return {
        "best_experiment": best,
        "best_model": best.get("model_label"),
        "best_feature_set": best.get("feature_set"),
        "best_scaler": best.get("scaler"),
        "best_imbalance": best.get("imbalance"),
        "total_experiments": results.count(),
        "ranking": top,
    }
