import pytest
from pyspark.sql import functions as F

from riskloom.operators import sampling, transforms
from riskloom.operators.star import star_left_join
from riskloom.plans.queries import _fit_spec, _spec_input
from riskloom.sources import artifacts, readers, sinks
from riskloom.sources.scratch import materialise, scratch_path
from riskloom.streaming.serve import serve_stream


def test_imputed_and_scaled_properties(spark):
    df = spark.createDataFrame([(float(i), None if i % 4 == 0 else float(i * i), 3.0) for i in range(40)], "a double, b double, k double")
    filled = transforms.impute(df, transforms.fit_fill(df, ["a", "b"]))
    assert filled.where("b is null").count() == 0
    for kind in ("standard", "robust", "minmax"):
        out = transforms.scale(filled, transforms.fit_scaler(filled, ["a", "b", "k"], kind))
        row = out.agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s"), F.min("b").alias("lo"), F.max("b").alias("hi"),
                      F.max("k").alias("k"), F.percentile("a", 0.5).alias("med")).first()
        assert row["k"] == 0.0
        if kind == "standard":
            assert abs(row["m"]) < 1e-12 and abs(row["s"] - 1) < 1e-12
        elif kind == "minmax":
            assert row["lo"] == 0.0 and row["hi"] == 1.0
        else:
            assert abs(row["med"]) < 1e-12


def test_fill_strategies_and_fences(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (9.0, None)], "a double, e double")
    assert transforms.fit_fill(df, ["a", "e"], "mean") == {"a": 4.0, "e": 0.0}
    assert transforms.fit_fill(df, ["a", "e"], "constant", -999) == {"a": -999.0, "e": -999.0}
    assert transforms.fit_fill(df, ["a", "e"]) == {"a": 2.0, "e": 0.0}
    assert transforms.fit_fences(df, ["a", "e"], "none") == {}
    assert list(transforms.fit_fences(df, ["a", "e"], "zscore")) == ["a"]


def test_modes_skip_null_and_break_ties(spark):
    df = spark.createDataFrame([(None, None), (None, None), ("b", None), ("a", None)], "c string, e string")
    assert transforms.fit_modes(df, ["c", "e"]) == {"c": "a", "e": "UNKNOWN"}


def test_unseen_categories(spark):
    fit = spark.createDataFrame([("a", 1), ("b", 0), ("a", 0), ("b", 1)], "c string, y int")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    coded = transforms.ordinal(new, transforms.fit_levels(fit, ["c"]))
    assert [r["c"] for r in coded.collect()] == [0, None, None]
    maps = transforms.woe_map(fit, ["c"], "y")
    assert {r["c"] for r in transforms.apply_woe(new, maps, ["c"]).collect()} == {0.0, None}


def test_many_levels(spark):
    fit = spark.range(3000).selectExpr("concat('v', lpad(id, 5, '0')) AS c", "cast(id % 7 as string) AS d")
    with pytest.raises(ValueError, match="more than"):
        transforms.fit_levels(fit, ["c"])
    codes = transforms.ordinal_codes(fit, ["c", "d"])
    rows = [("v02999", "x", 1), (None, "6", 2), ("v00000", "0", 3), ("w", None, 4)]
    got = transforms.ordinal_encode(spark.createDataFrame(rows, "c string, d string, code int"), codes).orderBy("code").collect()
    assert [tuple(r) for r in got] == [(2999, None, 1), (None, 6, 2), (0, 0, 3), (None, None, 4)]


def test_rare_merge(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 5, "rare").when(F.col("id") < 15, "edge").otherwise("big").alias("c"))
    got = {r["c"]: r["count"] for r in transforms.rare_merge(df, "c").groupBy("c").count().collect()}
    assert got == {"OTHER": 5, "edge": 10, "big": 985}


@pytest.fixture(scope="module")
def fitted(spark, sf):
    df = _spec_input(spark, sf)
    return df, materialise(_fit_spec(df), "spec")


FEATURES = ["li_qty_sum", "ord_price_gappy", "drv_skewed", "ord_priority", "cust_nation", "drv_high_card", "drv_high_card_is_missing"]


def test_served_rows_have_no_gaps(fitted):
    df, spec = fitted
    served = transforms.serve_features(df, spec, FEATURES, "flagged", keep=["record_id"])
    assert served.count() == df.count()
    numeric = ["li_qty_sum", "ord_price_gappy", "drv_skewed", "cust_nation"]
    assert served.where(" or ".join(f"{c} is null" for c in numeric)).count() == 0
    assert "ord_const" not in transforms.serve_features(df, spec).columns


def test_spec_survives_storage(spark, fitted):
    df, spec = fitted
    path = scratch_path(spark, "artifact")
    sinks.save_artifact(spec, path)
    a = transforms.serve_features(df, spec, FEATURES, keep=["record_id"])
    b = transforms.serve_features(df, sinks.load_artifact(spark, path), FEATURES, keep=["record_id"])
    assert a.exceptAll(b).count() == 0


def test_stream_equals_batch(spark, fitted):
    df, spec = fitted
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    df.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(source)
    serve_stream(stream, spec, out, state, FEATURES, "flagged", ["record_id"]).awaitTermination(300)
    batch = transforms.serve_features(df, spec, FEATURES, "flagged", keep=["record_id"])
    streamed = spark.read.schema(batch.schema).parquet(out)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_auto_spec(spark):
    df = spark.range(400).select(
        F.col("id").alias("row_id"), F.exp((F.col("id") % 100) / 10.0).alias("x"), (F.col("id") % 60).cast("string").alias("c"),
        (F.col("id") % 4).cast("string").alias("d"), F.lit(1).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"),
    )
    spec = transforms.fit_spec(df, "y")
    steps = {(r["step"], r["column"], r["key"]) for r in spec.collect()}
    assert ("drop_constant", "k", None) in steps and ("drop_identifier", "row_id", None) in steps
    assert ("encoding", "c", "woe") in steps and ("encoding", "d", "one_hot") in steps
    assert ("log_transform", "x", None) in steps
    assert {"x", "c", "d_0", "d_3", "y"} <= set(transforms.serve_features(df, spec, target="y").columns)


def test_samples_are_exact_and_stable(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    for options in ({}, {"accuracy": 100}):
        assert sampling.sample_hash(df, 777, "id", **options).count() == 777
        under = sampling.undersample_hash(df, "y", "id", 3.0, **options)
        assert {r["y"]: r["count"] for r in under.groupBy("y").count().collect()} == {1: 500, 0: 1500}
        folds = sampling.kfold_assign(df, "y", "id", 3, **options).groupBy("y", "fold").count().collect()
        assert sorted(r["count"] for r in folds) == [166, 167, 167, 1500, 1500, 1500]
    a, b = sampling.sample_hash(df, 100, "id"), sampling.sample_hash(df.repartition(13), 100, "id")
    assert a.exceptAll(b).count() == 0
    assert sampling.sample_hash(df, 9999, "id").count() == 5000
    split = sampling.stratified_split(df, "y", "id").groupBy("y", "part").count().collect()
    assert sorted(r["count"] for r in split) == [150, 350, 1350, 3150]
    weighted = sampling.with_class_weight(df, "y").agg(F.sum("weight")).first()[0]
    assert abs(weighted - 5000) < 1e-6


def test_star_join_keeps_fact_rows_and_prunes(spark):
    fact = spark.createDataFrame([(1, 0), (2, 1)], "k int, y int")
    a = spark.createDataFrame([(1, 5.0)], "k int, a double")
    b = spark.createDataFrame([(2, "z")], "k int, b string")
    out = star_left_join(fact, [a, b], "k", check_unique=True)
    assert out.columns == ["k", "y", "a", "b"] and out.count() == 2
    pruned = star_left_join(fact, [a, b], "k", ["y", "b"])
    assert pruned.columns == ["k", "y", "b"]
    assert pruned._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    with pytest.raises(ValueError):
        star_left_join(fact, [a.union(a)], "k", check_unique=True)


def test_quoted_cells_survive(spark):
    """Separators, doubled quotes and line ends in cells, in the first, a middle and the last column."""
    cells = ['a "b", c', "two\nlines", 'all: "x",\n"y"', "plain", '"']
    rows = [(x, i, y) for i, (x, y) in enumerate(zip(cells, reversed(cells)))]
    path = scratch_path(spark, "csv")
    sinks.write_csv(spark.createDataFrame(rows, "a string, n bigint, b string"), path)
    got = readers.read_delimited(spark, path)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "bigint", "string"]
    assert {tuple(r) for r in got.collect()} == set(rows)


def test_text_types_are_inferred(spark):
    path = scratch_path(spark, "csv")
    text = spark.createDataFrame(
        [("1", "1.5", "true", "2020-01-02", "a,b", "NA"), ("NA", "2e3", "null", "N/A", "", ""), ("-3", "7", "false", "2021-05-06", "x\"y", "NULL")],
        "i string, d string, b string, t string, s string, e string",
    )
    sinks.write_csv(text, path)
    df = readers.read_delimited(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "boolean", "date", "string", "string"]
    rows = {tuple(r) for r in df.select("i", "d", "s").collect()}
    assert rows == {(1, 1.5, "a,b"), (None, 2000.0, None), (-3, 7.0, 'x"y')}
    size = readers.input_size(spark.read.csv(path, header=True)).first()
    assert size["n_files"] >= 1 and size["size_bytes"] > 0


def test_json_sink_round_trip(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0.5)], "i bigint, s string, d double")
    path = scratch_path(spark, "json")
    sinks.write_json(df, path)
    assert sinks.load_json(spark, path, df.schema).exceptAll(df).count() == 0


def test_spec_document_round_trip(spark, fitted):
    df, spec = fitted
    path = scratch_path(spark, "spec-json")
    artifacts.save_document(spark, artifacts.spec_document(spec), path)
    doc = artifacts.load_document(spark, path)
    assert doc["encoding"]["drv_high_card"] == "woe" and doc["winsorisation"]["drv_outlier"]["lower"] < 0
    train = df.where("sample_group = 'Train'")
    again = artifacts.spec_from_document(spark, doc, train, "flagged")
    a = transforms.serve_features(df, spec, FEATURES, keep=["record_id"]).withColumn("drv_high_card", F.round("drv_high_card", 9))
    b = transforms.serve_features(df, again, FEATURES, keep=["record_id"]).withColumn("drv_high_card", F.round("drv_high_card", 9))
    assert a.columns == b.columns and a.exceptAll(b).count() == 0
    del doc["levels"]
    bare = artifacts.spec_from_document(spark, doc, train, "flagged")
    c = transforms.serve_features(df, bare, FEATURES, keep=["record_id"]).withColumn("drv_high_card", F.round("drv_high_card", 9))
    assert a.exceptAll(c).count() == 0


def test_other_documents(spark):
    agreement = spark.createDataFrame(
        [(1, "a", 0.9, 3, "Both"), (2, "b", 0.5, 3, "Tree"), (3, "c", 0.1, 3, "-")],
        "rank int, feature string, consensus double, n_methods int, agreement string",
    )
    doc = artifacts.selection_document(agreement, 2, ["IV"])
    assert doc["selected_features"] == ["a", "b"] and doc["tree_only"] == ["b"] and doc["consensus_scores"]["c"] == 0.1
    rows = spark.createDataFrame([("Train", 1), ("Train", 0), ("Train", 0), ("Test", 1), ("OOT", 0)], "g string, y int")
    split = artifacts.split_document(sampling.split_stats(rows, "g", "y"), ["a"])
    assert (split["n_train"], split["n_val"], split["n_test"], split["imbalance_ratio"]) == (3, 1, 1, 2.0)
    results = spark.createDataFrame([(2, "M2", "A", "S", "I"), (1, "M1", "A", "S", "I")],
                                    "rank int, model_label string, feature_set string, scaler string, imbalance string")
    got = artifacts.results_document(results)
    assert got["best_model"] == "M1" and got["total_experiments"] == 2 and len(got["ranking"]) == 2
    path = scratch_path(spark, "doc")
    artifacts.save_document(spark, got, path)
    assert artifacts.load_document(spark, path)["ranking"][1]["rank"] == 2
