"""The pipeline's stages against their operators' own results, one after another."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from riskloom.llm import decontaminate, langid, minhash, toxicity
from riskloom.llm.common import table
from riskloom.llm.queries import ORACLES, REGISTRY
from riskloom.sources.scratch import materialise

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    rules = [
        lambda d: toxicity.score_documents(d, table(spark, SF, "labels")).filter("predicted = 0"),
        lambda d: langid.identify(d).filter(f"lang_pred <> 'und' and score >= {corpus_pipeline.LEAST_LANGUAGE}"),
        lambda d: minhash.near_duplicates(d).filter("doc_id = class_id"),
        lambda d: decontaminate.contamination(d, table(spark, SF, "benchmark")).filter("not contaminated"),
    ]
    for (name, stage), rule in zip(corpus_pipeline.STAGES, rules):
        kept = materialise(stage(spark, docs, SF), name)
        assert kept.columns == docs.columns and ids(kept) == ids(rule(docs)), name
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r["doc_id"] for r in packed.filter("piece = 0").collect()) == ids(docs)
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_stages_awkward(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _kept int, _bad int, score int"
    rows = [(1, None, "en", "s", 1, 1, 1, 1), (None, "no id here", "en", "s", 1, 1, 1, 1), (2, "", None, None, None, 1, 1, 1)]
    rows += [(3, "some words of a text", "en", "s", 1, 1, 1, 1)] * 2 + [(4, "!!!", "en", "s", 1, 1, 1, 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF), name)
            assert docs.columns == [f.split()[0] for f in schema.split(", ")]
        if data:
            assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["3", "None"]
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_registered():
    found = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {name[: name.index("_") + 1] for name in found if name.startswith("op")}
    assert "pipeline" in found and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = REGISTRY[name](spark, SF).toPandas()
    expected = con.sql(ORACLES[name]).df()[list(got.columns)]
    order = list(got.columns)
    a, b = (df.sort_values(order).reset_index(drop=True) for df in (got, expected))
    assert (a == b).all().all() and len(a) == len(b)
