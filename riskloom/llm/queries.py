"""The corpus operators over the test tables: one query each, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import decontaminate, langid, line_dedup, lm_bloom, minhash, packing, periodic, quality_llr, token_counts, token_planes
from riskloom.llm import toxicity, url_tree, variants
from riskloom.llm.common import table
from riskloom.sources.scratch import scratch_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def add(f):
        REGISTRY[name] = f
        return f

    return add


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=0)


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op4_quality_llr")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_llr.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_url_tree")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judge_urls(table(spark, sf_dir, "pages"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", limit=1024)


@query("op8_token_planes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_planes.write_token_files(table(spark, sf_dir, "documents"), path, "word_bpe_49k.json", end_id=2)
    return token_planes.read_token_files(spark, path)


@query("op9_minhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    # classes alone: counting links inside a class takes work that grows with its square
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), count_links=False)


@query("op10_lm_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_bloom.lm_scores(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic.run_digests(periodic.periodic_runs(planted))


@query("op12_line_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = variants.with_planted_slips(variants.letter_runs(table(spark, sf_dir, "documents")))
    return variants.spelling_variants(variants.vocabulary(runs))


# Words as the contract has them; windows are compared as joined strings, since words hold no blank.
OP6 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), items AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM windows
), found AS (
  SELECT r, i, k, s
  FROM (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k))
  WHERE s IN (SELECT s FROM windows)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r
), who AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',')) AS items_sha256
  FROM (SELECT DISTINCT r, k, s FROM found) JOIN windows USING (k, s) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN who USING (r)
"""

# A key's code points are counted after stripping; the smallest document keeps all its lines of the key.
OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), cut AS (
  SELECT r, doc_id, i, lines[i] AS line,
    translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), owners AS (
  SELECT k, min(doc_id) AS owner FROM cut WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT r, doc_id, i, line, coalesce(doc_id > owner, false) AS gone FROM cut LEFT JOIN owners USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

ORACLES: dict[str, str] = {"op6_decontamination": OP6, "op12_line_dedup": OP12}
