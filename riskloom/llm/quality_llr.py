"""Quality rules: repetition and symbol counts, and a log-likelihood ratio of hashed n-grams.

Words and pairs of adjacent words are hashed to ``BUCKETS`` buckets.  Two smoothed
multinomials over the buckets are counted, one of trusted documents (all that are
labelled good) and one of the whole raw corpus.  A document's score is the mean log
ratio of its n-grams.  It is kept if its score reaches the threshold that best separates
all labelled documents, found by running counts over their distinct scores, so the same
tables always give the same verdicts.  For the threshold, trusted documents are scored
without their own n-grams in the trusted counts, as any other document is.

Texts are not shuffled: labelled ids are broadcast, ``ROUND`` of them at a time, each
time to one more pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import batch_words, labelled_ids, mix, steps, sums, word_hashes
from riskloom.operators.kernels import union_all, with_prefix
from riskloom.sources.scratch import materialise

BUCKETS = 1 << 16
PRIOR = 0.5
# Labelled ids that are broadcast at once; further ones take further passes.
ROUND = 500_000
WINDOW = 8

# The symbols that count, and what separates words.
SYMBOLS = r"[#*$%&|<>]"
SPACE = " \t\n\v\f\r"


def n_grams(codes: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs inside one text, each followed by a flag whether the pair is real."""
    words = hashes[codes]
    pairs = mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) else words
    inside = np.ones(max(len(words) - 1, 0), bool)
    last = bounds[1:-1] - 1
    inside[last[(last >= 0) & (last < len(inside))]] = False
    grams = np.concatenate([words, pairs]) & np.uint64(BUCKETS - 1)
    return grams.astype(np.int64), inside


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw = np.zeros(BUCKETS, np.int64)
    trusted = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for at, to in steps(batch.column(0)):
            codes, words, bounds = batch_words(batch.column(0)[at:to])
            grams, inside = n_grams(codes, word_hashes(words), bounds)
            good = np.repeat(batch.column(1)[at:to].to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
            real = np.concatenate([np.ones(len(codes), bool), inside])
            good = np.concatenate([good, good[:-1]])
            raw += np.bincount(grams[real], minlength=BUCKETS)
            trusted += np.bincount(grams[real & good], minlength=BUCKETS)
    met = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(trusted[met]), pa.array(raw[met])], names=["bucket", "trusted", "raw"])


def _rounds(ids: DataFrame) -> list[DataFrame]:
    """All of ``ids`` (doc_id, ...) in parts of about ``ROUND`` rows, by a hash of the id."""
    parts = max(1, -(-ids.count() // ROUND))
    return [ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == k) for k in range(parts)] if parts > 1 else [ids]


def bucket_counts(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """N-grams of each bucket in trusted documents and in all.

    ``trusted_ids`` (doc_id) may be of any size; every row of ``docs`` counts as raw.
    """
    counts = np.zeros((BUCKETS, 2))
    trusted_ids = materialise(trusted_ids.select("doc_id").distinct(), "trusted")
    for k, part in enumerate(_rounds(trusted_ids)):
        ids = F.broadcast(part.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_good")))
        rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))
        # the first pass counts all rows, others their trusted ones
        rows = rows.join(ids, F.col("_doc") == F.col("_id"), "inner" if k else "left")
        rows = rows.select("_text", F.coalesce("_good", F.lit(False)).alias("_good"))
        counted = rows.mapInArrow(_counter, "bucket bigint, trusted bigint, raw bigint")
        for bucket, trusted, raw in counted.groupBy("bucket").agg(F.sum("trusted"), F.sum("raw")).collect():  # BUCKETS rows at most
            counts[bucket] += trusted, 0 if k else raw
    return counts


def ratios_of(counts: np.ndarray) -> np.ndarray:
    """log trusted probability - log raw probability of each bucket; all 0 without any trusted or raw n-gram."""
    if not counts.sum(axis=0).all():
        return np.zeros(BUCKETS)
    smooth = np.log(counts + PRIOR) - np.log(counts.sum(axis=0) + PRIOR * BUCKETS)
    return smooth[:, 0] - smooth[:, 1]


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    return ratios_of(bucket_counts(docs, trusted_ids, id_col, text_col))


def without_own(counts: np.ndarray, grams: np.ndarray, text: np.ndarray, good: np.ndarray) -> np.ndarray:
    """What the ratio of each n-gram changes by when its text, if ``good``, is taken out of the trusted counts."""
    out = np.zeros(len(grams))
    own = np.flatnonzero(good[text])
    if not len(own):
        return out
    _, group, n = np.unique(text[own] * BUCKETS + grams[own], return_inverse=True, return_counts=True)
    size = np.bincount(text[own], minlength=len(good))[text[own]]
    total, held = counts[:, 0].sum(), counts[grams[own], 0]
    left = np.log(np.maximum(held - n[group], 0) + PRIOR) - np.log(np.maximum(total - size, 0) + PRIOR * BUCKETS)
    out[own] = left - (np.log(held + PRIOR) - np.log(total + PRIOR * BUCKETS))
    return out


def repeated_words(codes: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text in windows that the text holds twice or more."""
    n = len(codes)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    covered = np.zeros(n + 1, np.int64)
    if n >= window:
        keys = mix(text[: n - window + 1].astype(np.uint64) + np.uint64(1))
        for k in range(window):
            keys = mix(keys * np.uint64(0x100000001B3) + codes[k : n - window + 1 + k].astype(np.uint64))
        starts = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
        order = starts[np.argsort(keys[starts], kind="stable")]
        same = np.concatenate([[False], keys[order][1:] == keys[order][:-1], [False]])
        twice = order[(same[:-1] | same[1:])[: len(order)]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + window, -1)
    return sums((np.cumsum(covered[:-1]) > 0).astype(np.int64), bounds)


def _features(shared, left_out: bool = False):
    """Counts and scores of the texts; ``left_out``: with the label, those labelled 1 with their own n-grams taken out."""
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", *(["label"] if left_out else [])]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        table = ratios_of(counts)
        for batch in batches:
            for at, to in steps(batch.column(1)):
                texts = pc.fill_null(batch.column(1)[at:to], "")
                codes, words, bounds = batch_words(texts)
                n_words = np.diff(bounds)
                lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
                repeats = []
                for text in texts.to_pylist():
                    lines = [line for line in text.split("\n") if line.strip(SPACE)]
                    repeats.append(len(lines) - len(set(lines)))
                grams, inside = n_grams(codes, word_hashes(words), bounds)
                values = table[grams]
                if left_out:
                    text = np.repeat(np.arange(len(texts)), n_words)
                    of = np.concatenate([text, text[:-1]])
                    real = np.concatenate([np.ones(len(codes), bool), inside])
                    good = batch.column(2)[at:to].to_numpy(zero_copy_only=False) == 1
                    values[real] += without_own(counts, grams[real], of[real], good)
                pairs = np.concatenate([np.where(inside, values[len(codes) :], 0), [0]])[: len(codes)]
                total = sums(values[: len(codes)] + pairs, bounds)
                n_grams_of = np.maximum(2 * n_words - 1, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[at:to],
                        pa.array(n_words),
                        pa.array(sums(lengths[codes], bounds)),
                        pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64()),
                        pa.array(repeats, pa.int64()),
                        pa.array(repeated_words(codes, bounds)),
                        pa.array(total / n_grams_of),
                        *([batch.column(2)[at:to]] if left_out else []),
                    ],
                    names=names,
                )

    return score


def best_threshold(judged: DataFrame, good_weight: float = 10.0) -> float:
    """The middle of the gap between two scores at which the errors weigh least; a lost good document weighs more.

    ``judged`` has (score, label) of any number of documents.  Of equal choices the widest
    gap wins.  Without labelled documents of both classes nothing is rejected.
    """
    good, bad = (F.count(F.when((F.col("label") == 1) == side, 1)) for side in (True, False))
    each = judged.groupBy("score").agg(good.alias("n_good"), bad.alias("n_bad"))
    running = {"good": F.col("n_good"), "bad": F.col("n_bad"), "place": F.lit(1).cast("bigint")}
    cuts = materialise(with_prefix(each, [F.col("score")], running), "cuts")
    most = cuts.agg(*[F.max(c).alias(c) for c in running]).first()
    if not most["good"] or not most["bad"] or most["place"] < 2:
        return -np.inf
    following = cuts.select((F.col("place") - 1).alias("place"), F.col("score").alias("to"))
    cost = F.lit(good_weight) * F.col("good") + F.lit(most["bad"]) - F.col("bad")
    cut = cuts.join(following, "place").orderBy(cost, F.desc(F.col("to") - F.col("score")), "score").first()
    return (cut["score"] + cut["to"]) / 2


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score of every row.

    NULL and texts without a word have zeros, score 0, and fail the base rule; rows
    with equal ids are each judged by their own text; an empty table gives an empty
    result.  Only the id and text columns are read.
    """
    known = materialise(labelled_ids(labels, "quality"), "labelled")
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(bucket_counts(docs, known.filter("label = 1"), id_col, text_col))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, score double"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(_features(counts), schema)
    n = F.col("n_words")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    judged = []
    for part in _rounds(known):
        marks = F.broadcast(part.select(F.col("doc_id").alias("known_id"), "label"))
        seen = rows.join(marks, F.col("doc_id") == F.col("known_id")).select("doc_id", "text", "label")
        own = seen.mapInArrow(_features(counts, True), f"{schema}, label int").filter(~failed)
        judged.append(materialise(own.select("score", "label"), "judged"))
    limit = best_threshold(union_all(judged))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("score") >= limit)).alias("kept"), "score",
    )
