"""Language identification by a string kernel.

Texts are cut into segments.  The blended-spectrum presence kernel of two segments
sums, over n-gram lengths 1 to ``N``, the n-grams present in both, normalised by the
numbers of all n-grams present in each.  Only n-grams that a landmark has can be
present in both, so their dictionary gives the whole kernel.  Landmark
segments give a Nyström map, kernel ridge regression is fitted one-versus-rest, and
a batch of segments is scored by two matrix products: segments x n-grams by n-grams
x landmarks, then landmarks x languages.  A text's score is the mean over its
segments, softmaxed, so a passage in another language moves it by its share.

The training segments are a bounded sample: ``PER_LANGUAGE`` documents of each
language, one segment of each at a place given by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import fold
from riskloom.sources.scratch import small_table

N = 3
SEGMENT = 1024
PER_LANGUAGE = 300
# Up to so many languages their counts are broadcast.
LANGUAGES = 1_000
LANDMARKS = 96
RIDGE = 1e-2
SHARPNESS = 4.0
UNKNOWN = "und"
# Slots of the table that maps an n-gram's hash to its dictionary place.
SLOTS = 1 << 20
ROWS = 128

_LETTER = regex.compile(r"\p{L}")
_MULTIPLIER = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_slots(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash slot for the n-gram at each character; n-grams of different lengths differ by a constant."""
    keys = np.full(max(len(codes) - n + 1, 0), np.uint32(n * 7919), np.uint32)
    for k in range(n):
        keys = (keys ^ codes[k : len(codes) - n + 1 + k]) * _MULTIPLIER[k % 3]
        keys ^= keys >> np.uint32(15)
    return keys & np.uint32(SLOTS - 1)


def segments(length: int, size: int = SEGMENT) -> list[tuple[int, int]]:
    """Equal cuts of a text, about ``size`` characters each, that cover all of it."""
    n = max(round(length / size), 1)
    return [(length * k // n, length * (k + 1) // n) for k in range(n)]


@dataclass
class Model:
    languages: list[str]
    place: np.ndarray  # slot -> dictionary place, -1 where the dictionary has none
    order: np.ndarray  # dictionary place -> n-gram length
    landmarks: np.ndarray  # dictionary x landmarks, normalised
    weights: np.ndarray  # landmarks x languages

    def presence(self, texts: list[np.ndarray]) -> np.ndarray:
        """Presence of each dictionary n-gram in each segment, over the root of all n-grams of its length present there."""
        out = np.zeros((len(texts), len(self.order)), np.float32)
        for row, codes in zip(out, texts):
            for n in range(1, N + 1):
                present = np.unique(gram_slots(codes, n))
                found = self.place[present]
                row[found[found >= 0]] = 1 / np.sqrt(max(len(present), 1))
        return out

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        kernel = self.presence(texts) @ self.landmarks
        return kernel @ self.weights

    def texts(self, texts: list[str]) -> np.ndarray:
        """Softmaxed mean score of each text over its segments."""
        total = np.zeros((len(texts), len(self.languages)))
        counts = np.ones((len(texts), 1))
        cuts: list[np.ndarray] = []
        owners: list[int] = []

        def flush() -> None:
            np.add.at(total, owners, self.scores(cuts))
            cuts.clear()
            owners.clear()

        for k, text in enumerate(texts):
            codes = characters(text)
            parts = segments(len(codes))
            counts[k] = len(parts)
            for a, b in parts:
                cuts.append(codes[a:b])
                owners.append(k)
                if len(cuts) == ROWS:
                    flush()
        if cuts:
            flush()
        mean = total / counts
        shaped = np.exp(SHARPNESS * (mean - mean.max(axis=1, keepdims=True)))
        return shaped / shaped.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[str, str]], landmarks: int = LANDMARKS) -> Model | None:
    """Model from (segment, language) pairs in a fixed order; None without any."""
    samples = [(text, lang) for text, lang in samples if _LETTER.search(text)]
    if not samples:
        return None
    languages = sorted({lang for _, lang in samples})
    by = {lang: [characters(text) for text, own in samples if own == lang] for lang in languages}
    chosen = [cut for lang in languages for cut in by[lang][: max(landmarks // len(languages), 1)]]
    slots = [np.unique(np.concatenate([gram_slots(cut, n) for cut in chosen])) for n in range(1, N + 1)]
    place = np.full(SLOTS, -1, np.int32)
    order = []
    for n, own in enumerate(slots, 1):
        own = own[place[own] < 0]  # a slot that a shorter n-gram has is that n-gram's
        place[own] = len(order) + np.arange(len(own))
        order += [n] * len(own)
    model = Model(languages, place, np.array(order), np.zeros((len(order), 0), np.float32), np.zeros((0, 0)))
    marks = model.presence(chosen).T
    values, vectors = np.linalg.eigh((marks.T @ marks).astype(float))
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max()))
    texts = [cut for lang in languages for cut in by[lang]]
    own = np.repeat(np.arange(len(languages)), [len(by[lang]) for lang in languages])
    mapped = (model.presence(texts) @ marks).astype(float) @ root
    # every language weighs the same, however many documents it has
    weight = (1.0 / np.bincount(own))[own][:, None]
    targets = np.where(own[:, None] == np.arange(len(languages)), 1.0, -1.0)
    gram = mapped.T @ (weight * mapped) + RIDGE * np.eye(mapped.shape[1])
    model.landmarks = marks.astype(np.float32)
    model.weights = (root @ np.linalg.solve(gram, mapped.T @ (weight * targets))).astype(np.float32)
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on a sample of the rows with a text, a language and an id outside the held-out fold."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & (fold("id") != 0))
    h = F.xxhash64("id")
    at = F.pmod(h, F.greatest(F.length("text") - SEGMENT, F.lit(0)) + 1).cast("int") + 1
    cut = rows.select("lang", "id", h.alias("h"), F.substring("text", at, F.lit(SEGMENT)).alias("cut"))
    # by a hash threshold about twice as many as needed remain of each language, so that none fills one task;
    # should the threshold be unlucky for a rare language, all its rows remain
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows")).withColumnRenamed("lang", "own")
    known = sizes.limit(LANGUAGES + 1).collect()
    if len(known) <= LANGUAGES:  # then no row is shuffled to be thinned
        sizes = F.broadcast(small_table(docs.sparkSession, [tuple(r) for r in known], "own string, rows bigint"))
    share = (F.col("h") / 2.0**64 + 0.5) * F.col("rows") <= F.lit(2.0 * per_language)
    cut = cut.join(sizes, F.col("lang") == F.col("own")).filter(share | (F.col("rows") <= 20 * per_language)).drop("own", "rows")
    first = W.partitionBy("lang").orderBy("h", "id", "cut")
    sample = cut.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_language)
    got = sorted((r["lang"], r["h"], r["id"], r["cut"]) for r in sample.collect())
    return fit([(text, lang) for lang, _, _, text in got])


def predict(text: Column | str, model: Model | None, spark) -> Column:
    """struct(lang, score) of each whole text: ``und`` with score 0 for NULL, no letter or no model."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            texts = batch.tolist()
            known = [k for k, t in enumerate(texts) if own is not None and t and _LETTER.search(t)]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                shares = own.texts([texts[k] for k in known])
                best = shares.argmax(axis=1)
                for k, b in zip(known, best):
                    langs[k] = own.languages[b]
                scores[known] = shares[np.arange(len(known)), best]
            yield pd.DataFrame({"lang": langs, "score": scores})

    return judge(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    A NULL text or one without a letter is ``und`` with score 0; NULL languages are
    not learned; repeated rows get equal results; an empty table gives an empty
    result.  No column but the id, text and language is read.
    """
    model = train(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    judged = rows.select("doc_id", (fold("doc_id") == 0).alias("held_out"), predict("text", model, docs.sparkSession).alias("r"))
    return judged.select("doc_id", "held_out", F.col("r.lang").alias("lang_pred"), F.col("r.score").alias("score"))
