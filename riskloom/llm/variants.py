"""Spelling variants: words one edit apart, by a bit-sliced position index over blocks of the vocabulary.

* Blocks.  A pair of words one insertion, deletion or replacement apart is looked for
  under its shorter length L, in the interval [a, b) of the shorter word in which the
  edit lies: all letters before a and from b on are the same.  At first the interval is
  the whole word; it is halved once, and again while a block (words with the same L,
  interval and letters outside it) has more than ``BLOCK`` words.  So blocks stay small
  whatever the vocabulary is: an interval of one letter bounds a block by the square
  of the alphabet.  An edit that fits both halves counts for the left one, so every
  pair is found in exactly one block.
* Index.  For the letters inside the interval, a bitset over the block's words per
  (position, letter).
* Recurrences.  Each word runs through the index once.  Three bitsets go along: words
  equal so far, words with one replaced letter so far (same positions), and words with
  one letter more so far (positions shifted by one).  Each step is a few operations on
  whole bitsets, so all words of the block are compared at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.decontaminate import LOWER, UPPER
from riskloom.sources.scratch import finished, materialise

BLOCK = 2_048
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A near word this many times as frequent is a word's form.
FORM_RATIO = 2
NOT_LETTERS = "[^A-Za-zÀ-ÿ]+"
_CAPITALS = "[À-Þ]"


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, run: every maximal run of the letters, A-Z lower-cased."""
    text = F.col(text_col).cast("string")
    # without a capital beyond A-Z in the text, the fast built-in does the same to a run
    # computed before the explode, so that no row of a run carries its text
    rows = docs.select(F.col(id_col).alias("doc_id"), text.rlike(_CAPITALS).alias("capitals"), F.split(text, NOT_LETTERS).alias("runs"))
    rows = rows.select("doc_id", "capitals", F.explode("runs").alias("run"))
    run = F.when(F.col("capitals"), F.translate("run", UPPER, LOWER)).otherwise(F.lower("run"))
    return rows.filter("run <> ''").select("doc_id", run.alias("run"))


def with_planted_slips(runs: DataFrame, one_in: int = 97) -> DataFrame:
    """``runs`` with one letter deleted in every run whose crc32 of ``<doc_id>:<run>`` is divisible by ``one_in``."""
    h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run"))
    at = F.pmod(h, F.length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.withColumn("run", F.when(h % one_in == 0, slipped).otherwise(F.col("run")))


def vocabulary(runs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the runs of at least so many code points that occur so often, over all rows."""
    return runs.filter(F.length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _inside(word: Column, base: Column, low: Column, high: Column) -> tuple[Column, Column, Column]:
    """What lies before, in and behind the interval; a word longer than ``base`` has one letter more inside."""
    tail = base - high
    return F.substring(word, F.lit(1), low), F.substring(word, low + 1, F.length(word) - tail - low), F.substring(word, F.length(word) - tail + 1, tail)


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct(middle.alias("low"), F.col("high").alias("high")), F.struct(F.col("low").alias("low"), middle.alias("high")))
    out = rows.select("word", "n", "base", F.explode(halves).alias("part")).select("word", "n", "base", "part.low", "part.high")
    before, core, behind = _inside(*[F.col(c) for c in ("word", "base", "low", "high")])
    return out.filter("low < high").select("*", before.alias("before"), core.alias("core"), behind.alias("behind"))


KEY = ["base", "low", "high", "before", "behind"]
_SHORT = "length(word) = base"  # a block without such a word has no pair


def blocks(words: DataFrame, most: int = BLOCK) -> list[DataFrame]:
    """Tables of base, low, high, before, behind, words (core, word, n): blocks of two words or more, one of ``base`` letters."""
    n = F.length("word")
    bases = F.explode(F.filter(F.array(n, n - 1), lambda b: b >= 0)).alias("base")
    rows = words.select("word", "n", bases).select("word", "n", "base", F.lit(0).alias("low"), F.col("base").alias("high"))
    out = []
    while True:
        # a base of one letter or none cannot be halved: its only interval is the word
        halved = materialise(_halved(rows.filter("high - low > 1")).unionByName(_whole(rows.filter("high - low < 2"))), "halved")
        large = halved.filter("high - low > 1").groupBy(*KEY).agg(F.count("*").alias("size"), F.max(F.expr(_SHORT)).alias("short"))
        large = large.filter((F.col("size") > most) & F.col("short")).select(*KEY)
        large = materialise(large, "large")
        if large.isEmpty():
            return [*out, _gathered(halved)]
        out.append(_gathered(halved.join(large, KEY, "left_anti")))
        rows = halved.join(large, KEY, "left_semi").select("word", "n", "base", "low", "high")


def _whole(rows: DataFrame) -> DataFrame:
    before, core, behind = _inside(*[F.col(c) for c in ("word", "base", "low", "high")])
    return rows.select("word", "n", "base", "low", "high", before.alias("before"), core.alias("core"), behind.alias("behind"))


def _gathered(rows: DataFrame) -> DataFrame:
    grouped = rows.groupBy(*KEY).agg(F.collect_list(F.struct("core", "word", "n")).alias("words"), F.max(F.expr(_SHORT)).alias("short"))
    return grouped.filter((F.size("words") > 1) & F.col("short")).select("base", "low", "high", "words")


def near_in_block(cores: list[str], length: int, whole: bool) -> Iterator[tuple[int, int]]:
    """(places of) pairs of cores one edit apart: words of ``length`` and each other, or one letter longer.

    Both orders of each pair.  ``whole``: no letters lie behind the cores; else an edit
    that may as well lie behind them is not counted.
    """
    index: dict[tuple[int, str], int] = {}
    short = 0
    for k, core in enumerate(cores):
        bit = 1 << k
        if len(core) == length:
            short |= bit
        for place in enumerate(core):
            index[place] = index.get(place, 0) | bit
    every = (1 << len(cores)) - 1
    long = every & ~short
    get = index.get
    for k, core in enumerate(cores):
        if len(core) != length:
            continue
        equal = inserted = every
        replaced = 0
        for j, letter in enumerate(core):
            here = get((j, letter), 0)
            replaced = (replaced & here) | (equal & ~here)
            equal &= here
            inserted = (inserted & get((j + 1, letter), 0)) | equal
        found = replaced & short
        while found:
            low = found & -found
            yield k, low.bit_length() - 1
            found ^= low
        found = inserted & long
        if not whole:
            found &= ~equal
        while found:
            low = found & -found
            other = low.bit_length() - 1
            yield k, other
            yield other, k
            found ^= low


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"word": [], "n_near": [], "near_n": [], "near": []}
        for row in batch.to_pylist():
            words = row["words"]
            count = [0] * len(words)
            best: list[tuple[int, str] | None] = [None] * len(words)
            for k, other in near_in_block([w["core"] for w in words], row["high"] - row["low"], row["high"] == row["base"]):
                count[k] += 1
                w = words[other]
                key = (-w["n"], w["word"])
                if best[k] is None or key < best[k]:
                    best[k] = key
            for k in range(len(words)):
                if count[k]:
                    out["word"].append(words[k]["word"])
                    out["n_near"].append(count[k])
                    out["near_n"].append(-best[k][0])
                    out["near"].append(best[k][1])
        yield pa.RecordBatch.from_arrays([pa.array(out["word"], pa.string()), pa.array(out["n_near"], pa.int64()), pa.array(out["near_n"], pa.int64()), pa.array(out["near"], pa.string())], names=list(out))


def near_words(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """word, n_near, near, near_n: how many words are near, and the most frequent of them (ties: smallest)."""
    found = None
    for part in blocks(words, most):
        part = part.mapInArrow(_search, "word string, n_near bigint, near_n bigint, near string")
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word on each word's way over ``forms`` (word, form), by pointer doubling.

    A form is at least ``FORM_RATIO`` times as frequent as its word, so ways have no
    cycle and a logarithmic length, and the rounds are few.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(further, "root", "left")
        now = materialise(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = FORM_RATIO, most: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; each word once).

    ``form`` is the near word with the largest n (ties: the smallest in code-point
    order) if its n is at least ``ratio`` times the word's, else NULL; ``root`` is where
    forms lead to.  NULL words are near to none; an empty table gives an empty result;
    other columns are not read.
    """
    return finished(lambda: _variants(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("bigint").alias("n")), ratio, most), "variants")


def _variants(words: DataFrame, ratio: int, most: int) -> DataFrame:
    words = materialise(words, "words")
    near = near_words(words.filter("word is not null"), most)
    joined = words.join(near, "word", "left")
    close = F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False))
    rows = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(close, F.col("near")).alias("form"), F.when(close, F.col("near_n")).alias("form_n"))
    rows = materialise(rows, "forms")
    ends = roots(rows.filter("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
