"""Benchmark decontamination by a broadcast hash set of n-grams, in DataFrame functions only.

Words are maximal runs of ASCII letters and digits and of all characters from
U+0080 on, with A-Z lower-cased.  A benchmark window is ``window`` consecutive words
of an item, or a shorter item's words as a whole.

1. The distinct windows of the benchmark, as strings with their items and a 64-bit
   hash, are broadcast: at most ``BROADCAST_WINDOWS`` at a time.  A larger benchmark
   takes several rounds over the documents, so what is broadcast has a bound and
   document windows are never shuffled.
2. Each document is cut into pieces of ``PIECE`` words that overlap by a window less
   one word, and each piece into its windows (of every size that the benchmark has).
   So a task holds the windows of one piece only, also for very long texts.
3. Windows probe the set by hash, and hits are verified by the strings themselves:
   words hold no blank, so joined words are equal only if all words are.

Only hits leave their task, never a text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.sources.scratch import materialise

WINDOW = 13
# About 300 bytes each.
BROADCAST_WINDOWS = 200_000
PIECE = 4_096

# What separates words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased; texts of ASCII alone take the fast built-in, which is the same for them."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def exact_words(text: Column) -> Column:
    """The words, A-Z lower-cased; NULL has none."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _windows(words: Column, first: Column, last: Column, size) -> Column:
    """Places from ``first`` to ``last`` (none if smaller) with the ``size`` words from there, joined."""
    places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.array_join(F.slice(words, i + 1, size), " ").alias("s")))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """h, s, size and items (sorted) of each distinct window; s: its words joined by blanks, h: the hash of s."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), exact_words(F.col(text_col)).alias("w"))
    items = items.filter((F.size("w") > 0) & F.col("item").isNotNull())
    found = _windows(F.col("w"), F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(window))
    rows = items.select("item", F.least(F.size("w"), F.lit(window)).alias("size"), F.explode(found).alias("x"))
    rows = rows.select("item", "size", F.col("x.s").alias("s"))
    return rows.groupBy("size", "s").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("h", F.xxhash64("s"))


def hit_windows(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = BROADCAST_WINDOWS) -> DataFrame:
    """id, digest, start (word, from 0), size and items of every occurrence of a window.

    ``digest`` is the hash of the text; with it, rows that share an id but not the text
    keep their own hits.  ``windows`` is read a few times.
    """
    sizes = sorted(windows.groupBy("size").count().collect())  # one row per size, at most ``window``
    rounds = max(1, -(-sum(r["count"] for r in sizes) // most))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("digest"), exact_words(F.col(text_col)).alias("w"))
    reach = max((r["size"] for r in sizes), default=1) - 1
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(PIECE))
    pieces = F.transform(starts, lambda i: F.struct(i.alias("from"), F.slice("w", i + 1, F.lit(PIECE + reach)).alias("p")))
    rows = rows.select("id", "digest", F.explode(pieces).alias("x")).select("id", "digest", "x.from", "x.p")
    out = []
    for r in sizes:
        size = r["size"]
        last = F.least(F.size("p") - size, F.lit(PIECE - 1))
        here = rows.select("id", "digest", "from", F.explode(_windows(F.col("p"), F.lit(0), last, F.lit(size))).alias("x"))
        here = here.select("id", "digest", (F.col("from") + F.col("x.at")).alias("start"), F.lit(size).alias("size"), F.col("x.s").alias("found"))
        here = here.withColumn("found_h", F.xxhash64("found"))
        for k in range(rounds):
            near = windows.filter((F.col("size") == size) & (F.pmod(F.col("h"), F.lit(rounds)) == k)).select("h", "s", "items")
            hits = here.join(F.broadcast(near), (F.col("found_h") == F.col("h")) & (F.col("found") == F.col("s")))
            out.append(hits.select("id", "digest", "start", "size", "items"))
    if not out:
        return rows.select("id", "digest", F.lit(0).alias("start"), F.lit(0).alias("size"), F.array().cast("array<string>").alias("items")).filter("false")
    return reduce(DataFrame.unionByName, out)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Contaminated: at least one word in twenty is hit.  NULL texts have no words and
    are clean; items without words have no window; rows with equal ids keep their own
    results; empty tables on either side give no hits.  Other columns are not read.
    """
    windows = materialise(benchmark_windows(benchmark, window=window), "windows")
    found = hit_windows(docs, windows, id_col, text_col, BROADCAST_WINDOWS)
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1))))
    hits = found.groupBy(F.col("id").alias("hit_id"), F.col("digest").alias("hit_digest")).agg(
        F.size(covered).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    text = _text(text_col)
    parts = F.split(text, SEPARATORS)
    ends = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    all_docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), (F.size(parts) - ends).cast("bigint").alias("n_words"))
    joined = all_docs.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = joined.select(
        "doc_id",
        "digest",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
    return out if with_digest else out.drop("digest")


def without_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Each row is judged by its own text: of rows with equal ids, NULL among them, only
    those whose text is contaminated go.
    """
    found = contamination(docs, benchmark, id_col, text_col, window, with_digest=True)
    bad = found.filter("contaminated").select(F.col("doc_id").alias("_bad"), F.col("digest").alias("_bad_digest")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]) & (F.xxhash64(_text_of(docs, text_col)) == bad["_bad_digest"]), "left_anti")


def _text_of(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))
