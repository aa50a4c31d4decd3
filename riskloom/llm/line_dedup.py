"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys
of fewer than ``LEAST`` code points are left alone.  Documents come in batches of
ascending ids, so the first batch that has a key has its smallest document.

* A sorted run is a table of key hashes (128 bits), bucketed and sorted by them.
* Each new batch collapses its lines to one row per key (smallest and largest document,
  combined before the shuffle), merge-joins it with the runs, bucket by bucket, and
  marks the keys they hold.  The unmarked keys are the batch's own run at level 0; runs
  hold no key twice, so together they are one set.
* When a level has ``fan`` runs, they are merged into one of the next level: a batch
  meets at most ``fan`` runs a level, and a key is rewritten once a level.
* A line is dropped if the runs have its key or a smaller document of the batch has it.
  Of the batch's keys only those of two documents or more, or of an earlier batch, are
  joined back to lines.  Keys with more than one in ``HOT_SHARE`` of a batch's lines
  (so at most ``HOT_SHARE`` of them) are broadcast, so no key fills a task.

Only places of dropped lines go back to their documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm.decontaminate import lowered
from riskloom.sources.scratch import drop_scratch, finished, materialise, scratch_path

LEAST = 10
BATCHES = 4
FAN = 2
HOT_SHARE = 256
# Ids that the cuts between batches are chosen from.
CUT_SAMPLE = 4_096
ROWS_A_BUCKET = 200_000
MOST_BUCKETS = 50_000
SPACE = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def text_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, digest (of the text), at (place of the line, from 0), h1, h2 of every line with a key of ``LEAST`` code points."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), F.split(lowered(text), "\n").alias("lines"))
    keys = rows.select("id", "digest", F.posexplode("lines").alias("at", "line")).select("id", "digest", "at", line_key(F.col("line")).alias("key"))
    return keys.filter(F.length("key") >= LEAST).select("id", "digest", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


@dataclass
class SortedRuns:
    """The runs by level, newest last, as bucketed tables in the shared scratch folder."""

    spark: SparkSession
    buckets: int
    fan: int = FAN
    levels: list[list[DataFrame]] = field(default_factory=list)
    places: dict[int, tuple[str, str]] = field(default_factory=dict)

    def _written(self, keys: DataFrame) -> DataFrame:
        name, path = f"riskloom_run_{uuid4().hex}", scratch_path(self.spark, "run")
        keys.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        table = self.spark.table(name)
        self.places[id(table)] = (name, path)
        return table

    def _dropped(self, table: DataFrame) -> None:
        name, path = self.places.pop(id(table))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_scratch(self.spark, path)

    def add(self, keys: DataFrame) -> DataFrame:
        """``keys`` (h1, h2 and others, one row per key) with ``seen``: an earlier batch had it.  The rest becomes a run."""
        keys = keys.repartition(self.buckets, *HASH)
        seen = F.lit(False)
        for k, run in enumerate([run for level in self.levels for run in level]):
            held = run.filter("not seen").select(*HASH, F.lit(True).alias(f"run{k}"))
            keys = keys.join(held.hint("merge"), HASH, "left")
            seen = seen | F.coalesce(F.col(f"run{k}"), F.lit(False))
        keys = keys.withColumn("seen", seen).drop(*[c for c in keys.columns if c.startswith("run")])
        table = self._written(keys)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(table)
        return table

    def compact(self) -> None:
        """Merge the runs of every full level into one of the next."""
        for k, level in enumerate(self.levels):
            if len(level) < self.fan:
                continue
            merged = level[0].filter("not seen").select(*HASH, "seen")
            for run in level[1:]:
                merged = merged.unionByName(run.filter("not seen").select(*HASH, "seen"))
            table = self._written(merged.repartition(self.buckets, *HASH))
            for run in level:
                self._dropped(run)
            self.levels[k] = []
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(table)

    def close(self) -> None:
        for level in self.levels:
            for run in level:
                self._dropped(run)
        self.levels = []


def dropped_lines(runs: SortedRuns, lines: DataFrame) -> DataFrame:
    """id, digest, at of the lines of one batch that go; the batch's keys join ``runs``.

    ``lines`` is a written table of ``text_lines``.  The result is written.
    """
    keys = lines.groupBy(*HASH).agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    keys = runs.add(keys)
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = max(total // HOT_SHARE, 64)  # fewer than HOT_SHARE keys have more lines
    held = keys.filter("seen or first < last").select(*HASH, "first", "seen", "n")
    hot, rest = held.filter(F.col("n") > often).drop("n"), held.filter(F.col("n") <= often).drop("n")
    goes = F.col("seen") | (F.col("id") > F.col("first"))
    of_hot = lines.join(F.broadcast(hot), HASH)
    of_rest = lines.join(F.broadcast(hot.select(*HASH)), HASH, "left_anti").join(rest.hint("merge"), HASH)
    out = [part.filter(goes).select("id", "digest", "at") for part in (of_hot, of_rest)]
    return materialise(out[0].unionByName(out[1]), "dropped")


def batch_cuts(docs: DataFrame, id_col: str, batches: int) -> list:
    """Ids at which batches after the first begin, from at most ``CUT_SAMPLE`` ids; they only set the batches' sizes."""
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null")
    drawn = sorted(r["id"] for r in ids.orderBy(F.xxhash64("id"), "id").limit(CUT_SAMPLE).collect())
    return sorted({drawn[len(drawn) * k // batches] for k in range(1, batches)}) if drawn else []


def _runs_and_drops(docs: DataFrame, id_col: str, text_col: str, batches: int, fan: int) -> DataFrame:
    spark = docs.sparkSession
    cuts = batch_cuts(docs, id_col, batches)
    number = sum([(F.col("id") >= F.lit(cut)).cast("int") for cut in cuts], F.lit(0))
    lines = text_lines(docs, id_col, text_col).withColumn("batch", number)
    path = scratch_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    buckets = max(8, min(docs.count() // ROWS_A_BUCKET, MOST_BUCKETS))
    runs = SortedRuns(spark, buckets, fan)
    schema = lines.drop("batch").schema
    try:
        drops = []
        written = spark.read.schema(lines.schema).parquet(path)
        for k in range(len(cuts) + 1):
            batch = written.filter(F.col("batch") == k).select(*schema.names)
            drops.append(dropped_lines(runs, batch))
            runs.compact()
    finally:
        runs.close()
    out = drops[0]
    for more in drops[1:]:
        out = out.unionByName(more)
    return out.groupBy("id", "digest").agg(F.collect_set("at").alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """doc_id, n_lines, n_dropped and text (the kept lines, joined by a line feed) of every row.

    A line goes if its key has ``LEAST`` code points and a document with a smaller id
    holds the key.  Ids may be of any type with an order; rows with equal ids are one
    document for this and keep their own texts; rows with a NULL id hold nothing and
    keep all their lines.  NULL and empty texts are one empty line; an empty table
    gives an empty result.  Only the id and text columns are read.
    """
    gone = finished(lambda: _runs_and_drops(docs, id_col, text_col, batches, fan), "gone")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    gone = gone.select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"), "gone")
    rows = rows.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")), "left")
    rows = rows.select("doc_id", "text", "gone", F.split("text", "\n").alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.array_join(F.transform(kept, lambda k: F.get("lines", k)), "\n")
    return rows.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
    )
