"""Population stability over a stream: bin counts per event-time window, held in state.

State holds one count per open window, column and bin, so it does not grow with the
rows.  Every micro-batch writes the counts it changed, under its own number; counts only
grow, so the last number per window and bin is the whole count, and a batch that runs
again writes the same.  A window is forgotten once the watermark has passed it; rows
that come later than that are dropped and counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskloom.functions.scalar import half_up, quoted
from riskloom.operators.kernels import order_statistics, wide_aggregate
from riskloom.sources.scratch import materialise, small_table

Cuts = Mapping[str, Sequence[float]]


def base_cuts(base: DataFrame, columns: Sequence[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Per column the distinct values at ranks ceil(k n / n_bins), k = 1 .. n_bins - 1, of its n non-null rows."""
    counts = {c: v["n"] for c, v in wide_aggregate(base, columns, lambda c: {"n": F.count(c)}).items()}
    ranks = {c: [-(-k * n // n_bins) for k in range(1, n_bins)] for c, n in counts.items() if n}
    found = order_statistics(base, ranks, counts)
    return {c: sorted({float(found[(c, r)].value) for r in ranks.get(c, [])}) for c in columns}


def _bin(value: Column, cuts: Sequence[float]) -> Column:
    """How many cuts lie below a value; NULL is a bin of its own, -1."""
    below = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), lambda c: c < value))
    return F.when(value.isNull(), -1).otherwise(below)


def _cells(df: DataFrame, cuts: Cuts, keep: Sequence[Column] = ()) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), _bin(quoted(c).cast("double"), own).alias("bin")) for c, own in cuts.items()])
    return df.select(*keep, F.explode(cells).alias("c")).select("*", "c.feature", "c.bin").drop("c")


def psi_stream(
    stream: DataFrame, cuts: Cuts, event_time: str, window: str, watermark: str, out_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep bin counts per ``window`` of ``event_time`` under ``out_path``; the default trigger drains what is there and stops.

    ``watermark``: how much later than the newest row a row may come.  Rows without an
    event time are left out.
    """
    # a watermark takes no timestamp without a time zone
    timed = stream.withColumn(event_time, quoted(event_time).cast("timestamp")).where(quoted(event_time).isNotNull()).withWatermark(event_time, watermark)
    cells = _cells(timed, cuts, [quoted(event_time)])
    counts = cells.groupBy(F.window(quoted(event_time), window), "feature", "bin").count()

    def write(changed: DataFrame, batch: int) -> None:
        rows = changed.select(F.col("window.start").alias("window_start"), "feature", "bin", F.col("count").alias("n"))
        rows.write.mode("overwrite").parquet(f"{out_path}/batch={batch}")

    written = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return written.trigger(**(trigger or {"availableNow": True})).start()


def late_rows(query: StreamingQuery) -> int:
    """Cells (a row and a column) that came after their window was closed, over the progress the query remembers."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def window_counts(spark, out_path: str) -> DataFrame:
    """window_start, feature, bin, n as of the last micro-batch."""
    schema = "window_start timestamp, feature string, bin int, n bigint, batch bigint"
    rows = spark.read.schema(schema).option("basePath", out_path).parquet(f"{out_path}/batch=*")
    return rows.groupBy("window_start", "feature", "bin").agg(F.max_by("n", "batch").alias("n"))


def psi_by_window(base: DataFrame, counts: DataFrame, cuts: Cuts) -> DataFrame:
    """window_start, feature, n, psi of each window's rows against ``base``; shares are smoothed by half a row.

    Bins are those of the cuts, and the one of NULL where the base or the window has it.
    """
    spark = base.sparkSession
    wanted = [(c, b) for c, own in cuts.items() for b in range(len(own) + 1)]
    grid = small_table(spark, wanted, "feature string, bin int")
    known = _cells(base, cuts).groupBy("feature", "bin").agg(F.count("*").alias("n_base"))
    known = grid.join(known, ["feature", "bin"], "full").fillna(0, ["n_base"])
    counts = materialise(counts, "window-counts")
    windows = counts.select("window_start", "feature").distinct()
    both = windows.join(known, "feature").join(counts, ["window_start", "feature", "bin"], "full").fillna(0, ["n_base", "n"])
    w = W.partitionBy("window_start", "feature")  # bins of one column
    k = F.count("*").over(w).cast("double")
    p = (F.col("n_base") + F.lit(0.5)) / (F.sum("n_base").over(w) + 0.5 * k)
    q = (F.col("n") + F.lit(0.5)) / (F.sum("n").over(w) + 0.5 * k)
    terms = both.withColumn("_t", (q - p) * F.log(q / p))
    return terms.groupBy("window_start", "feature").agg(F.sum("n").alias("n"), half_up(F.sum("_t"), 6).alias("psi"))
