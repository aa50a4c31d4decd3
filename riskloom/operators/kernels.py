"""Distributed building blocks the operators share.

* ``wide_aggregate``    many per-column aggregates, in selects small enough for codegen
* ``order_statistics``  exact values at given ranks, without sorting the rows
* ``ordered_cuts``      exact (value, tie) cut points, hence exact ntile without a window over rows
* ``unpivot_typed``     wide to long by type family
* ``with_prefix``       running totals and row numbers over one global order
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from riskloom.functions.scalar import quoted
from riskloom.sources.scratch import materialise, small_table, working_table

# spark.sql.codegen.maxFields is 100: a select beyond it loses whole-stage codegen.
AGGREGATES_PER_SELECT = 90
SKETCH_ACCURACY = 10_000
SUB_BUCKETS = 256
# Object hash aggregation falls back to sorting beyond 128 groups.
SKETCH_GROUPS = 100
MAX_LONG = 2**63 - 1


def wide_aggregate(
    df: DataFrame,
    columns: Sequence[str],
    build: Callable[[Column], Mapping[str, Column]],
) -> dict[str, dict[str, Any]]:
    """``{column: {name: value}}`` for the aggregates ``build(column)`` names.

    Columns are chunked so that each select stays within codegen limits; every
    column is read by exactly one chunk, so the scan volume does not grow.
    """
    if not columns:
        return {}
    names = list(build(quoted(columns[0])))
    per_select = max(1, AGGREGATES_PER_SELECT // len(names))
    out: dict[str, dict[str, Any]] = {}
    for start in range(0, len(columns), per_select):
        chunk = columns[start : start + per_select]
        aggs = []
        for i, c in enumerate(chunk):
            aggs += [e.alias(f"c{i}_{n}") for n, e in build(quoted(c)).items()]
        row = df.agg(*aggs).first()
        for i, c in enumerate(chunk):
            out[c] = {n: row[f"c{i}_{n}"] for n in names}
    return out


def wide_aggregate_frame(
    df: DataFrame,
    columns: Sequence[str],
    build: Callable[[Column], Mapping[str, Column]],
) -> DataFrame:
    """Lazy form of ``wide_aggregate``: one row per column, ``column`` first.

    One aggregate per chunk of columns, turned into rows by an inline array.
    """
    names = list(build(quoted(columns[0])))
    per_select = max(1, AGGREGATES_PER_SELECT // len(names))
    frames = []
    for start in range(0, len(columns), per_select):
        chunk = columns[start : start + per_select]
        structs = [
            F.struct(
                F.lit(start + i).alias("position"),
                F.lit(c).alias("column"),
                *[e.alias(n) for n, e in build(quoted(c)).items()],
            )
            for i, c in enumerate(chunk)
        ]
        frames.append(df.agg(F.array(*structs).alias("r")).select(F.inline("r")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def type_families(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type they unpivot to without losing a value."""
    by_name = {f.name: f.dataType for f in df.schema}
    families: dict[str, list[str]] = {}
    for c in columns:
        t = by_name[c]
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            kind = "bigint"
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            kind = "double"
        else:
            kind = "string"
        families.setdefault(kind, []).append(c)
    return families


def unpivot_typed(df: DataFrame, columns: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of (keep..., column, value) for columns of one type family."""
    cast = df.select(*[quoted(k) for k in keep], *[quoted(c).cast(kind).alias(c) for c in columns])
    return cast.unpivot([quoted(k) for k in keep], [quoted(c) for c in columns], "column", "value")


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of (column, value as text, count), NULL included; counts combine map-side."""
    frames = []
    for kind, cols in type_families(df, columns).items():
        counted = unpivot_typed(df, cols, kind).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
        frames.append(counted.select("column", F.col("value").cast("string").alias("value"), "count"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --------------------------------------------------------------------------
# exact order statistics


@dataclass(frozen=True)
class Ranked:
    """The value at a 1-based rank, with the rows strictly below and equal to it."""

    value: Any
    below: int
    equal: int


def long_values(df: DataFrame, columns: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of (keep..., column, value) for the non-null values."""
    return unpivot_typed(df, columns, kind, keep).where(F.col("value").isNotNull())


def number_families(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Numeric columns by the type they are compared in: integers stay exact, the rest is double."""
    out: dict[str, list[str]] = {}
    for kind, cols in type_families(df, columns).items():
        out.setdefault("bigint" if kind == "bigint" else "double", []).extend(cols)
    return out


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int],
    accuracy: int = SKETCH_ACCURACY,
) -> dict[tuple[str, int], Ranked]:
    """Exact values of numeric columns at 1-based ranks among their non-null rows.

    A quantile sketch (partial aggregation, no shuffle of rows) brackets each
    rank; the next pass counts rows before each bracket and keeps only values
    inside one, pre-aggregated per distinct value, so a value that fills a third
    of the table is still one row.  Those values are ordered slice by slice, the
    slices cut by a second sketch.  A rank its bracket misses is looked up over
    the whole range, so the result is exact whatever the sketches returned.
    """
    found: dict[tuple[str, int], Ranked] = {}
    for kind, cols in number_families(df, list(ranks)).items():
        found.update(
            long_order_statistics(long_values(df, cols, kind), kind, {c: ranks[c] for c in cols}, counts, accuracy)
        )
    return found


def long_order_statistics(
    long: DataFrame,
    kind: str,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int],
    accuracy: int = SKETCH_ACCURACY,
) -> dict[tuple[str, int], Ranked]:
    """``order_statistics`` over rows of (column, value), value of type ``kind`` and never NULL."""
    ranks = {c: sorted({r for r in rs if 1 <= r <= counts[c]}) for c, rs in ranks.items()}
    ranks = {c: rs for c, rs in ranks.items() if rs}
    if not ranks:
        return {}
    found = _resolve(long, kind, ranks, _brackets(long, ranks, counts, accuracy))
    missed = {c: [r for r in rs if (c, r) not in found] for c, rs in ranks.items()}
    missed = {c: rs for c, rs in missed.items() if rs}
    if missed:
        found.update(_resolve(long, kind, missed, {}))
    return found


def _brackets(
    long: DataFrame, ranks: Mapping[str, Sequence[int]], counts: Mapping[str, int], accuracy: int
) -> dict[str, list[tuple[Any, Any]]]:
    """Disjoint closed intervals per column that hold the wanted ranks, from one sketch per column."""
    out: dict[str, list[tuple[Any, Any]]] = {}
    columns = list(ranks)
    for start in range(0, len(columns), SKETCH_GROUPS):
        chunk = columns[start : start + SKETCH_GROUPS]
        wanted: dict[str, list[tuple[float, float]]] = {}
        for c in chunk:
            n = counts[c]
            slack = max(2.0 / accuracy, 3.0 / n)
            wanted[c] = [(max(0.0, r / n - slack), min(1.0, r / n + slack)) for r in ranks[c]]
        probs = sorted({p for pairs in wanted.values() for pair in pairs for p in pair})
        at = {p: i for i, p in enumerate(probs)}
        sketch = F.percentile_approx("value", F.array(*[F.lit(p) for p in probs]), accuracy)
        rows = long.where(F.col("column").isin(*chunk)).groupBy("column").agg(sketch.alias("q")).collect()
        for row in rows:
            c, q = row["column"], row["q"]
            pairs = sorted((q[at[lo]], q[at[hi]]) for lo, hi in wanted[c])
            merged = [pairs[0]]
            for lo, hi in pairs[1:]:
                if lo <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
                else:
                    merged.append((lo, hi))
            out[c] = merged
    return out


def _resolve(
    long: DataFrame, kind: str, ranks: Mapping[str, Sequence[int]], brackets: Mapping[str, list[tuple[Any, Any]]]
) -> dict[tuple[str, int], Ranked]:
    """Ranked values inside the brackets; a column without brackets is one bracket as a whole."""
    spark = long.sparkSession
    cols = list(ranks)
    rows = long.where(F.col("column").isin(*cols))
    if brackets:
        # columns x brackets, bounded by the schema.  A lookup in an array keeps
        # the generated code small however many columns there are; one CASE per
        # column would outgrow what the JVM compiles.
        spans = small_table(
            spark,
            [
                (c, [lo for lo, _ in brackets[c]], [hi for _, hi in brackets[c]]) if c in brackets else (c, None, None)
                for c in cols
            ],
            f"column string, los array<{kind}>, his array<{kind}>",
        )
        # even: before, between or after brackets; odd: inside one
        cell = F.expr("size(filter(los, x -> x <= value)) + size(filter(his, x -> x < value))")
        rows = rows.join(F.broadcast(spans), "column").select(
            "column", "value", F.when(F.col("los").isNull(), F.lit(1)).otherwise(cell).alias("cell")
        )
        rows = rows.select("column", "cell", F.when(F.col("cell") % 2 == 1, F.col("value")).alias("value"))
    else:
        rows = rows.select("column", F.lit(1).alias("cell"), "value")
    # columns x requested ranks, bounded by the schema
    wanted = F.broadcast(
        small_table(spark, [(c, int(r)) for c in cols for r in ranks[c]], "column string, rank bigint")
    )
    reached = (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("cnt"))
    counted = rows.groupBy("column", "cell", "value").agg(F.count(F.lit(1)).alias("cnt"))
    with working_table(counted, "values") as hist:
        hist = _with_sub(hist)
        order = W.partitionBy("column").orderBy("cell", "sub").rowsBetween(W.unboundedPreceding, -1)
        # at most SUB_BUCKETS rows per bracket
        subs = (
            hist.groupBy("column", "cell", "sub")
            .agg(F.sum("cnt").alias("cnt"))
            .withColumn("below", F.coalesce(F.sum("cnt").over(order), F.lit(0)))
            .join(wanted, "column")
            .where(reached)
            .select("column", "cell", "sub", F.col("below").alias("before"), "rank")
        )
        # at most one row per wanted rank
        within = W.partitionBy("column", "rank").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
        located = (
            hist.join(F.broadcast(subs), ["column", "cell", "sub"])
            .withColumn("below", F.col("before") + F.coalesce(F.sum("cnt").over(within), F.lit(0)))
            .where(reached)
        )
        got = located.where(F.col("cell") % 2 == 1).select("column", "rank", "value", "below", "cnt").collect()
    return {(r["column"], r["rank"]): Ranked(r["value"], r["below"], r["cnt"]) for r in got}


def _with_sub(hist: DataFrame) -> DataFrame:
    """Slices of each bracket with about as many distinct values each: a monotone split, infinite ends included."""
    probs = F.array(*[F.lit(i / SUB_BUCKETS) for i in range(1, SUB_BUCKETS)])
    inside = hist.where(F.col("cell") % 2 == 1).groupBy("column", "cell")
    edges = inside.agg(F.array_distinct(F.percentile_approx("value", probs, 4 * SUB_BUCKETS)).alias("edges"))
    # one row per bracket, bounded by the schema
    cut = hist.join(F.broadcast(edges), ["column", "cell"], "left")
    sub = F.expr("size(filter(edges, e -> e < value))")
    return cut.withColumn("sub", F.when(F.col("edges").isNull(), F.lit(0)).otherwise(sub)).drop("edges")


def quantile_ranks(n: int, q: float) -> tuple[int, int, float]:
    """Ranks around the linear-interpolated quantile, and the weight of the upper one."""
    h = (n - 1) * q
    lo = math.floor(h)
    return lo + 1, min(lo + 2, n), h - lo


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    qs: Sequence[float],
    counts: Mapping[str, int] | None = None,
    **options: Any,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column, exact; None where it has no value."""
    counts = counts or {c: v["n"] for c, v in wide_aggregate(df, columns, lambda x: {"n": F.count(x)}).items()}
    wanted = {c: [r for q in qs for r in quantile_ranks(counts[c], q)[:2]] for c in columns if counts[c]}
    at = order_statistics(df, wanted, counts, **options)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        if not counts[c]:
            out[c] = [None] * len(qs)
            continue
        values = []
        for q in qs:
            lo, hi, w = quantile_ranks(counts[c], q)
            a, b = float(at[c, lo].value), float(at[c, hi].value)
            values.append(a + (b - a) * w if a != b else a)
        out[c] = values
    return out


# --------------------------------------------------------------------------
# exact cut points of (value, tie) order


@dataclass(frozen=True)
class Cut:
    """Last element of a prefix: rows with c < value, or c = value and tie <= this tie."""

    value: Any
    tie: int | None

    def covers(self, c: Column, tie: Column) -> Column:
        if self.tie is None:
            return c <= F.lit(self.value)
        return (c < F.lit(self.value)) | ((c == F.lit(self.value)) & (tie <= F.lit(self.tie)))


def ordered_cuts(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int],
    tie: str,
    **options: Any,
) -> dict[str, dict[int, Cut]]:
    """Cut point after each rank of the order (column, tie).

    ``tie`` names a bigint column, unique per row.  Where a cut falls inside a run
    of equal values, the tie value at the remaining rank is found the same way,
    among the rows of that run only.
    """
    out: dict[str, dict[int, Cut]] = {}
    for kind, cols in number_families(df, list(ranks)).items():
        at = order_statistics(df, {c: ranks[c] for c in cols}, counts, **options)
        runs = {f"{c}#{r}": (c, r, x) for (c, r), x in at.items() if r != x.below + x.equal}
        ties: dict[tuple[str, int], int] = {}
        if runs:
            # columns x cuts, bounded by the schema
            table = small_table(df.sparkSession, 
                [(c, x.value, name) for name, (c, _, x) in runs.items()], f"column string, value {kind}, run string"
            )
            renamed = df.select(
                quoted(tie).cast("bigint").alias("_tie"), *[quoted(c) for c in cols]
            )
            members = (
                long_values(renamed, cols, kind, ["_tie"])
                .join(F.broadcast(table), ["column", "value"])
                .select(F.col("run").alias("column"), F.col("_tie").alias("value"))
            )
            got = long_order_statistics(
                members,
                "bigint",
                {name: [r - x.below] for name, (_, r, x) in runs.items()},
                {name: x.equal for name, (_, _, x) in runs.items()},
                **options,
            )
            for (name, _), x in got.items():
                ties[runs[name][:2]] = x.value
        for (c, r), x in at.items():
            out.setdefault(c, {})[r] = Cut(x.value, ties.get((c, r)))
    return out


def binned_long(
    df: DataFrame, columns: Sequence[str], cuts: Mapping[str, Sequence[Cut]], tie: str | None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of (keep..., column, bin): bin = 1 + cut points the row lies beyond; NULL values are left out."""
    spark = df.sparkSession
    frames = []
    for kind, cols in number_families(df, columns).items():
        tied = F.lit(0) if tie is None else quoted(tie)
        staged = df.select(
            *[quoted(k) for k in keep], tied.cast("bigint").alias("_tie"), *[quoted(c) for c in cols if c not in keep]
        )
        table = small_table(spark, 
            [(c, [(x.value, MAX_LONG if x.tie is None else x.tie) for x in cuts.get(c, ())]) for c in cols],
            f"column string, cuts array<struct<v:{kind},t:bigint>>",
        )
        beyond = F.expr("size(filter(cuts, x -> x.v < value OR (x.v = value AND x.t < _tie)))")
        # one row per column
        frames.append(
            long_values(staged, cols, kind, [*keep, "_tie"])
            .join(F.broadcast(table), "column")
            .select(*[quoted(k) for k in keep], "column", (beyond + 1).alias("bin"))
        )
    return union_all(frames)


def ntile_ranks(n: int, k: int) -> list[int]:
    """Last rank of each of the first k-1 equal-count groups of n rows."""
    q, m = divmod(n, k)
    return [b * q + min(b, m) for b in range(1, k)]


def ntile_column(c: Column, tie: Column, cuts: Mapping[int, Cut], n: int, k: int) -> Column:
    """ntile(k) of a non-null value as a CASE over exact cut points; NULL stays NULL."""
    out = None
    last = 0
    for b, r in enumerate(ntile_ranks(n, k), start=1):
        if r <= last:
            continue
        last = r
        cond = cuts[r].covers(c, tie)
        out = F.when(cond, F.lit(b)) if out is None else out.when(cond, F.lit(b))
    top = F.lit(min(k, n))
    return F.when(c.isNotNull(), out.otherwise(top) if out is not None else top)


# --------------------------------------------------------------------------
# running totals over a global order


def with_prefix(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column], by: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Add inclusive running sums over ``order`` (per ``by`` group).

    The rows are range-partitioned on (by, order) - a hot leading value spreads
    over the following order columns - and written once, so both passes see the
    same partitions; per-partition totals become offsets and each partition runs
    its own window.  ``parts`` defaults to the session's shuffle partitions.
    """
    names = list(sums)
    ranges = [*[quoted(b) for b in by], *order]
    ranged = df.repartitionByRange(parts, *ranges) if parts else df.repartitionByRange(*ranges)
    table = materialise(ranged.withColumn("_part", F.spark_partition_id()), "ordered")
    totals = table.groupBy(*by, "_part").agg(*[F.sum(sums[n]).alias(f"_t_{n}") for n in names])
    # groups x partitions rows
    before = W.partitionBy(*(by or [F.lit(0)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names]
    )
    w = W.partitionBy(*by, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = table.select("*", *[F.sum(sums[n]).over(w).alias(n) for n in names])
    l, o = local.alias("l"), offsets.alias("o")
    same = F.col("l._part") == F.col("o._part")
    for b in by:
        same = same & F.col(f"l.`{b}`").eqNullSafe(F.col(f"o.`{b}`"))
    return l.join(o, same).select(
        *[F.col(f"l.`{c}`") for c in df.columns],
        *[(F.col(f"l.`{n}`") + F.col(f"o.`_o_{n}`")).alias(n) for n in names],
    )


def with_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "rank", by: Sequence[str] = (), **options: Any
) -> DataFrame:
    """Exact global (or per ``by`` group) row number over a total order."""
    return with_prefix(df, order, {name: F.lit(1).cast("bigint")}, by=by, **options)


def quantile_edges(
    df: DataFrame, columns: Sequence[str], k: int, accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float]]:
    """Approximate equal-count edges per column from sketches: one aggregate, no shuffle of rows."""
    probs = F.array(*[F.lit(i / k) for i in range(1, k)])
    got = wide_aggregate(df, columns, lambda c: {"q": F.percentile_approx(c, probs, accuracy)})
    return {c: sorted(set(got[c]["q"] or [])) for c in columns}


def approx_distinct(*columns: Column) -> Column:
    """Sketched count of distinct non-null values (about 1% error) with one small binary buffer.

    ``approx_count_distinct`` keeps its registers as row fields, which at this
    error and tens of columns falls out of generated code.
    """
    known = columns[0].isNotNull()
    for c in columns[1:]:
        known = known | c.isNotNull()
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(known, F.xxhash64(*columns)), 14))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
