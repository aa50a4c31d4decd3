"""Best-fit packing of pieces into fixed-size sequences by linear grouping.

The plan depends only on how many pieces there are of each length, at most
``capacity`` numbers, so it is made on the driver at any input size:

1. pieces longer than ``small`` are sorted and cut into ``groups`` groups of equal
   cardinality; every length counts as the longest of its group;
2. the few sizes are packed by configurations (multisets of sizes that fit): the
   linear program over all configurations is solved by column generation, its
   priced column being a knapsack, and rounded down;
3. actual pieces take the places of their group, so that each sequence's true rest
   is known, in runs of sequences with equal contents;
4. what rounding down left over and the small pieces follow in falling order, each
   into the fullest sequence that still holds it, else into a new one.

A run of the plan says: pieces ``rank .. rank + n - 1`` of one length lie at
``offset`` of sequences ``sequence .. sequence + n - 1``.  Pieces are ranked within
their length by counts per (length, bucket), so no length is sorted in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from riskloom.llm.common import batch_ids, steps
from riskloom.sources.scratch import materialise

CAPACITY = 2048
GROUPS = 512
# Pieces up to capacity // SMALL_SHARE are small: they fill what the grouped ones leave.
SMALL_SHARE = 3
# Rows that one ranking bucket is meant to hold.
BUCKET_ROWS = 50_000


def price(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, and its value."""
    n = len(sizes)
    most = int(capacity // sizes.min())
    best = np.zeros(capacity + 1)
    picks = []
    room = np.arange(capacity + 1)[None, :] - sizes[:, None]
    fits = room >= 0
    room = np.maximum(room, 0)
    for _ in range(most):
        reached = np.where(fits, best[room] + values[:, None], -1.0)
        pick = reached.argmax(axis=0)
        value = reached[pick, np.arange(capacity + 1)]
        better = value > best + 1e-12
        picks.append(np.where(better, pick, -1))
        if not better.any():
            break
        best = np.where(better, value, best)
    counts = np.zeros(n, np.int64)
    at = capacity
    for pick in reversed(picks):
        if pick[at] >= 0:
            counts[pick[at]] += 1
            at -= sizes[pick[at]]
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """An optimal basis of the configuration program: (pieces of each size, how often, a fraction)."""
    n = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(60 * n + 200):
        value, column = price(sizes, np.maximum(inverse.sum(axis=0), 0), capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, amount / step, np.inf)
        leave = int(ratio.argmin())
        pivot = inverse[leave] / step[leave]
        inverse = inverse - np.outer(step, pivot)
        inverse[leave] = pivot
        amount = np.maximum(amount - step * ratio[leave], 0)
        amount[leave] = ratio[leave]
        columns[:, leave] = column
    return [(columns[:, k].astype(np.int64), float(amount[k])) for k in range(n) if amount[k] > 1e-9]


class Plan:
    """Runs of equal sequences with their rest, and the places given so far."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.places: list[tuple[int, int, int, int, int]] = []  # length, rank, n, sequence, offset
        self.used = 0
        self.rest: dict[int, list[tuple[int, int]]] = defaultdict(list)  # rest -> (sequence, n)
        self.rests: list[int] = []  # rests that have sequences, sorted

    def keep(self, rest: int, sequence: int, n: int) -> None:
        if rest and not self.rest[rest]:
            bisect.insort(self.rests, rest)
        if rest:
            self.rest[rest].append((sequence, n))

    def put(self, length: int, rank: int, n: int) -> None:
        """Best fit: the fullest sequences with room, then new ones, each as full as it gets."""
        while n:
            k = bisect.bisect_left(self.rests, length)
            if k == len(self.rests):
                each = self.capacity // length
                sequences = max(n // each, 1)
                fill = min(each, n)
                for slot in range(fill):
                    self.places.append((length, rank + slot * sequences, sequences, self.used, slot * length))
                self.keep(self.capacity - fill * length, self.used, sequences)
                self.used += sequences
                rank, n = rank + fill * sequences, n - fill * sequences
                continue
            rest = self.rests[k]
            sequence, have = self.rest[rest].pop()
            if not self.rest[rest]:
                del self.rests[k]
            take = min(n, have)
            self.places.append((length, rank, take, sequence, self.capacity - rest))
            if have > take:
                self.keep(rest, sequence + take, have - take)
            self.keep(rest - length, sequence, take)
            rank, n = rank + take, n - take


def make_plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> np.ndarray:
    """Runs (length, rank, n, sequence, offset) for ``counts[length]`` pieces of each length 1..capacity."""
    plan = Plan(capacity)
    small = capacity // SMALL_SHARE
    left: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for length in range(1, small + 1):
        if counts[length]:
            left[length].append((0, int(counts[length])))
    large = [(length, int(counts[length])) for length in range(capacity, small, -1) if counts[length]]
    total = sum(n for _, n in large)
    if total:
        bounds = [total * k // groups for k in range(1, groups + 1)]
        queues: list[list[tuple[int, int, int]]] = []
        sizes: list[int] = []
        queue: list[tuple[int, int, int]] = []
        seen, g = 0, 0
        for length, n in large:
            rank = 0
            while n:
                while bounds[g] <= seen:
                    g += 1
                take = min(n, bounds[g] - seen)
                queue.append((length, rank, take))
                seen, rank, n = seen + take, rank + take, n - take
                if seen == bounds[g]:
                    if sizes and sizes[-1] == queue[0][0]:
                        queues[-1] += queue  # equal sizes are one size
                    else:
                        queues.append(queue)
                        sizes.append(queue[0][0])
                    queue = []
        demand = np.array([sum(n for _, _, n in q) for q in queues], float)
        basis = configurations(np.array(sizes), demand, capacity)
        for config, times in sorted(basis, key=lambda c: -c[1]):
            slots = [g for g, k in enumerate(config) for _ in range(k)]
            copies = int(times + 1e-6)
            while copies and slots:
                short = next((g for g in slots if sum(n for _, _, n in queues[g]) < config[g]), None)
                if short is not None:
                    break
                # as many copies as the front pieces of every slot allow
                heads: list[tuple[int, int, int]] = []
                n = copies
                for g in dict.fromkeys(slots):
                    length, rank, have = queues[g][0]
                    n = min(n, max(have // int(config[g]), 1))
                taken = []
                for g in slots:
                    length, rank, have = queues[g].pop(0)
                    take = min(n, have)
                    if have > take:
                        queues[g].insert(0, (length, rank + take, have - take))
                    taken.append((length, rank, take))
                n = min(t[2] for t in taken)
                for g, (length, rank, take) in zip(slots, taken):
                    if take > n:
                        queues[g].insert(0, (length, rank + n, take - n))
                    heads.append((length, rank, n))
                offset = 0
                for length, rank, n in heads:
                    plan.places.append((length, rank, n, plan.used, offset))
                    offset += length
                plan.keep(capacity - offset, plan.used, n)
                plan.used += n
                copies -= n
        for q in queues:
            for length, rank, n in q:
                left[length].append((rank, n))
    for length in sorted(left, reverse=True):
        for rank, n in left[length]:
            plan.put(length, rank, n)
    return np.array(plan.places, np.int64).reshape(-1, 5)


def _pieces(tokenizer: str, end_id: int, capacity: int):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at, to in steps(batch.column(1)):
                flat, ends = batch_ids(batch.column(1)[at:to], tokenizer)
                rows: list[tuple] = []
                for k, doc_id in enumerate(batch.column(0)[at:to].to_pylist()):
                    ids = flat[ends[k] : ends[k + 1]].tobytes() + end
                    for piece, b in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[b : b + 4 * capacity]
                        rows.append((doc_id, piece, b // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return cut


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the ids of each whole text and ``end_id``, cut at ``capacity``.

    Only the id and text columns are read, so other columns may have any name.  A
    NULL or empty text is one piece of one id.  Document ids are whole numbers, or text
    of such; other ids raise an error.
    """
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return narrow.mapInArrow(_pieces(tokenizer, end_id, capacity), schema)


def _placer(places: np.ndarray, types: pa.Schema):
    """Adds sequence_id and offset by a search for (length, rank) among the plan's runs."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = places.value
        keys = (runs[:, 0] << 42) + runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            run = np.searchsorted(keys, (length << 42) + rank, "right") - 1
            columns = [batch.column(name) for name in types.names[:-2]]
            columns += [pa.array(runs[run, 3] + rank - runs[run, 1]), pa.array(runs[run, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=types.names)

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Give every row of ``pieces`` (doc_id, piece, start, length, ids_crc32) a sequence_id and an offset.

    ``pieces`` is read several times and should be a written table.  Lengths are 1 to
    ``capacity``.  Rows with equal ids are ranked in any order and each gets a place
    of its own; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    rows = pieces.count()
    buckets = max(8, rows // BUCKET_ROWS)
    salted = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = salted.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():  # one row per length at most
        counts[length] = n
    places = make_plan(counts, capacity, groups)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    firsts = sizes.select("length", "bucket", before.alias("before"))
    own = F.row_number().over(W.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("own", own).join(firsts, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("own") + F.col("before")).cast("bigint").alias("rank"))
    out = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema] + ["sequence_id bigint", "offset bigint"]
    names = pa.schema([(name, pa.null()) for name in [*pieces.columns, "sequence_id", "offset"]])
    return ranked.mapInArrow(_placer(spark.sparkContext.broadcast(places), names), ", ".join(out))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, groups: int = GROUPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut and pack whole documents: one row per piece with its sequence and its place there."""
    return pack(materialise(cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces"), capacity, groups)
