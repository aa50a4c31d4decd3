"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q, at least
``max(LEAST, TIMES * q)`` long, that no neighbouring word extends.  Each of its words
occurs at least ``TIMES`` times in it.  So:

1. Splitting.  A word that occurs fewer than ``TIMES`` times in its segment (at first
   the whole text) is in no run, and splits the segment.  Pieces are counted again
   until none changes; pieces shorter than ``LEAST`` go.  This leaves little of prose.
2. Lag scan of what survives, all segments of an Arrow step at once.  For periods in
   [P, 2P) with P = 1, 2, 4, ... a run holds a block of P words that begins at a
   multiple of P and occurs again q words later.  Hashes of all windows of P words
   give all (block, lag) matches by one comparison per word and power of two, so the
   scan takes n log n steps also for a text that is one long run.  Matches grow to
   both sides by bisection over window hashes.
3. Every stretch found is compared word by word, so hash collisions change nothing.

Of stretches with the same ends the smallest period stays.  Two periods q < r of one
stretch of at least q + r words make the smallest one divide both, and then their
maximal stretches are the same one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import batch_words, mix, small_batches, steps

LEAST = 6
TIMES = 4
_BASE = 0x9E3779B97F4A7C15  # any odd number


def frequent_segments(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and segment numbers of the words that splitting leaves, in the order of the text.

    ``codes`` are word codes, ``text`` the text of each, in order.
    """
    place, segment = np.arange(len(codes)), text
    width = int(codes.max()) + 1 if len(codes) else 1
    stable: list[np.ndarray] = []
    while len(place):
        _, group, count = np.unique(segment * width + codes[place], return_inverse=True, return_counts=True)
        rare = count[group] < TIMES
        broken = np.zeros(int(segment[-1]) + 1, bool)
        broken[segment[rare]] = True
        stable.append(place[~broken[segment]])
        left = broken[segment] & ~rare
        place, segment = place[left], segment[left]
        if len(place):
            first = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(segment) != 0)])
            segment = np.cumsum(first) - 1
            long = np.bincount(segment)[segment] >= LEAST
            place, segment = place[long], segment[long]
    place = np.sort(np.concatenate(stable)) if stable else place
    # segments never touch: a splitting word or the end of a text lies between two
    first = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(text[place]) != 0)]) if len(place) else np.zeros(0, bool)
    segment = np.cumsum(first) - 1
    long = np.bincount(segment)[segment] >= LEAST if len(place) else first
    return place[long], segment[long]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Windows:
    """Hashes of any windows of one sequence of keys, equal for equal windows."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        power, self.inverse = (_powers(base, n) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys.astype(np.uint64) + np.uint64(1)) * power[:-1])])

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        return (self.total[start + length] - self.total[start]) * self.inverse[start]


def _grown(windows: _Windows, i: np.ndarray, j: np.ndarray, room: np.ndarray, side: int) -> np.ndarray:
    """How many words after (side 1) or before (side -1) places i and j are the same, at most ``room``."""
    grown = np.zeros(len(i), np.int64)
    step = 1 << max(int(room.max()).bit_length() - 1, 0) if len(room) else 0
    while step:
        fits = np.flatnonzero(grown + step <= room)
        a, b = (i[fits] + grown[fits], j[fits] + grown[fits]) if side > 0 else (i[fits] - grown[fits] - step, j[fits] - grown[fits] - step)
        grown[fits[windows(a, step) == windows(b, step)]] += step
        step >>= 1
    return grown


def _same(keys: np.ndarray, run: np.ndarray) -> bool:
    start, length, lag = run
    return np.array_equal(keys[start : start + length - lag], keys[start + lag : start + length])


def _plain_scan(keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """All stretches of all lags, word by word; only for a collision of hashes."""
    found = []
    edge = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0, [True]]))
    for low, high in zip(edge[:-1], edge[1:]):
        for lag in range(1, (high - low) // TIMES + 1):
            same = np.concatenate([[False], keys[low : high - lag] == keys[low + lag : high], [False]])
            turns = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
            found += [(low + a, b - a + lag, lag) for a, b in turns if b - a + lag >= max(LEAST, TIMES * lag)]
    return np.array(found, np.int64).reshape(-1, 3)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of rows with equal start and length the smallest period."""
    runs = np.unique(runs, axis=0)
    return runs[np.concatenate([[True], (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)])[: len(runs)]]


def lag_scan(keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs inside segments, by start, then period.

    ``keys`` are equal only for equal words of one segment; ``segment`` never falls.
    """
    found = [np.zeros((0, 3), np.int64)]
    whole, parts = keys, segment
    place = np.arange(len(keys))
    block = 1
    while True:
        if len(keys):
            sizes = np.bincount(segment)[segment]
            long = sizes >= max(LEAST, TIMES * block)
            keys, segment, place = keys[long], segment[long], place[long]
        n = len(keys)
        if not n:
            break
        edge = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0, [True]]))
        own = np.searchsorted(edge, np.arange(n), "right") - 1
        low, high = edge[own], edge[own + 1]
        windows = _Windows(keys)
        hashes = np.zeros(-(-n // block) * block, np.uint64)
        hashes[: n - block + 1] = windows(np.arange(n - block + 1), block)
        rows = hashes.reshape(-1, block)
        match = rows[1:] == rows[:-1, :1]
        match[1:] &= ~match[:-1]  # one match of a stretch: the blocks before have it too
        at, lag = np.nonzero(match)
        i, q = at * block, lag + block
        inside = i + q + block <= high[i]
        i, q = i[inside], q[inside]
        before = _grown(windows, i, i + q, i - low[i], -1)
        length = before + q + _grown(windows, i, i + q, high[i] - i - q, 1)
        runs = length >= np.maximum(LEAST, TIMES * q)
        found.append(_smallest(np.stack([place[i - before], length, q], axis=1)[runs]))
        block *= 2
    runs = _smallest(np.concatenate(found))
    if not all(_same(whole, run) for run in runs):
        runs = _smallest(_plain_scan(whole, parts))
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def word_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs of texts whose words are ``codes``; starts are places in ``codes``."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place, segment = frequent_segments(codes.astype(np.int64), text)
    keys = segment * (int(codes.max()) + 1 if len(codes) else 1) + codes[place]
    runs = lag_scan(keys, segment)
    runs[:, 0] = place[runs[:, 0]]
    return runs


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["start", "length", "period"]
    fields = [pa.field(name, pa.int64()) for name in names]
    for batch in batches:
        for at, to in steps(batch.column(1)):
            codes, words, bounds = batch_words(batch.column(1)[at:to])
            runs = word_runs(codes, bounds)
            dropped = np.zeros(len(codes) + 1, np.int64)
            np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
            np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(dropped)[:-1] == 0
            kept_bounds = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(kept_bounds), words.take(pa.array(codes[kept])))
            text = np.searchsorted(bounds, runs[:, 0], "right") - 1
            cuts = np.searchsorted(text, np.arange(len(bounds))).astype(np.int32)
            columns = [pa.array(runs[:, 0] - bounds[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[at:to],
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(columns, fields=fields)),
                    pc.binary_join(lists, " "),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every row.

    Words lie between ASCII white space and are compared as they are.  ``collapsed`` is
    the text without the words that a run repeats, joined by one space: of each run
    the first period stays, unless another run drops it.  NULL and empty texts have no
    word, no run and an empty ``collapsed``; repeated rows stay repeated; an empty
    table gives an empty result.  Only the id and text columns are read, and nothing
    is shuffled.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return rows.mapInArrow(_scan, f"doc_id {kind}, n_words bigint, runs {runs}, collapsed string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a tail of periodic words planted in every tenth text.

    With h the crc32 of the id as text and g = h div 10: if h is divisible by 10 and
    the text has n > 0 words, its words from a = g mod n on repeat the first
    1 + (n - a) div (3 + g mod 8) of them, and single spaces lie between all words.
    Other rows and rows with a NULL id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    # only these rows are split into words; the rest has an empty array
    drawn = F.coalesce(h % 10 == 0, F.lit(False))
    split = F.array_remove(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    names = {c.lower() for c in docs.columns}
    w, a, p = (_free(name, names) for name in ("words", "from", "period"))
    out = docs.withColumn(w, F.when(drawn, split)).withColumn(a, _at_word(h, F.col(w)))
    n = F.size(w)
    g = F.floor(h / 10)
    out = out.withColumn(p, (1 + F.floor((n - F.col(a)) / (3 + g % 8))).cast("int"))
    rest = n - F.col(a)
    tail = F.slice(F.flatten(F.array_repeat(F.slice(w, F.col(a) + 1, F.col(p)), F.ceil(rest / F.col(p)).cast("int"))), F.lit(1), rest)
    text = F.when(F.col(w).isNotNull() & (n > 0), F.concat_ws(" ", F.slice(w, F.lit(1), F.col(a)), tail)).otherwise(F.col(text_col).cast("string"))
    return out.withColumn(text_col, text).drop(w, a, p)


def _at_word(h: Column, words: Column) -> Column:
    return F.when(F.size(words) > 0, F.floor(h / 10) % F.size(words)).cast("int")


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = "_" + name
    return name


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each row of ``periodic_runs`` (ties: smallest start, then period) and hashes of all."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["l"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(1000 * best["l"] / -best["p"]).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
