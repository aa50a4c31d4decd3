"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Words are lower-cased and bare of signs at their ends; a document's shingles are its
runs of five words (fewer words: one shingle of all), weighted by how often it holds
them.  Documents with the same words are one text first.

Signatures.  Each shingle is a Poisson process with its weight as rate, driven by
its hash; every arrival picks a register.  A register keeps the shingle that arrived
first, so two texts agree in a register with their probability Jaccard similarity.
A shingle stops once its next arrival is later than the last register's first.
Links are of sets, so a text whose shingles differ in weight is signed again with
every weight 1, which two texts share with their set Jaccard similarity; equal
weights give that signature already.

Candidates.  ``BANDS`` bands of ``ROWS`` registers of each signature; texts that share a band are
compared with the least id there, not with each other, so a group of any size costs
one row per member and band, and the least id comes from a map-side combined
minimum.  Texts in bands that afterwards still hold more than one component are
open.  Sets with a link share one of their first ``n - ceil(similarity * n) + 1``
shingles in any fixed order of shingles; taken rarest first, this finds what open
texts are left to compare, and passages that many texts share bring none together.
Texts of the smaller component are put in blocks by pivot, and a block is compared
with all texts of larger components that share such a shingle with any of it, as
matrix products, so pairs never become rows.  No link between texts of different
components is lost to pivots; links inside a class, which pivots leave out, are counted
afterwards, all its texts with each other in such blocks.

Links are pairs whose exact Jaccard similarity of shingle sets is at least
``SIMILARITY``; classes are their connected components, found by minimum labels with
pointer jumping over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from riskloom.llm.common import batch_words, mix, steps
from riskloom.sources.scratch import finished, materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
# Open texts that a block compares with as many others, and shingles at once.
BLOCK = 256
SLICE = 4096
# Bits that foretell whether a text is needed, in rows of the size Spark's bitmaps have.
ID_BITS, BITMAP_BITS = 1 << 24, 32768
# Counts that order shingles by rarity.
SLOTS = 1 << 18
_SIGNS = ".,;:!?\"'()[]{}*#|-"
_INTERVAL, _REGISTER, _STEP = np.uint64(0x3C79AC492BA7B653), np.uint64(0x1C69B3F74AC4AE35), np.uint64(0x9E3779B97F4A7C15)


def _bare_hash(token: str) -> int:
    word = token.strip(_SIGNS)
    return xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) | 1 if word else 0


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and its bounds; tokens of signs alone are no words."""
    codes, words, bounds = batch_words(pc.utf8_lower(pc.fill_null(texts, "")))
    table = np.fromiter(map(_bare_hash, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))
    keys = table[codes]
    real = keys != 0
    return keys[real], np.concatenate([[0], np.cumsum(real)])[bounds]


def shingles(keys: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the bounds of each text's."""
    n = np.diff(bounds)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    rolled = np.zeros(max(len(keys) - size + 1, 0), np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(0x100000001B3) + keys[k : k + len(rolled)])
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(n)), counts)
    within = np.arange(out_bounds[-1]) - out_bounds[text]
    at = bounds[text] + within
    short = n[text] < size
    out = np.zeros(out_bounds[-1], np.uint64)
    out[~short] = rolled[at[~short]]
    for k in np.flatnonzero(short):
        whole = keys[bounds[text[k]] : bounds[text[k] + 1]]
        value = np.array([len(whole)], np.uint64)
        for word in whole:
            value = mix(value * np.uint64(0x100000001B3) + word)
        out[k] = value[0]
    return out, out_bounds


def weighted(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text, hash and how often."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])])) if len(text) else np.zeros(0, int)
    return text[first], hashes[first], np.diff(np.append(first, len(hashes)))


def signatures(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """The shingle that arrives first in each register of each text."""
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    arrival = np.zeros(len(text))
    rate = weights.astype(float)
    step = np.uint64(0)
    while len(text):
        step = step + np.uint64(1)
        turn = np.multiply([step], _STEP)
        draw = mix(mix(hashes + turn) ^ _INTERVAL)
        uniform = ((draw >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
        arrival = arrival - np.log(uniform) / rate
        register = (mix(mix(hashes ^ _REGISTER) + turn) % np.uint64(registers)).astype(np.int64)
        cell = text * registers + register
        np.minimum.at(first, cell, arrival)
        won = first[cell] == arrival
        winner[cell[won]] = hashes[won]
        last = first.reshape(n, registers).max(axis=1)
        alive = arrival <= last[text]
        text, hashes, rate, arrival = text[alive], hashes[alive], rate[alive], arrival[alive]
    return winner.reshape(n, registers)


def _bands(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The bands of all signatures, one after another."""
    found = found.reshape(-1, bands, rows)
    band = np.broadcast_to(np.arange(bands, dtype=np.uint64), found.shape[:2]) + np.uint64(1)
    for k in range(rows):
        band = mix(band * np.uint64(0x100000001B3) + found[:, :, k])
    return band.ravel()


def _signer(bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in steps(batch.column(1)):
                keys, bounds = word_keys(batch.column(1)[at:to])
                filled = np.diff(bounds) > 0
                found_text, hashes, weights = weighted(*shingles(keys, bounds))
                sizes = np.bincount(found_text, minlength=to - at)
                # texts whose shingles differ in weight, signed as sets too
                starts = np.flatnonzero(np.diff(found_text, prepend=-1))
                uneven = np.zeros(to - at, bool)
                if len(starts):
                    uneven[found_text[starts]] = np.minimum.reduceat(weights, starts) < np.maximum.reduceat(weights, starts)
                again = uneven[found_text]
                number = np.cumsum(uneven) - 1
                by_weight = signatures(found_text, hashes, weights, to - at, bands * rows)[filled]
                by_set = signatures(number[found_text[again]], hashes[again], np.ones(again.sum()), int(uneven.sum()), bands * rows)
                owner = np.repeat(np.concatenate([np.flatnonzero(filled), np.flatnonzero(uneven)]), bands)
                band = _bands(np.concatenate([by_weight, by_set]), bands, rows)
                order = np.lexsort((band, owner))
                owner, band = owner[order], band[order]
                new = np.concatenate([[True], (np.diff(owner) != 0) | (band[1:] != band[:-1])])[: len(owner)]
                owner, band = owner[new], band[new]
                digests = [xxh3_128_digest(keys[a:b].tobytes()) if b > a else None for a, b in zip(bounds[:-1], bounds[1:])]
                # a text without words has no band
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=to - at))]).astype(np.int32)
                flat = pa.array(band.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at:to], pa.array(digests, pa.binary()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(cuts), flat)],
                    names=["doc_id", "digest", "size", "bands"],
                )

    return sign


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct shingle hashes of each text."""
    for batch in batches:
        for at, to in steps(batch.column(1)):
            text, hashes, _ = weighted(*shingles(*word_keys(batch.column(1)[at:to])))
            cuts = np.searchsorted(text, np.arange(to - at + 1))
            cells = [hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0)[at:to], pa.array(cells, pa.binary())], names=["doc_id", "shingles"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = np.intersect1d(a, b, assume_unique=True).size
            out.append(both / (len(a) + len(b) - both) if both else 0.0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def _slot(key: str) -> tuple[Column, Column]:
    """Row and bit of an id in the table of ``ID_BITS`` bits."""
    slot = F.pmod(F.xxhash64(key), F.lit(ID_BITS))
    return F.floor(slot / BITMAP_BITS), slot % BITMAP_BITS


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, shingles of the rows of ``docs`` (doc_id, text) that ``ids`` (needed) names, written.

    A table of ``ID_BITS`` bits, a fixed size, drops most other rows before their
    texts are shuffled for the exact join.
    """
    row, bit = _slot("needed")
    bitmap = ids.select(row.alias("bits_row"), bit.alias("bit")).groupBy("bits_row").agg(F.bitmap_construct_agg("bit").alias("bits"))
    row, bit = _slot("doc_id")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit / 8 as int) + 1, 1)")), 16, 10).cast("int")
    likely = docs.withColumns({"bits_row": row, "bit": bit}).join(F.broadcast(bitmap), "bits_row")
    likely = likely.filter(F.call_function("shiftright", byte, (F.col("bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
    # the exact join comes after the Python step, past which the optimizer does not move it
    sets = likely.select("doc_id", "text").mapInArrow(_sets, "doc_id bigint, shingles binary")
    return materialise(sets.join(ids, F.col("doc_id") == F.col("needed"), "left_semi"), "shingles")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, similarity of the rows (a, b) of ``pairs``: the exact one of their shingle sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(_similar, "a bigint, b bigint, similarity double")


def _prefixes(levels, similarity: float):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = levels.value
        for batch in batches:
            ids, hashes = [], []
            for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(cell.as_py(), np.uint64)
                order = np.lexsort((own, rarity[(own % np.uint64(SLOTS)).astype(np.int64)]))
                first = own[order][: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1]
                ids.append(np.full(len(first), doc_id))
                hashes.append(first.view(np.int64))
            columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (ids, hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["rep", "shingle"])

    return cut


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for cell in batch.column("shingles"):
            counts[(np.frombuffer(cell.as_py(), np.uint64) % np.uint64(SLOTS)).astype(np.int64)] += 1
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["slot", "n"])


def _alike(sets: pa.ChunkedArray, rows: np.ndarray, columns: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sets at ``rows`` and those at ``columns`` are similar, as a matrix."""
    cells = [np.frombuffer(c.as_py(), np.uint64) for c in sets]
    sizes = np.array([len(c) for c in cells])
    kinds, place, counts = np.unique(np.concatenate(cells), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(cells)), sizes)
    rank = np.cumsum(counts > 1) - 1  # shingles of one text alone are in no intersection
    real = counts[place] > 1
    owner, place = owner[real], rank[place[real]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    both = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, int((counts > 1).sum()), SLICE):
        a, b = np.searchsorted(place, [low, low + SLICE])
        present = np.zeros((len(cells), SLICE), np.float32)
        present[owner[a:b], place[a:b] - low] = 1
        both += present[rows] @ present[columns].T
    union = sizes[rows][:, None] + sizes[columns][None, :] - both
    return both >= similarity * union - 1e-6


def _compare(similarity: float):
    def compare(group: pa.Table) -> pa.Table:
        """Links between the row texts and the column texts of a block that are of different parts."""
        reps, parts = group["rep"].to_numpy(), group["part"].to_numpy()
        is_row = group["is_row"].to_numpy(zero_copy_only=False).astype(bool)
        rows, columns = np.flatnonzero(is_row), np.flatnonzero(~is_row)
        hit = _alike(group["shingles"], rows, columns, similarity) & (parts[rows][:, None] != parts[columns][None, :])
        x, y = np.nonzero(hit)
        x, y = reps[rows[x]], reps[columns[y]]
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return compare


def open_links(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b: links between texts of ``placed`` (rep, pivot, part, size) that are of different parts.

    The order of shingles is by how many open texts fill their slot of a table of
    ``SLOTS`` counts, a fixed size; an inexact count only makes it less sharp.
    """
    spark = placed.sparkSession
    counts = np.zeros(SLOTS, np.int64)
    slots = sets.mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts[slots["slot"]] = slots["n"]  # SLOTS rows at most
    levels = spark.sparkContext.broadcast(np.log2(counts + 1).astype(np.uint8))
    # blocks of texts with one pivot, its largest part apart; ``turn`` orders parts by size
    parts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.struct("n", "part").alias("turn"))
    turned = placed.join(parts, "part")
    largest = turned.groupBy("pivot").agg(F.max("turn").alias("largest"))
    turned = turned.join(largest, "pivot").withColumn("main", F.col("turn") == F.col("largest"))
    sizes = turned.groupBy("pivot", "main").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.struct("pivot", "main", F.pmod(F.xxhash64("rep"), "blocks").alias("salt"))
    turned = turned.join(sizes, ["pivot", "main"]).select("rep", "part", "size", "turn", block.alias("block"))
    prefixes = sets.mapInArrow(_prefixes(levels, similarity), "rep bigint, shingle bigint").join(turned, "rep")
    prefixes = materialise(prefixes, "prefixes")
    mixed = prefixes.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("shingle")
    prefixes = prefixes.join(mixed, "shingle", "left_semi")
    held = prefixes.groupBy("shingle", "block").agg(F.min("turn").alias("least"), F.min("size").alias("low"), F.max("size").alias("high"))
    columns = prefixes.select("shingle", "rep", "part", "turn", "size").alias("c")
    meets = (
        (F.col("h.shingle") == F.col("c.shingle"))
        & (F.col("c.turn") > F.col("h.least"))
        & (F.col("c.size") >= similarity * F.col("h.low"))
        & (F.col("h.high") >= similarity * F.col("c.size"))
    )
    columns = held.alias("h").join(columns, meets).select("h.block", "c.rep", "c.part").distinct()
    columns = materialise(columns, "columns")
    splits = columns.groupBy("block").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("int").alias("splits"))
    columns = columns.join(splits, "block").select("block", F.pmod(F.xxhash64("rep"), "splits").cast("int").alias("split"), "rep", "part", F.lit(False).alias("is_row"))
    every = F.explode(F.sequence(F.lit(0), F.col("splits") - 1))
    rows = turned.join(splits, "block").select("block", every.alias("split"), "rep", "part", F.lit(True).alias("is_row"))
    blocks = rows.unionByName(columns).join(sets, F.col("rep") == F.col("doc_id"))
    blocks = blocks.select("block", "split", "rep", "part", "is_row", "shingles")
    return blocks.groupBy("block", "split").applyInArrow(_compare(similarity), "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that each node of ``links`` (a, b) is connected with."""
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.least("label", "near").alias("next"), "label")
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("jump"))
        moved = lower.join(roots, F.col("next") == F.col("root"), "left")
        moved = materialise(moved.select("node", F.least("next", "jump").alias("label"), F.col("label").alias("was")), "labels")
        changed = moved.filter(F.col("label") != F.col("was")).limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels


def _degrees(similarity: float):
    def degrees(key: tuple, group: pa.Table) -> pa.Table:
        """Links between the texts of two blocks of a class, or inside one, by text."""
        _, first, second = (k.as_py() for k in key)
        reps, salt = group["rep"].to_numpy(), group["salt"].to_numpy()
        rows, columns = np.flatnonzero(salt == first), np.flatnonzero(salt == second)
        hit = _alike(group["shingles"], rows, columns, similarity)
        if first == second:
            np.fill_diagonal(hit, False)
            return pa.table({"rep": reps[rows], "n": hit.sum(axis=1).astype(np.int64)})
        n = np.concatenate([hit.sum(axis=1), hit.sum(axis=0)]).astype(np.int64)
        return pa.table({"rep": np.concatenate([reps[rows], reps[columns]]), "n": n})

    return degrees


def link_counts(labels: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """rep, n_links: with how many others of its class (node, label) each text is linked.

    Exact, so the work grows with the square of a class; the two texts of a pair are linked.
    """
    sizes = labels.groupBy("label").agg(F.count("*").alias("members")).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    placed = labels.join(sizes, "label").select(
        F.col("node").alias("rep"), "label", "members", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("salt")
    )
    pairs = placed.filter("members = 2").select("rep", F.lit(1).cast("bigint").alias("n"))
    other = placed.filter("members > 2").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    other = other.select("rep", "label", "salt", F.least("salt", "other").alias("first"), F.greatest("salt", "other").alias("second"))
    blocks = other.join(sets, F.col("rep") == F.col("doc_id")).select("rep", "label", "salt", "first", "second", "shingles")
    counted = blocks.groupBy("label", "first", "second").applyInArrow(_degrees(similarity), "rep bigint, n bigint")
    return pairs.unionByName(counted).groupBy("rep").agg(F.sum("n").alias("n_links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, count_links: bool = True) -> DataFrame:
    """doc_id, class_id, n_links of every row of ``docs``; no n_links without ``count_links``.

    ``class_id`` is the least id of the row's class; ``n_links`` counts the different
    texts of its class it is linked with directly, all of them.  NULL ids and texts without a word (NULL, empty,
    signs alone) are in no class with others: their class is their own id.  Rows with
    equal ids are one document; ids are whole numbers, or text of such, and other ids
    raise an error.  An empty table gives an empty result.  Only the id and text columns
    are read.
    """
    return finished(lambda: _classes(docs, id_col, text_col, similarity, bands, rows, count_links), "classes")


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, bands: int, rows: int, count_links: bool) -> DataFrame:
    rows_in = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialise(rows_in.mapInArrow(_signer(bands, rows), "doc_id bigint, digest binary, size bigint, bands array<bigint>"), "signed")
    real = signed.filter("doc_id is not null and digest is not null")
    texts = materialise(real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands")), "texts")
    banded = texts.select("rep", "size", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).filter("pivot <> last")
    shared = materialise(banded.join(buckets.select("band", "pivot"), "band"), "buckets")
    tried = materialise(shared.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    known = rows_in.filter("doc_id is not null")
    sets = shingle_sets(known, shared.select(F.col("rep").alias("needed")).distinct())
    links = materialise(similarities(tried, sets).filter(F.col("similarity") >= similarity).select("a", "b").distinct(), "links")
    first = components(links)
    placed = shared.join(first, F.col("rep") == F.col("node"), "left").select("band", "rep", "pivot", "size", F.coalesce("label", "rep").alias("part"))
    mixed = placed.groupBy("band").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("band")
    placed = placed.join(mixed, "band", "left_semi").groupBy("rep", "size", "part").agg(F.min("pivot").alias("pivot"))
    placed = materialise(placed, "open")
    left_open = sets.join(placed.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    more = open_links(placed, left_open, similarity)
    links = materialise(links.union(more).distinct(), "links")
    labels = components(links)
    classes = texts.join(labels, F.col("rep") == F.col("node"), "left").select("rep", F.col("digest").alias("own"), F.coalesce("label", "rep").alias("class_id"))
    joined = signed.select("doc_id", "digest").join(classes, F.col("digest") == F.col("own"), "left")
    class_id = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("class_id")), "doc_id").alias("class_id")
    if not count_links:
        return joined.select("doc_id", class_id)
    degree = link_counts(materialise(labels, "labels"), sets, similarity).withColumnRenamed("rep", "linked")
    joined = joined.join(degree, F.col("rep") == F.col("linked"), "left")
    return joined.select("doc_id", class_id, F.coalesce("n_links", F.lit(0)).alias("n_links"))
