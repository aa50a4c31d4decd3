"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Training tokens are lower-cased (A-Z) words and one end per text.  Counts of words and
of pairs of adjacent tokens are gathered from all training texts into a filter: an
n-gram with quantised count q (logarithmic, base ``LEVEL_BASE``) is entered q times,
hashed with 1 .. q.  A count is read back by probing 1, 2, ... until a probe misses.

The filter is split into shards by hash, as many as the corpus needs for about
``SHARD_GRAMS`` n-grams each.  Tasks send packed n-grams to the shards, each shard
counts its own and builds its bits, so no count table is ever in one place.  Filter
size follows the number of entries, ``BITS_EACH`` bits each, so its false-positive rate
does not depend on the corpus.  Shards also keep the exact counts of their words, for
the base score.

Since the filter grows with the corpus it is not broadcast, at no size: blocks of
texts send their distinct n-grams to the shards, which probe them and send back a byte
per n-gram and a count per word.  What travels is packed: shard numbers come from one
hash, so 40 more bits tell the pairs of a shard of any corpus apart (one in a million
shares them), sorted and written as byte planes for the shuffle's compression.

A token's probability is the pair count smoothed by a Dirichlet prior of the word
probability, both from probes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import batch_words, fold, mix, small_batches, steps, sums, word_hashes
from riskloom.sources.scratch import finished, materialise

LEVEL_BASE = 1.4
HASHES = 4
BITS_EACH = 10
# N-grams that a shard is meant to count, and that a task gathers before it sends them.
SHARD_GRAMS = 1_000_000
GATHERED = 3_000_000
# Text of a block that asks the shards at once.
BLOCK_BYTES = 4 << 20
# About the bytes of a token; it only sets the number of shards.
TOKEN_BYTES = 6
PRIOR = 200.0
_PAIR_BITS = np.uint64(40)

END = ""  # no word is empty
_END_HASH = np.uint64(0x5E4D0F1E9A8B7C6D)
_START = np.uint64(0x1B56C4E9D2A7F38B)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(texts, ""))


def with_ends(codes: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text: its words and one ``end``."""
    n = len(bounds) - 1
    out = np.full(len(codes) + n, end, np.int64)
    text = np.repeat(np.arange(n), np.diff(bounds))
    out[np.arange(len(codes)) + text] = codes
    return out, bounds + np.arange(n + 1)


def quantise(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(LEVEL_BASE)).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; 0 for none, exact for 1."""
    counts = LEVEL_BASE ** (levels - 0.5)
    return np.where(levels <= 0, 0.0, np.where(levels == 1, 1.0, counts))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0xD6E8FEB86659FD93) + second)


@dataclass
class Probed:
    """What shards found for ``keys``, which are in order; it answers for these as a ``Filter`` does."""

    keys: np.ndarray
    found: np.ndarray
    train_tokens: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        return self.found[np.searchsorted(self.keys, keys)]


@dataclass
class Filter:
    """The bits of one shard."""

    bits: np.ndarray  # uint8

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        left = np.arange(len(keys))
        base, step = _bases(keys, np.full(1, level, np.uint64))
        size = np.uint64(8 * len(self.bits))
        for k in range(HASHES):
            slot = (base[left] + np.uint64(k) * step[left]) % size
            left = left[(self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        found[left] = True
        return found

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """How many levels in a row each key is found at."""
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        level = 1
        while len(left):
            left = left[self.has(keys[left], level)]
            out[left] = level
            level += 1
            if level > 80:
                break
        return out

    def density(self) -> float:
        return float(np.unpackbits(self.bits).mean()) if len(self.bits) else 0.0


def _bases(keys: np.ndarray, levels: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    base = mix(keys + levels * np.uint64(0xA24BAED4963EE407))
    return base, mix(base ^ np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)


def slots(keys: np.ndarray, levels: np.ndarray, sizes: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bit of a shard that each of ``HASHES`` functions gives to (key, level)."""
    base, step = _bases(keys, levels.astype(np.uint64))
    sizes = np.asarray(sizes, np.uint64)
    for k in range(HASHES):
        yield ((base + np.uint64(k) * step) % sizes).astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x8CB92BA72F3D8DD7)) % np.uint64(shards)).astype(np.int64)


def in_shard(pairs: np.ndarray) -> np.ndarray:
    """What tells a pair from the others of its shard."""
    return pairs & ((np.uint64(1) << _PAIR_BITS) - np.uint64(1))


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, first all lowest ones, then all second ones, ..."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def from_planes(cell: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(cell) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(cell, np.uint8).reshape(width, -1).T
    return out.view("<u8").reshape(-1)


def by_shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    """Shard number above ``in_shard``: in order of these, pairs are in order of shards."""
    return (shard_of(pairs, shards).astype(np.uint64) << _PAIR_BITS) | in_shard(pairs)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words and, last, of the end; the place there of each token; bounds of the texts."""
    codes, words, bounds = batch_words(lowered(texts))
    tokens, bounds = with_ends(codes, bounds, len(words))
    return np.append(word_hashes(words), _END_HASH), tokens, bounds


def _pairs(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.concatenate([[_START], keys[:-1]])
    before[starts] = _START
    return pair_hash(before, keys)


def _gram_hashes(texts: pa.Array) -> np.ndarray:
    """Hashes of all tokens and all pairs, the first of which follows a start."""
    hashes, tokens, bounds = _tokens(texts)
    return np.concatenate([hashes[tokens], _pairs(hashes[tokens], bounds[:-1])])


def _cells(shards: int, shard: np.ndarray, *columns: tuple[np.ndarray, int]) -> Iterator[list[bytes]]:
    """For each shard number the planes of its part of the columns, which are in order of shard."""
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield [planes(values[a:b], width) for values, width in columns]


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def _send(shards: int):
    names = ["shard", "words", "word_n", "pairs", "pair_n"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[tuple[np.ndarray, np.ndarray]] = []
        pairs: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            keys, n = _counted(*[np.concatenate(x) for x in zip(*words)])
            shard = shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            word_cells = _cells(shards, shard[order], (keys[order], 8), (n[order], 6))
            keys, n = np.unique(by_shard(np.concatenate(pairs), shards), return_counts=True)
            words.clear()
            pairs.clear()
            pair_cells = _cells(shards, (keys >> _PAIR_BITS).astype(np.int64), (in_shard(keys), 5), (n, 4))
            rows = [(k, *w, *p) for k, (w, p) in enumerate(zip(word_cells, pair_cells)) if w[0] or p[0]]
            kinds = [pa.int32()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for at, to in steps(batch.column(0)):
                hashes, tokens, bounds = _tokens(batch.column(0)[at:to])
                n = np.bincount(tokens, minlength=len(hashes))
                words.append((hashes[n > 0], n[n > 0]))
                pairs.append(_pairs(hashes[tokens], bounds[:-1]))
                if sum(map(len, pairs)) > GATHERED:
                    yield out()
        if words:
            yield out()

    return send


def _built(group: pa.Table) -> pa.Table:
    """One shard: its filter's bits, and the exact counts of its words."""
    column = lambda name, width: np.concatenate([from_planes(x.as_py(), width) for x in group[name]])
    words, word_n = _counted(column("words", 8), column("word_n", 6).astype(np.int64))
    pairs, pair_n = _counted(column("pairs", 5), column("pair_n", 4).astype(np.int64))
    keys, levels = np.concatenate([words, pairs]), quantise(np.concatenate([word_n, pair_n]))
    size = max(int(levels.sum()) * BITS_EACH, 64) // 8 * 8
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max()) + 1):
        entered = keys[levels >= level]
        for slot in slots(entered, np.full(len(entered), level), size):
            bits[slot] = True
    cells = [np.packbits(bits, bitorder="little").tobytes(), words.tobytes(), planes(word_n, 8)]
    numbers = [pa.array([int(word_n.sum())]), pa.array([len(words)])]
    return pa.table([group["shard"][:1].combine_chunks(), *[pa.array([c], pa.binary()) for c in cells], *numbers], names=["shard", "bits", "words", "word_n", "total", "distinct"])


SHARD = "shard int, bits binary, words binary, word_n binary, total bigint, distinct bigint"


def shard_count(text_bytes: int) -> int:
    return max(1, -(-2 * (text_bytes // TOKEN_BYTES) // SHARD_GRAMS))


def filter_shards(texts: DataFrame, shards: int) -> DataFrame:
    """The filter over all rows of ``texts`` (text), one row per shard; shards without an n-gram have none."""
    sent = texts.mapInArrow(_send(shards), "shard int, words binary, word_n binary, pairs binary, pair_n binary")
    return sent.groupBy("shard").applyInArrow(_built, SHARD)


def log10_probabilities(own: Probed, keys: np.ndarray, starts: np.ndarray, known: np.ndarray) -> np.ndarray:
    """log10 P(token | token before) of each token; ``known`` are the counts of the tokens themselves."""
    pairs, place = np.unique(_pairs(keys, starts), return_inverse=True)
    return log10_smoothed(count_of(own.levels(pairs))[place], starts, known, own_starts(own), own.train_tokens)


def log10_smoothed(both: np.ndarray, starts: np.ndarray, known: np.ndarray, start: float, train_tokens: int) -> np.ndarray:
    """The same from the counts of each token's pair (``both``) and of the starts."""
    context = np.concatenate([[0.0], known[:-1]])
    context[starts] = start
    both = np.minimum(both, np.minimum(context, known))
    word = (known + 0.5) / (train_tokens + 1.0)
    return np.log10((both + PRIOR * word) / (context + PRIOR))


def own_starts(own: Probed) -> float:
    """As many starts as ends."""
    return float(count_of(own.levels(np.array([_END_HASH])))[0])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of so much text, as places among the block's distinct words."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at, to in steps(batch.column(1), BLOCK_BYTES):
            hashes, tokens, bounds = _tokens(batch.column(1)[at:to])
            used = np.bincount(tokens, minlength=len(hashes)) > 0
            cells = [planes((np.cumsum(used) - 1)[tokens], 4), planes(np.diff(bounds), 4), hashes[used].tobytes()]
            ids = pa.ListArray.from_arrays(pa.array([0, to - at], pa.int32()), batch.column(0)[at:to])
            yield pa.RecordBatch.from_arrays([pa.array([block]), ids, *[pa.array([c], pa.binary()) for c in cells]], names=["block", "ids", "tokens", "lengths", "hashes"])
            block += 1


class _Block:
    """A block's tokens, and its n-grams in the order in which shards are asked."""

    def __init__(self, tokens: bytes, lengths: bytes, hashes: bytes, shards: int):
        self.hashes = np.frombuffer(hashes, "<u8")
        self.tokens = from_planes(tokens, 4).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(from_planes(lengths, 4).astype(np.int64))])
        # distinct pairs by shard, and which of them each token ends
        self.pairs, self.place = np.unique(by_shard(_pairs(self.hashes[self.tokens], self.bounds[:-1]), shards), return_inverse=True)
        self.word_shard = shard_of(self.hashes, shards)
        self.word_order = np.argsort(self.word_shard, kind="stable")


def _ask(shards: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *packed in zip(*[batch.column(batch.schema.get_field_index(c)) for c in ("block", "tokens", "lengths", "hashes")]):
                block = _Block(*[p.as_py() for p in packed], shards)
                words = _cells(shards, block.word_shard[block.word_order], (block.hashes[block.word_order], 8))
                pairs = _cells(shards, (block.pairs >> _PAIR_BITS).astype(np.int64), (in_shard(block.pairs), 5))
                rows = [(k, number.as_py(), *w, *p) for k, (w, p) in enumerate(zip(words, pairs)) if w[0] or p[0]]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["shard", "block", "words", "pairs"])

    return ask


def _answer(shard: pa.Table, asks: pa.Table) -> pa.Table:
    """Levels of the n-grams that each block asks for, a byte each, and the exact counts of its words."""
    words = [from_planes(c.as_py(), 8) for c in asks["words"]]
    pairs = [from_planes(c.as_py(), 5) for c in asks["pairs"]]
    filter_ = Filter(np.frombuffer(shard["bits"][0].as_py() if len(shard) else bytes(8), np.uint8))
    known = np.frombuffer(shard["words"][0].as_py() if len(shard) else b"", "<u8")
    counts = from_planes(shard["word_n"][0].as_py() if len(shard) else b"", 8)
    # many blocks ask for the same n-grams: each is probed once
    keys, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *words, *pairs]), return_inverse=True)
    level_of = filter_.levels(keys).astype(np.uint8)
    _, here, there = np.intersect1d(keys, known, assume_unique=True, return_indices=True)
    count_of_key = np.zeros(len(keys), np.uint64)
    count_of_key[here] = counts[there]
    cuts = np.cumsum([len(x) for x in words + pairs])
    parts = np.split(place, cuts[:-1])
    levels = [np.concatenate([level_of[w], level_of[p]]).tobytes() for w, p in zip(parts[: len(words)], parts[len(words) :])]
    exact = [planes(count_of_key[w], 8) for w in parts[: len(words)]]
    return pa.table({"block": asks["block"], "shard": asks["shard"], "levels": pa.array(levels, pa.binary()), "counts": pa.array(exact, pa.binary())})


def _combine(shards: int, total: int, distinct: int):
    def combine(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(*[blocks[c][0].as_py() for c in ("tokens", "lengths", "hashes")], shards)
        answers = answers.sort_by("shard")
        counts = np.concatenate([from_planes(c.as_py(), 8) for c in answers["counts"]]).astype(np.int64)
        of_words, of_pairs = [], []
        for got, c in zip(answers["levels"], answers["counts"]):
            got, n = np.frombuffer(got.as_py(), np.uint8), len(c.as_py()) // 8
            of_words.append(got[:n])
            of_pairs.append(got[n:])
        of_words, of_pairs = np.concatenate(of_words).astype(np.int64), np.concatenate(of_pairs).astype(np.int64)
        if len(blocks) != 1 or len(of_words) != len(block.hashes) or len(of_pairs) != len(block.pairs):
            raise ValueError("the answers are not those of this block: its input gave other rows when it was read again")
        exact, levels = np.zeros((2, len(block.hashes)), np.int64)
        exact[block.word_order], levels[block.word_order] = counts, of_words
        tokens, bounds = block.tokens, block.bounds
        known = count_of(levels)
        start = known[block.hashes == _END_HASH][0]  # as many starts as ends
        scores = log10_smoothed(count_of(of_pairs)[block.place], bounds[:-1], known[tokens], start, total)
        base = np.log10((exact + 0.5) / (total + 0.5 * (distinct + 1)))
        return pa.table(
            {
                "doc_id": pa.concat_arrays([c.flatten() for c in blocks["ids"].chunks]),
                "n_tokens": np.diff(bounds),
                "n_known": sums((exact[tokens] > 0).astype(np.int64), bounds),
                "base_score": sums(base[tokens], bounds),
                "score": sums(scores, bounds),
            }
        )

    return combine


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Texts outside fold ``held_out`` train the model.  NULL and empty texts are one end
    token; rows with equal ids are scored each by its own text, and equal texts get
    equal scores; an empty table gives an empty result.  Words are told apart by 64-bit
    hashes.  Only the id and text columns are read.
    """
    return finished(lambda: _scores(docs, id_col, text_col, held_out), "lm")


def _scores(docs: DataFrame, id_col: str, text_col: str, held_out: int) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    train = rows.filter(fold("doc_id") != held_out).select("text")
    shards = shard_count(train.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    held = materialise(filter_shards(train, shards), "filter")
    total, distinct = held.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    kind = docs.schema[id_col].dataType.simpleString()
    # one shuffle of blocks serves both the questions and the scores
    blocks = rows.mapInArrow(_blocks, f"block bigint, ids array<{kind}>, tokens binary, lengths binary, hashes binary").repartition("block")
    asks = blocks.mapInArrow(_ask(shards), "shard int, block bigint, words binary, pairs binary")
    answers = held.select("shard", "bits", "words", "word_n").groupBy("shard").cogroup(asks.groupBy("shard")).applyInArrow(_answer, "block bigint, shard int, levels binary, counts binary")
    schema = f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_combine(shards, total, distinct), schema)
    return scored.select("doc_id", (fold("doc_id") == held_out).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
