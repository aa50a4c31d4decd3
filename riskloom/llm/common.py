"""What several corpus operators share: tables, folds and tokenizer access in tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh3_64_intdigest

# Chunks in each of the two generations that a worker keeps.
CACHED_CHUNKS = 250_000
# Longer chunks are encoded each time they are met.
CACHED_LENGTH = 48
BATCH_ROWS = 2_000
# Bytes of text that a task works on at once, unless one text is longer.
STEP_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of so many rows, unless the session says otherwise: texts are long rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) in (None, "10000"):
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(folds))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine; every executor has its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


_LOADED: dict[str, object] = {}


def load_tokenizer(name: str):
    """The tokenizer, loaded once per worker process; ``name`` is a public file name or a path."""
    if name not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[name] = Tokenizer.from_file(name if "/" in name else tokenizer_path(name))
    return _LOADED[name]


def _byte_level() -> dict[int, str]:
    """Latin-1 character -> what byte-level vocabularies write for its UTF-8 bytes."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letter = {b: chr(b) for b in shown}
    letter |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letter)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


_BYTE_LEVEL = _byte_level()


class ChunkIds:
    """Chunk without white space -> its ids as little-endian unsigned 32-bit bytes.

    Right for tokenizers that lower-case, drop white space and take a run of
    letters as one pre-token, so that a text's ids are those of its chunks joined.
    Two generations of a bounded number of bounded chunks are kept, so that
    frequent chunks stay while rare ones go.
    """

    def __init__(self, tokenizer):
        self.encode, self.pieces = tokenizer.encode, tokenizer.model.tokenize
        self.bytes = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, chunk: str) -> bytes:
        ids = self.young.get(chunk)
        if ids is None:
            ids = self.old.get(chunk)
            if ids is None:
                ids = self.fresh(chunk)
            if len(chunk) <= CACHED_LENGTH:
                if len(self.young) >= CACHED_CHUNKS:
                    self.old, self.young = self.young, {}
                self.young[chunk] = ids
        return ids

    def fresh(self, chunk: str) -> bytes:
        if chunk.isalpha():  # one pre-token
            if chunk.isascii():
                return b"".join([self.bytes[p.id] for p in self.pieces(chunk.lower())])
            if max(chunk) < "\u0100":  # here lower-casing has no context and nothing composes
                return b"".join([self.bytes[p.id] for p in self.pieces(chunk.lower().translate(_BYTE_LEVEL))])
        elif chunk[-1:] in (",", ".") and chunk[:-1].isalpha() and max(chunk) < "\u0100":  # two
            return self(chunk[:-1]) + self(chunk[-1])
        return b"".join([self.bytes[i] for i in self.encode(chunk, add_special_tokens=False).ids])


_CHUNKS: dict[str, ChunkIds | None] = {}


def ids_by_chunks(tokenizer) -> bool:
    """Whether ``ChunkIds`` is right for a tokenizer: it lower-cases, and takes runs of letters as pre-tokens and no white space."""
    form = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (form.get("normalizer") or {}).get("normalizers", [])]
    split = (form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and [p.get("type") for p in split] == ["Split", "ByteLevel"]
        and split[0]["behavior"] == "Removed"
        and split[0]["invert"]
        and "[\\p{L}]+" in split[0]["pattern"]["Regex"]
        and split[0]["pattern"]["Regex"].endswith("[^\\s\\p{L}\\p{N}]+")
    )


def steps(texts: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each; one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, to
        at = to


def batch_ids(texts: pa.Array, tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts (NULL: none), one after another, and where each text's ids begin, and the end.

    Texts are split at ASCII white space, which no special string of the tokenizer
    holds and which it drops; other white space stays in a chunk and the tokenizer
    drops it.  Each distinct chunk of the batch is looked up once.  Other tokenizers
    encode whole texts.
    """
    if tokenizer not in _CHUNKS:
        loaded = load_tokenizer(tokenizer)
        _CHUNKS[tokenizer] = ChunkIds(loaded) if ids_by_chunks(loaded) else None
    chunks = _CHUNKS[tokenizer]
    if chunks is None:
        coded = load_tokenizer(tokenizer).encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        lists = [c.ids for c in coded]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return np.fromiter((i for x in lists for i in x), "<u4", ends[-1]), ends
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    bounds = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    found = list(map(chunks, coded.dictionary.to_numpy(zero_copy_only=False)))
    pool = np.frombuffer(b"".join(found), "<u4")
    lengths = np.fromiter(map(len, found), np.int64, len(found)) >> 2
    starts = np.cumsum(lengths) - lengths
    each = lengths[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    ids = pool[np.repeat(starts[codes] - ends[:-1], each) + np.arange(ends[-1])] if len(codes) else pool[:0]
    return ids, ends[bounds - bounds[0]]


def batch_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII white space (NULL: none): a code for each, the words by code, and the bounds of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(coded.dictionary, "").as_py()
    bounds = bounds - bounds[0]
    if empty >= 0:
        words = codes != empty
        bounds = np.concatenate([[0], np.cumsum(words)])[bounds]
        codes = codes[words]
    return codes, coded.dictionary, bounds


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in every task."""
    cells = words.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxh3_64_intdigest, cells), np.uint64, len(cells))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser for 64-bit keys."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between bounds, each from its own values alone, so that equal texts get equal sums."""
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    out = np.zeros(len(bounds) - 1, values.dtype)
    if len(full):
        out[full] = np.add.reduceat(values[: bounds[-1]], bounds[full])
    return out


def labelled_ids(labels: DataFrame, label: str, per_class: int | None = None, held_out: int | None = None) -> DataFrame:
    """doc_id and label (0 or 1) of all labelled documents, or of at most ``per_class`` of each class, the first by a hash of the id.

    A document labelled more than once has its largest label; NULL ids and labels are
    left out, and with ``held_out`` the ids of that fold.
    """
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if held_out is not None:
        one = one.filter(fold("doc_id") != held_out)
    one = one.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    if per_class is None:
        return one
    first = [one.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return first[0].unionByName(first[1])
