"""Token ids as shuffled planes: fixed-size id blocks, transposed, compressed plane by plane.

Format.  A file set is two Parquet folders, so that every Hadoop file system can
hold it and Spark's commit protocol makes each file appear whole or not at all:

``chunks``  one row per chunk of whole documents: ``shard``, ``chunk``, ``n_ids``,
            ``doc_ids``, ``doc_lengths`` (ids of each), ``block_ids`` (ids of each
            block), ``block_planes`` (planes of each), ``plane_bytes`` (compressed
            length of each plane), ``payload`` (all planes, zstandard).
``index``   one row per chunk: ``shard``, ``chunk``, ``first_doc``, ``last_doc``,
            ``n_docs``, ``n_ids`` and ``start``, the ids of all chunks before it.

A block holds ``block_ids`` ids (fewer at a chunk's end).  ``byte`` planes are byte
0 of all its ids, then byte 1, and so on up to the last byte any id uses; ``bit``
planes are bit 0 of all ids, packed eight to a byte, then bit 1, and so on.  A
document's ids may cross blocks but not chunks; a chunk closes at the first
document end at or after ``chunk_ids`` ids, so one very long document is a chunk.
Shards are range partitions of the id column, so file order is document order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskloom.llm.common import batch_ids, steps

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
LEVEL = 3

def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of one block, uncompressed; as many as its largest id needs, at least one."""
    top = max(int(ids.max(initial=0)).bit_length(), 1)
    as_bytes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)[:, : (top + 7) // 8]
    if not bits:
        return [as_bytes[:, k].tobytes() for k in range(as_bytes.shape[1])]
    by_bit = np.unpackbits(np.ascontiguousarray(as_bytes), axis=1, bitorder="little")
    return [np.packbits(by_bit[:, k], bitorder="little").tobytes() for k in range(top)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        out = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            out[:, k] = np.frombuffer(plane, np.uint8)
        return out.view("<u4").ravel()
    out = np.zeros(n, "<u4")
    for k, plane in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little").astype("<u4") << np.uint32(k)
    return out


def encode_chunk(ids: np.ndarray, block: int, bits: bool, level: int) -> tuple[list[int], list[int], list[int], bytes]:
    """Ids per block, planes per block, compressed bytes per plane, payload."""
    press = zstandard.ZstdCompressor(level=level)
    sizes, counts, planes = [], [], []
    for at in range(0, len(ids), block):
        part = ids[at : at + block]
        packed = [press.compress(p) for p in to_planes(part, bits)]
        sizes.append(len(part))
        counts.append(len(packed))
        planes += packed
    return sizes, counts, [len(p) for p in planes], b"".join(planes)


def decode_chunk(sizes: list[int], counts: list[int], plane_bytes: list[int], payload: bytes, bits: bool) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    view, at, plane, out = memoryview(payload), 0, 0, []
    for n, k in zip(sizes, counts):
        planes = []
        for size in plane_bytes[plane : plane + k]:
            planes.append(unpack.decompress(view[at : at + size]))
            at += size
        plane += k
        out.append(from_planes(planes, n, bits))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def _writer(tokenizer: str, end_id: int, block: int, chunk: int, bits: bool, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, held = TaskContext.get().partitionId(), 0, 0
        parts: list[np.ndarray] = []
        ids: list[int | None] = []
        lengths: list[int] = []
        end = np.array([end_id], "<u4")

        def close() -> pa.RecordBatch:
            nonlocal number, held, parts, ids, lengths
            sizes, counts, planes, payload = encode_chunk(np.concatenate(parts), block, bits, level)
            row = [shard, number, held, ids, lengths, bits, sizes, counts, planes, payload]
            number, held, parts, ids, lengths = number + 1, 0, [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES)], names=_NAMES)

        for batch in batches:
            for at, to in steps(batch.column(1)):
                flat, ends = batch_ids(batch.column(1)[at:to], tokenizer)
                for k, doc_id in enumerate(batch.column(0)[at:to].to_pylist()):
                    parts += [flat[ends[k] : ends[k + 1]], end]
                    ids.append(doc_id)
                    lengths.append(int(ends[k + 1] - ends[k]) + 1)
                    held += lengths[-1]
                    if held >= chunk:
                        yield close()
        if ids:
            yield close()

    return write


_NAMES = ["shard", "chunk", "n_ids", "doc_ids", "doc_lengths", "bits", "block_ids", "block_planes", "plane_bytes", "payload"]
_TYPES = [
    pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_(),
    pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(),
]
CHUNKS = (
    "shard int, chunk int, n_ids bigint, doc_ids array<bigint>, doc_lengths array<bigint>, bits boolean, "
    "block_ids array<int>, block_planes array<int>, plane_bytes array<int>, payload binary"
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
    chunk_ids: int = CHUNK_IDS,
    bits: bool = False,
    level: int = LEVEL,
) -> None:
    """Encode whole texts and write ``path``/chunks and ``path``/index.

    Only the id and text columns are read.  A NULL or empty text is its end id
    alone.  NULL ids come first; rows with equal ids are ordered by text, and equal
    rows are all kept.  Document ids are whole numbers, or text of such; other ids raise
    an error.  An empty table writes an empty file set.  Byte planes are
    the default: repeated passages keep their alignment in them, whereas in bit
    planes eight ids share a byte.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")
    task = _writer(tokenizer, end_id, block_ids, chunk_ids, bits, level)
    # planes are compressed already
    ordered.mapInArrow(task, CHUNKS).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    heads = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").select("shard", "chunk", "n_ids", "doc_ids")
    shards = heads.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # one row per file
    before = F.coalesce(F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", before.alias("before"))
    inside = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    index = heads.select(
        "shard",
        "chunk",
        F.element_at("doc_ids", 1).alias("first_doc"),
        F.element_at("doc_ids", -1).alias("last_doc"),
        F.size("doc_ids").alias("n_docs"),
        "n_ids",
        F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_shard"),
    ).join(shards, "shard")
    index.select(
        "shard", "chunk", "first_doc", "last_doc", "n_docs", "n_ids", (F.col("before") + F.col("in_shard")).alias("start")
    ).write.parquet(f"{path}/index")


def _reader(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, chunk, _, doc_ids, lengths, bits, sizes, counts, planes, payload = (
                    column[row].as_py() for column in batch.columns
                )
                ids = decode_chunk(sizes, counts, planes, payload, bits)
                lengths = np.asarray(lengths, np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                cells = [ids[a:b].tobytes() for a, b in zip(starts, ends)]
                n = len(doc_ids)
                out = [
                    pa.array([shard] * n, pa.int32()),
                    pa.array([chunk] * n, pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array([zlib.crc32(c) for c in cells], pa.int64()),
                ]
                names = ["shard", "chunk", "doc_id", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([np.frombuffer(c, "<u4").astype(np.int64) for c in cells], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return read


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` its ids."""
    schema = "shard int, chunk int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""
    read = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").mapInArrow(_reader(with_ids), schema)
    index = spark.read.schema("shard int, chunk int, start bigint").parquet(f"{path}/index")
    columns = ["doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"]
    return read.join(index, ["shard", "chunk"]).select(*columns, *(["ids"] if with_ids else []))
