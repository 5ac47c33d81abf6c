"""Token ids in binary files of bit-shuffled blocks.

A file holds whole documents. Its ids are cut into blocks of a fixed size; each block
is transposed into byte planes (the first bytes of all ids, then the second ...) or bit
planes, and every plane is compressed with zstandard by itself. High planes are nearly
constant and shrink to a few bytes. Layout, all numbers little-endian:

    magic, ids, ids per block, planes per block, documents   header, 28 bytes
    planes                                                   block after block
    ids per document (u64), document keys (i64), key is NULL (u8)
    bytes of each plane of each block (u32)                  the chunk index

A stored table keeps one file per row (``shard``, ``file``, ``ids``, ``content``), so
writing is committed by Spark as a whole, whatever the storage and whichever executors
are lost; ``content`` is the complete file, and readers need nothing else.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.tokens import AddedTokens, Batches, encode_batches

HEADER = struct.Struct("<8sQIII")
MAGIC = b"IDPLANE1"
BLOCK_IDS, FILE_IDS, LEVEL = 16_384, 1_000_000, 3


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [plane.tobytes() for plane in np.ascontiguousarray(rows.T)]
    flags = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(plane, bitorder="little").tobytes() for plane in np.ascontiguousarray(flags.T)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        rows = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        flags = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        rows = np.packbits(flags, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").ravel()


def build_file(ids: np.ndarray, keys: list[int | None], lengths: list[int], block: int = BLOCK_IDS, bits: bool = False, level: int = LEVEL) -> bytes:
    press = zstandard.ZstdCompressor(level=level).compress
    planes = [press(p) for at in range(0, len(ids), block) for p in to_planes(ids[at:at + block], bits)]
    return b"".join([
        HEADER.pack(MAGIC, len(ids), block, 32 if bits else 4, len(keys)), *planes,
        np.array(lengths, "<u8").tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(), np.array([len(p) for p in planes], "<u4").tobytes(),
    ])


class PlaneFile:
    """A file's chunk index and documents; blocks are read on demand."""

    def __init__(self, content: bytes):
        magic, self.n, self.block, self.planes, docs = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a plane file")
        self.content = content
        chunks = -(-self.n // self.block) * self.planes
        sizes = np.frombuffer(content, "<u4", chunks, len(content) - 4 * chunks)
        self.at = HEADER.size + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        tail = int(self.at[-1])
        self.lengths = np.frombuffer(content, "<u8", docs, tail).astype(np.int64)
        keys = np.frombuffer(content, "<i8", docs, tail + 8 * docs).tolist()
        nulls = np.frombuffer(content, np.uint8, docs, tail + 16 * docs)
        self.keys = [None if none else key for key, none in zip(keys, nulls)]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def read_block(self, number: int) -> np.ndarray:
        expand = zstandard.ZstdDecompressor().decompress
        first = number * self.planes
        parts = [expand(self.content[self.at[i]:self.at[i + 1]]) for i in range(first, first + self.planes)]
        return from_planes(parts, min(self.block, self.n - number * self.block))

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids from ``start`` on; only the blocks that hold them are opened."""
        if n == 0:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (start + n - 1) // self.block
        ids = np.concatenate([self.read_block(b) for b in range(first, last + 1)])
        return ids[start - first * self.block:][:n]


def sorted_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` in ascending order over all partitions; a hash of the text splits equal ids."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    return keyed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")


def file_writer(block: int = BLOCK_IDS, file_ids: int = FILE_IDS, bits: bool = False) -> Callable[[Batches], Batches]:
    """Turns batches of ``doc_id`` (integer or NULL) and ``ids`` into rows of :data:`FILES`, one for each file.

    Each partition becomes a shard of files of about ``file_ids`` ids; a longer document gets a
    file of its own. Documents without ids are kept. Memory: one file at a time.
    """
    def run(batches: Batches) -> Batches:
        shard, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            content = build_file(np.frombuffer(b"".join(parts), "<u4"), keys, [len(p) // 4 for p in parts], block, bits)
            return pa.RecordBatch.from_pylist([{"shard": shard, "file": number, "ids": held, "content": content}], pa.schema(
                [("shard", pa.int32()), ("file", pa.int32()), ("ids", pa.int64()), ("content", pa.binary())]))

        for batch in batches:
            for key, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                n = len(ids or b"") // 4
                if keys and held + n > file_ids:
                    yield flush()
                    keys, parts, held, number = [], [], 0, number + 1
                keys.append(key)
                parts.append(ids or b"")
                held += n
        if keys:
            yield flush()

    return run


FILES = "shard int, file int, ids long, content binary"


def store(files: DataFrame, path: str) -> None:
    files.write.option("compression", "uncompressed").parquet(path)


def write_files(encoded: DataFrame, path: str, block: int = BLOCK_IDS, file_ids: int = FILE_IDS, bits: bool = False) -> None:
    """Write ``ids`` (binary) of rows keyed by ``doc_id`` in their present order."""
    store(encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(file_writer(block, file_ids, bits), FILES), path)


def write_texts(docs: DataFrame, path: str, encoder: Callable[[], Memory | AddedTokens], end: int | None) -> None:
    """Encode every whole ``text`` and write the ids in ascending ``doc_id``, in one pass."""
    ordered = sorted_documents(docs.select(F.col("doc_id").cast("long"), "text"))
    store(encode_batches(ordered, encoder, end, ("doc_id",), file_writer(), FILES, together=True), path)


def read_files(spark: SparkSession, path: str, *derive: Column) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``ids`` (binary).

    With ``derive``, these columns made from ``ids`` take its place, and only they are moved
    when the starts are joined.
    """
    files = spark.read.parquet(path)

    def run(batches: Batches) -> Batches:
        schema = pa.schema([("doc_id", pa.int64()), ("_inside", pa.int64()), ("ids", pa.binary()), ("_shard", pa.int32()), ("_file", pa.int32())])
        for batch in batches:
            for shard, number, content in zip(*(batch.column(c).to_pylist() for c in ("shard", "file", "content"))):
                file = PlaneFile(content)
                ids = file.read(0, file.n).tobytes()
                spans = [(s, s + n) for s, n in zip(file.starts.tolist(), file.lengths.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(file.keys, pa.int64()), pa.array([s for s, _ in spans], pa.int64()),
                    pa.array([ids[4 * a:4 * b] for a, b in spans], pa.binary()),
                    pa.array([shard] * len(spans), pa.int32()), pa.array([number] * len(spans), pa.int32()),
                ], schema=schema)

    documents = files.select("shard", "file", "content").mapInArrow(run, "doc_id long, _inside long, ids binary, _shard int, _file int")
    # starts: shards in order (one row for each), then the files of a shard
    shards = files.groupBy("shard").agg(F.sum("ids").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("ids").over(Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (
        files.select("shard", "file", inside.alias("_in")).join(shards.select("shard", earlier.alias("_before")), "shard")
        .select(F.col("shard").alias("_shard"), F.col("file").alias("_file"), (F.col("_in") + F.col("_before")).alias("_start"))
    )
    kept = documents.select("_shard", "_file", "_inside", "doc_id", *(derive or ["ids"]))
    start = (F.col("_start") + F.col("_inside")).alias("start")
    return kept.join(starts, ["_shard", "_file"]).select("doc_id", start, *kept.columns[4:])
