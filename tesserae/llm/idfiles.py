"""Token-id files: id blocks in byte or bit planes, each plane compressed on its own, with a chunk index.

Layout of a file::

    magic | planes of block 0 | planes of block 1 | ... | index | size of index (8) | magic

The index is a zstandard frame of: a JSON line (block size, plane kind, counts), then the arrays
``block_at`` (offset of each block), ``plane_bytes`` (compressed size of each plane of each block; 0
where all bits are zero), ``doc_id``, ``doc_null`` and ``doc_tokens``.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import batches, materialize, scratch_dir, slices, table
from tesserae.llm.encode import default_path, encoder

MAGIC = b"TSIDS001"
END = (1).to_bytes(4, "little")


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """4 byte planes or 32 bit planes of unsigned 32-bit ids, lowest first."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [octets[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        octets = np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class Writer:
    """Writes one file; documents are added in order."""

    def __init__(self, out, block: int = 1 << 15, kind: str = "byte", level: int = 1):
        self.out, self.block, self.kind = out, block, kind
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.at, self.block_at, self.plane_bytes = len(MAGIC), [], []
        self.pending, self.n_pending = [], 0
        self.docs, self.tokens = [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.tokens.append(len(ids) // 4)
        self.pending.append(ids)
        self.n_pending += len(ids) // 4
        if self.n_pending >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        at = 0
        while len(ids) - at >= self.block or last and at < len(ids):
            self.block_at.append(self.at)
            for plane in to_planes(ids[at : at + self.block], self.kind):
                packed = self.zstd.compress(plane) if any(plane) else b""
                self.plane_bytes.append(len(packed))
                self.out.write(packed)
                self.at += len(packed)
            at += self.block
        rest = ids[at:].tobytes()
        self.pending, self.n_pending = [rest], len(rest) // 4

    def close(self) -> None:
        self._flush(True)
        head = {"block": self.block, "kind": self.kind, "blocks": len(self.block_at), "docs": len(self.docs), "ids": int(sum(self.tokens))}
        index = json.dumps(head).encode() + b"\n"
        for values, kind in ((self.block_at, "<i8"), (self.plane_bytes, "<i4"), ([d or 0 for d in self.docs], "<i8"), ([d is None for d in self.docs], "u1"), (self.tokens, "<i8")):
            index += np.array(values, kind).tobytes()
        packed = self.zstd.compress(index)
        self.out.write(packed + len(packed).to_bytes(8, "little") + MAGIC)


class Reader:
    """Random access by block, and documents in order, over a seekable file."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        end = file.tell()
        file.seek(end - 16)
        tail = file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token-id file, or cut short")
        n = int.from_bytes(tail[:8], "little")
        file.seek(end - 16 - n)
        index = zstandard.ZstdDecompressor().decompress(file.read(n))
        line, _, rest = index.partition(b"\n")
        self.head = json.loads(line)
        planes = 4 if self.head["kind"] == "byte" else 32
        at, arrays = 0, []
        for count, kind in ((self.head["blocks"], "<i8"), (self.head["blocks"] * planes, "<i4"), (self.head["docs"], "<i8"), (self.head["docs"], "u1"), (self.head["docs"], "<i8")):
            arrays.append(np.frombuffer(rest, kind, count, at))
            at += arrays[-1].nbytes
        self.block_at, sizes, self.docs, self.nulls, self.tokens = arrays
        self.plane_bytes = sizes.reshape(-1, planes)

    def read_block(self, k: int) -> np.ndarray:
        kind, block = self.head["kind"], self.head["block"]
        n = min(block, self.head["ids"] - k * block)
        size = n if kind == "byte" else -(-n // 8)
        self.file.seek(int(self.block_at[k]))
        zstd, planes = zstandard.ZstdDecompressor(), []
        for packed in self.plane_bytes[k]:
            planes.append(zstd.decompress(self.file.read(int(packed)), max_output_size=size) if packed else bytes(size))
        return from_planes(planes, n, kind)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in this file, ids), a block at a time."""
        held, at, k, start = np.empty(0, "<u4"), 0, 0, 0
        for doc, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.tokens.tolist()):
            parts = []
            need = n
            while need:
                if at == len(held):
                    held, at, k = self.read_block(k), 0, k + 1
                parts.append(held[at : at + need])
                at += len(parts[-1])
                need -= len(parts[-1])
            yield None if null else doc, start, np.concatenate(parts) if parts else held[:0]
            start += n


def _written(part: Iterator[pa.RecordBatch], folder: str, tokenizer: str, file_ids: int, kind: str) -> Iterator[tuple]:
    """Writes the files of one partition; a task that runs again writes the same files under the same names."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    enc, context = encoder(tokenizer), TaskContext.get()
    number, writer, out, n_ids = 0, None, None, 0

    def done():
        writer.close()
        out.close()
        name = f"part-{context.partitionId():06d}-{number:05d}.ids"
        store.move(temporary, f"{root}/{name}")
        return context.partitionId(), number, f"{folder}/{name}", len(writer.docs), n_ids

    for batch in part:
        for doc, text in slices(batch, ["doc_id", "text"]):
            if writer is None:
                temporary = f"{root}/.{context.partitionId():06d}-{number:05d}-{context.taskAttemptId()}"
                out = store.open_output_stream(temporary)
                writer, n_ids = Writer(out, kind=kind), 0
            ids = enc.encode(text) + END
            writer.add(doc, ids)
            n_ids += len(ids) // 4
            if n_ids >= file_ids:
                yield done()
                number, writer = number + 1, None
    if writer is not None:
        yield done()


def write_ids(docs: DataFrame, folder: str, tokenizer: str, file_ids: int = 1 << 24, kind: str = "byte") -> DataFrame:
    """Encode ``docs`` and write id files below ``folder``, in ascending doc_id order.

    Rows are dealt by ranges of doc_id (then of the text's hash, so ties have an order and can be split)
    and each range becomes files of about ``file_ids`` ids. Null doc_ids come first; a null or empty text
    is its end id alone; other columns are not read; an empty table writes no file.

    Returns the manifest: part, number, path, n_docs, n_ids and ``start``, the ids in all files before.
    """
    spark = docs.sparkSession
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(part):
        return batches(_written(part, folder, tokenizer, file_ids, kind), schema)

    files = materialize(ordered.mapInArrow(run, "part int, number int, path string, n_docs long, n_ids long"), "manifest")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    return files.join(starts, "part").withColumn("start", F.col("part_start") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).drop("part_start")


def read_ids(manifest: DataFrame) -> DataFrame:
    """The documents in the files of ``manifest``: doc_id, start, n_tokens, ids (binary)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def rows(part):
        for batch in part:
            for path, start in slices(batch, ["path", "start"]):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    for doc, at, ids in Reader(file).documents():
                        yield doc, start + at, len(ids), ids.tobytes()

    def run(part):
        return batches(rows(part), schema, weight=3)

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "start").repartition(parts, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = write_ids(docs, scratch_dir(spark, "ids"), default_path("word_bpe_49k.json"))
    return read_ids(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
