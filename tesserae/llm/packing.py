"""Packing token streams into fixed windows by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import batches, slices, table
from tesserae.llm.encode import CACHE_WORDS, default_path, encoder

#: Id that ends a document.
END = (1).to_bytes(4, "little")


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that counts them.

    Leaf ``c`` stands for the windows with ``c`` free places; an inner node counts those below.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, free: int, n: int) -> None:
        node = self.leaves + free
        while node:
            self.counts[node] += n
            node >>= 1

    def put(self, window: int, free: int) -> None:
        if free:
            self.windows[free].append(window)
            self._add(free, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of at least ``need``: (window, capacity)."""
        node = self.leaves + need
        counts = self.counts
        if not counts[node]:
            while node > 1 and (node & 1 or not counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if counts[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._add(free, -1)
        return self.windows[free].pop(), free


def best_fit(lengths: list[int], size: int) -> list[tuple[int, int]]:
    """(window, offset) of each piece; pieces are placed from the longest to the shortest, ties in order."""
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    trees, opened = OpenWindows(size), 0
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = trees.tightest(lengths[k]) if lengths[k] < size else None
        window, free = found or (opened, size)
        opened += found is None
        placed[k] = (window, size - free)
        trees.put(window, free - lengths[k])
    return placed


def _packed(part: Iterator[pa.RecordBatch], path: str, size: int, block_tokens: int, cache_words: int) -> Iterator[tuple]:
    enc = encoder(path, cache_words)
    base = TaskContext.get().partitionId() << 36
    held: list[tuple] = []
    tokens = 0

    def flush() -> Iterator[tuple]:
        nonlocal base
        placed = best_fit([len(x[2]) // 4 for x in held], size)
        for (doc, start, ids, total), (window, offset) in zip(held, placed):
            yield doc, start, len(ids) // 4, total, base + window, offset, ids
        base += 1 + max(w for w, _ in placed)

    for batch in part:
        for doc, text in slices(batch, ["doc_id", "text"]):
            ids = enc.encode(text) + END
            total = len(ids) // 4
            for at in range(0, total, size):
                held.append((doc, at, ids[4 * at : 4 * (at + size)], total))
            tokens += total
            if tokens >= block_tokens:
                yield from flush()
                held, tokens = [], 0
    if held:
        yield from flush()


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, block_tokens: int = 1 << 23, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pack the texts of ``docs`` into windows of ``size`` tokens.

    Documents longer than a window are first cut into full windows; what remains is placed by best-fit
    decreasing among the pieces of the same input partition, in blocks of ``block_tokens`` (the bound
    on memory). Nothing is shuffled: a block leaves less than a window or so of padding behind. A Python worker keeps
    the ids of ``cache_words`` words.

    Returns doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary). A null or empty text
    is its end id alone; repeated rows and null doc_ids are packed like any other; an empty table gives
    no rows; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(part):
        return batches(_packed(part, tokenizer, size, block_tokens, cache_words), schema, weight=6)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json")))
