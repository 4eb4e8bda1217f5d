"""Repeated fixed-length windows, found through canonical anchors.

Every window of ``size`` symbols has one *anchor*: the leftmost k-gram in it whose scrambled hash is
least. Equal windows have equal anchors at equal places, so a window can only be repeated where its
anchor is. Consecutive windows with one anchor form a *segment*; segments, not windows, are what is
shuffled, about one row for half a window's length of text. Segments of equal content are counted
together, which settles all their windows at once; a segment whose anchor occurs nowhere else is
settled too. Only segments that share an anchor but not their content are looked at window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import batches, carried, materialize, named, slices

_MASK = (1 << 64) - 1
#: Windows of a text that are hashed at once.
PIECE = 1 << 22
#: Odd bases of the two polynomial hashes modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _scrambled(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return scramble(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a base and of its inverse, grown as texts ask for them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 1 << 14)
            up, down = np.full(size, self.base, np.uint64), np.full(size, self.inverse, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = [_Powers(b) for b in BASES]
_BYTES = _scrambled(256, 7)


class Hashes:
    """Rabin-Karp hashes of the substrings of one sequence of 64-bit symbol codes."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums, self.down = [], []
        for powers in _POWERS:
            up, down = powers.to(self.n)
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * up[: self.n], out=total[1:])
            self.sums.append(total)
            self.down.append(down)

    def of(self, start, end, which: int) -> np.ndarray:
        total = self.sums[which]
        return scramble((total[end] - total[start]) * self.down[which][start])

    def every(self, size: int, which: int = 0) -> np.ndarray:
        """Hashes of all windows of ``size`` symbols."""
        total, n = self.sums[which], self.n - size + 1
        return scramble((total[size:] - total[:n]) * self.down[which][:n])


def codes_of_bytes(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, np.uint8)]


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


def segments(codes: np.ndarray, size: int, gram: int, piece: int = PIECE):
    """(anchor hash, content hash, second content hash, first window, windows) of each segment, or None.

    A very long text is taken in pieces of ``piece`` windows, which bounds the memory; a segment that is cut
    there is two of other content, so it may only stay open where a whole one would have been settled.
    """
    if len(codes) < size:
        return None
    if len(codes) - size >= piece:
        parts = [(at, segments(codes[at : at + piece + size - 1], size, gram, piece)) for at in range(0, len(codes) - size + 1, piece)]
        return tuple(np.concatenate([p[k] + at * (k == 3) for at, p in parts]) for k in range(5))
    hashes = Hashes(codes)
    grams = hashes.every(gram)
    places = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min((grams >> np.uint64(32) << np.uint64(32)) | places, size - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.diff(np.append(first, len(anchor)))
    end = first + count - 1 + size
    # the length takes part, since the codes of a prefix could sum to the same
    one = hashes.of(first, end, 0) ^ scramble(count.astype(np.uint64))
    return grams[anchor[first]].view(np.int64), one.view(np.int64), hashes.of(first, end, 1).view(np.int64), first, count


#: doc_id and a hash of the text name a row; equal rows have equal content, so either stands for both.
KEY = ["doc_id", "text_hash"]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")


def find_segments(docs: DataFrame, codes: Callable[[str], np.ndarray], size: int, gram: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64()), ("content2", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])

    def run(part: Iterator[pa.RecordBatch]):
        for batch in part:
            held, n = [], 0
            for doc, key, text in slices(batch, ["doc_id", "text_hash", "text"]):
                found = segments(codes(text), size, gram) if text else None
                if found is not None:
                    held.append((doc, key, found))
                    n += len(found[0])
                if n >= 1 << 16:
                    yield _columns(held, schema)
                    held, n = [], 0
            if held:
                yield _columns(held, schema)

    return docs.mapInArrow(run, "doc_id long, text_hash long, anchor long, content long, content2 long, first int, windows int")


def _columns(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    sizes = [len(f[0]) for _, _, f in held]
    known = np.array([d is not None for d, _, _ in held])
    ids = pa.array(np.repeat([d or 0 for d, _, _ in held], sizes), mask=~np.repeat(known, sizes))
    cols = [ids, pa.array(np.repeat(np.array([k for _, k, _ in held], np.int64), sizes))]
    cols += [pa.array(np.concatenate([f[i] for _, _, f in held])) for i in range(5)]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(cols, schema.types)], schema=schema)


def _runs(spans: DataFrame) -> DataFrame:
    """KEY and runs: the windows [first, last) of each row that are repeated, as maximal runs in order."""
    ordered = F.array_sort(F.collect_list(F.struct("first", (F.col("first") + F.col("windows")).alias("last"))))
    per = spans.groupBy(*KEY).agg(ordered.alias("all"))

    def join(runs, x):
        end = F.element_at(runs, -1)["last"]
        longer = F.struct(F.element_at(runs, -1)["first"].alias("first"), F.greatest(end, x["last"]).alias("last"))
        grown = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))
        return F.when((F.size(runs) > 0) & (x["first"] <= end), grown).otherwise(F.concat(runs, F.array(x)))

    nothing = F.array().cast("array<struct<first:int,last:int>>")
    return per.select(*KEY, F.aggregate("all", nothing, join).alias("runs"))


def attach(docs: DataFrame, per: DataFrame, column: str, how: str, rows: int = 250_000, items: int = 1_000_000) -> DataFrame:
    """Join ``per`` (a row for each KEY, materialized) to ``docs``.

    It is broadcast if it has at most ``rows`` rows and ``items`` array entries; beyond that both sides are
    shuffled by KEY.
    """
    n, total = per.agg(F.count("*"), F.sum(F.size(column))).first()
    side = per.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), column)
    if n <= rows and (total or 0) <= items:
        side = F.broadcast(side)
    return docs.join(side, docs["doc_id"].eqNullSafe(side["_doc"]) & (docs["text_hash"] == side["_hash"]), how).drop("_doc", "_hash")


def settle(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans that are repeated, spans still open) of the segments in ``found`` (materialized).

    Open spans are those that share an anchor with other content: every one that occurs once, and one
    of each content that occurs more often (``copies`` > 1), with ``kinds``, the contents of the anchor.
    """
    place = F.min(F.struct("doc_id", "text_hash", "first", "windows"))
    kinds = materialize(found.groupBy("anchor", "content", "content2").agg(F.count("*").alias("copies"), place.alias("at")), "contents")
    shared = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    repeated = found.join(kinds.where("copies > 1").select("anchor", "content", "content2"), ["anchor", "content", "content2"], "left_semi")
    opened = kinds.join(shared, "anchor").select("anchor", "kinds", "copies", "at.*")
    return repeated.select(*KEY, "first", "windows"), opened


def per_row(spans: DataFrame, *columns: str) -> DataFrame:
    """KEY and ``spans``: an array of structs of ``columns``, no longer than the row's text has segments."""
    return spans.groupBy(*KEY).agg(F.collect_list(F.struct(*columns)).alias("spans"))


def repeated_by_hash(docs: DataFrame, opened: DataFrame, codes: Callable[[str], np.ndarray], size: int) -> DataFrame:
    """KEY, first, windows (1) of the windows in ``opened`` whose hash occurs twice or more there."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("copies", pa.int64()), ("one", pa.int64()), ("two", pa.int64())])

    def rows(part):
        for batch in part:
            for doc, key, text, spans in slices(batch, ["doc_id", "text_hash", "text", "spans"]):
                own = codes(text)
                whole = Hashes(own) if len(own) <= PIECE else None
                for span in spans:
                    first, n = span["first"], span["windows"]
                    hashes, base = (whole, 0) if whole else (Hashes(own[first : first + n - 1 + size]), first)
                    start = np.arange(first - base, first - base + n)
                    pair = [hashes.of(start, start + size, k).view(np.int64).tolist() for k in (0, 1)]
                    for at, one, two in zip(range(first, first + n), *pair):
                        yield doc, key, at, span["copies"], one, two

    def run(part):
        return batches(rows(part), schema, step=1 << 14)

    per = materialize(per_row(opened, "first", "windows", "copies"), "open")
    hashed = attach(docs, per, "spans", "inner").mapInArrow(run, "doc_id long, text_hash long, first int, copies long, one long, two long")
    hashed = materialize(hashed, "hashes")
    again = hashed.groupBy("one", "two").agg(F.sum("copies").alias("n")).where("n > 1").select("one", "two")
    # content that occurs more than once is settled already
    return hashed.where("copies = 1").join(again, ["one", "two"], "left_semi").select(*KEY, "first", F.lit(1).alias("windows"))


def remove(docs: DataFrame, repeated: DataFrame, cut: Callable, schema: pa.Schema, ddl: str, carry: list[str]) -> DataFrame:
    """``cut(text, runs)`` for every row, runs being the repeated windows; returns doc_id, its columns and ``carry``
    (with _carry_ before a name of these)."""
    runs = materialize(_runs(repeated), "runs")
    kinds = {c: docs.schema[c].dataType.simpleString() for c in carry}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text", *(named(c).alias(f"carry_{k}") for k, c in enumerate(carry)))

    def run(part):
        for batch in part:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                made = [cut(text, runs) for text, runs in slices(piece, ["text", "runs"])]
                new = [pa.array(c, t) for c, t in zip(zip(*made), schema.types)]
                old = [piece.column(piece.schema.get_field_index(f"carry_{k}")) for k in range(len(carry))]
                yield pa.RecordBatch.from_arrays([piece.column(piece.schema.get_field_index("doc_id")), *new, *old], ["doc_id", *schema.names, *(f"carry_{k}" for k in range(len(carry)))])

    out = attach(rows, runs, "runs", "left").drop("text_hash").mapInArrow(run, f"doc_id long, {ddl}" + "".join(f", carry_{k} {kinds[c]}" for k, c in enumerate(carry)))
    names = carried(carry, ["doc_id", *schema.names])
    return out.withColumnsRenamed({f"carry_{k}": c for k, c in enumerate(names)})


def covered(runs, size: int) -> list[tuple[int, int]]:
    """Maximal stretches [start, end) of symbols in the windows of ``runs``, which are in order."""
    out: list[list[int]] = []
    for x in runs or ():
        start, end = x["first"], x["last"] - 1 + size
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]
