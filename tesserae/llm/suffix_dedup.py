"""Removing strings of bytes, or of words, that occur more than once, by suffix arrays over groups of candidates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import windows
from tesserae.llm.common import SPACE, batches, materialize, named, slices, table
from tesserae.llm.substring_dedup import codes_of_words
from tesserae.llm.suffix_array import suffix_array

#: Anchors with more kinds of content than this are settled by window hashes, which Spark can spread over tasks.
GROUP_KINDS = 1_000
#: Bytes that are suffix-sorted at once.
BLOCK_BYTES = 1 << 18


def codes_of_text(text: str) -> np.ndarray:
    return windows.codes_of_bytes(text.encode())


class Alphabet:
    """Characters that stand for 64-bit codes of words, the same ones until ``clear``."""

    def __init__(self):
        self.known: dict[int, str] = {}

    def spell(self, content: bytes) -> str:
        known = self.known
        # chr(0) stays free for separators, and surrogates aren't characters
        return "".join([known.get(c) or known.setdefault(c, chr(k if (k := len(known) + 1) < 0xD800 else k + 0x800)) for c in memoryview(content).cast("Q").tolist()])

    def clear(self):
        self.known.clear()


class Unit(NamedTuple):
    """What strings are made of: 64-bit codes of a text's symbols; what is shuffled of them; and how to read that again."""

    codes: Callable[[str], np.ndarray]
    content: Callable[[str], bytes]
    width: int
    words: bool


UNITS = {"byte": Unit(codes_of_text, str.encode, 1, False), "word": Unit(codes_of_words, lambda text: codes_of_words(text).tobytes(), 8, True)}


def _common(a: bytes | str, b: bytes | str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _reach(sides: list[bytes] | list[str]) -> list[int]:
    """For each string the longest prefix it has in common with any other of the list."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for a, b in zip(order, order[1:]):
        n = _common(sides[a], sides[b])
        out[a], out[b] = max(out[a], n), max(out[b], n)
    return out


def repeated_starts(pieces: list[bytes] | list[str], copies: list[int], size: int) -> list[list[int]]:
    """For each of ``pieces``, which all differ, the starts of the strings of ``size`` symbols that start elsewhere too.

    A piece with ``copies`` over 1 stands for that many. The pieces are joined, separated by a symbol that
    none of them has, and suffix-sorted; of all suffixes, a neighbour shares the longest prefix.
    """
    out: list[list[int]] = [[] for _ in pieces]
    joined, owner_start = [], []
    for p in pieces:
        owner_start.append(len(joined))
        joined += [b + 2 for b in (p if isinstance(p, bytes) else map(ord, p))]
        joined.append(1)
    data = (b"\0" if isinstance(pieces[0], bytes) else "\0").join(pieces)
    owner = np.repeat(np.arange(len(pieces)), [len(p) + 1 for p in pieces])
    ends = np.array([s + len(p) for s, p in zip(owner_start, pieces)])[owner]
    order = np.array(suffix_array(joined), np.int64)
    whole = ends[order] - order >= size
    hit = np.zeros(len(joined), bool)
    order_list, whole_list = order.tolist(), whole.tolist()
    for a, b, x, y in zip(order_list, order_list[1:], whole_list, whole_list[1:]):
        if x and y and data[a : a + size] == data[b : b + size]:
            hit[a] = hit[b] = True
    for k, p in enumerate(pieces):
        if len(p) >= size:
            if copies[k] > 1:
                out[k] = list(range(len(p) - size + 1))
            else:
                out[k] = np.flatnonzero(hit[owner_start[k] : owner_start[k] + len(p) - size + 1]).tolist()
    return out


def narrowed(contents: list[bytes] | list[str], anchors: list[int], copies: list[int], size: int):
    """Cut segments with a common anchor down to what a repeated string can cover.

    A string around the anchor that occurs in another segment too reaches no further left than the longest
    left context shared with any other, and likewise right; sorted contexts tell both.
    Returns distinct pieces, their copies, and (piece, offset of the piece in the segment) of each segment.
    """
    left = _reach([c[a - 1 :: -1] if a else c[:0] for c, a in zip(contents, anchors)])
    right = _reach([c[a:] for c, a in zip(contents, anchors)])
    pieces: dict[bytes | str, int] = {}
    total: list[int] = []
    where: list[tuple[int, int] | None] = []
    for k, (c, a) in enumerate(zip(contents, anchors)):
        start, end = a - left[k], a + right[k]
        if copies[k] > 1:  # stays whole: all of it is repeated
            start, end = 0, len(c)
        if end - start < size:
            where.append(None)
            continue
        n = pieces.setdefault(c[start:end], len(pieces))
        if n == len(total):
            total.append(0)
        total[n] += copies[k]
        where.append((n, start))
    return list(pieces), total, where


def _sorted_groups(part: Iterator[pa.RecordBatch], size: int, words: bool) -> Iterator[tuple]:
    """Repeated windows of whole groups, which come sorted by anchor; several small groups are sorted together."""
    group: list[tuple] = []
    block: list[tuple] = []
    block_bytes = 0
    alphabet = Alphabet()

    def settle():
        pieces, total, owners = [], [], []
        for rows, own, copies, where in block:
            base = len(pieces)
            pieces += own
            total += copies
            owners.append((rows, base, where))
        # pieces of different groups can be equal; they have different anchors, so no window in common matters
        distinct: dict[bytes | str, int] = {}
        number = [distinct.setdefault(p, len(distinct)) for p in pieces]
        copies = [0] * len(distinct)
        for n, c in zip(number, total):
            copies[n] = max(copies[n], c)
        starts = repeated_starts(list(distinct), copies, size) if distinct else []
        for rows, base, where in owners:
            for row, at in zip(rows, where):
                if at is None or row[5] > 1:
                    continue
                found = starts[number[base + at[0]]]
                last = None
                for s in [*found, None]:
                    if last is not None and s == last + 1:
                        last = s
                        continue
                    if last is not None:
                        yield row[1], row[2], row[3] + at[1] + first, last + 1 - first
                    first = last = s

    def close():
        nonlocal block_bytes
        contents = [alphabet.spell(r[6]) if words else r[6] for r in group]
        pieces, total, where = narrowed(contents, [r[4] for r in group], [r[5] for r in group], size)
        if pieces:
            block.append((list(group), pieces, total, where))
            block_bytes += sum(map(len, pieces))

    for batch in part:
        for row in slices(batch, ["anchor", "doc_id", "text_hash", "first", "at", "copies", "content"]):
            if group and group[0][0] != row[0]:
                close()
                group = []
                if block_bytes >= BLOCK_BYTES:
                    yield from settle()
                    block, block_bytes = [], 0
                    alphabet.clear()
            group.append(row)
    if group:
        close()
        yield from settle()


def _contents(docs: DataFrame, opened: DataFrame, size: int, gram: int, unit: Unit) -> DataFrame:
    """The symbols of open spans, with the place of the anchor in each."""
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("at", pa.int32()), ("copies", pa.int64()), ("content", pa.binary())])

    def rows(part):
        for batch in part:
            for doc, key, text, spans in slices(batch, ["doc_id", "text_hash", "text", "spans"]):
                data = unit.content(text)
                for s in spans:
                    content = data[unit.width * s["first"] : unit.width * (s["first"] + s["windows"] - 1 + size)]
                    codes = np.frombuffer(content, np.uint64) if unit.words else windows.codes_of_bytes(content)
                    grams = windows.Hashes(codes).every(gram).view(np.int64)
                    # the anchor is in every window of the segment, so between the last start and the first end
                    low = s["windows"] - 1
                    at = low + int(np.flatnonzero(grams[low : size - gram + 1] == s["anchor"])[0])
                    yield s["anchor"], doc, key, s["first"], at, s["copies"], content

    def run(part):
        return batches(rows(part), schema, weight=6)

    per = materialize(per_spans(opened), "open")
    return windows.attach(docs, per, "spans", "inner").mapInArrow(run, "anchor long, doc_id long, text_hash long, first int, at int, copies long, content binary")


def per_spans(opened: DataFrame) -> DataFrame:
    return windows.per_row(opened, "anchor", "first", "windows", "copies")


def repeated_strings(docs: DataFrame, size: int, gram: int, unit: Unit, group_kinds: int = GROUP_KINDS) -> DataFrame:
    """The strings of ``size`` symbols that start elsewhere too, as KEY, first, windows."""
    rows = windows.keyed(docs)
    found = materialize(windows.find_segments(rows, unit.codes, size, gram), "segments")
    repeated, opened = windows.settle(found)
    opened = materialize(opened, "opened")
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])

    def run(part):
        return batches(_sorted_groups(part, size, unit.words), schema, step=1 << 13)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = _contents(rows, opened.where(F.col("kinds") <= group_kinds), size, gram, unit).repartition(parts, "anchor").sortWithinPartitions("anchor")
    sorted_ = grouped.mapInArrow(run, "doc_id long, text_hash long, first int, windows int")
    out = repeated.unionByName(sorted_)
    large = opened.where(F.col("kinds") > group_kinds)
    if not large.isEmpty():
        out = out.unionByName(windows.repeated_by_hash(rows, large, unit.codes, size))
    return out


def _cut(size: int):
    def cut(text, runs):
        data = (text or "").encode()
        gone = windows.covered(runs, size)
        kept, at = [], 0
        for start, end in gone:
            kept.append(data[at:start])
            at = end
        kept.append(data[at:])
        left = b"".join(kept)
        return len(data), len(data) - len(left), len(gone), [{"start": a, "end": b} for a, b in gone], left

    return cut


def remove_repeats(docs: DataFrame, size: int = 400, gram: int = 64, carry: list[str] | None = None, group_kinds: int = GROUP_KINDS) -> DataFrame:
    """Remove every byte of the UTF-8 texts that is covered by a ``size``-byte string that also starts elsewhere.

    Candidates are segments around common anchors (``windows``); equal segments are counted, and segments
    that share an anchor and differ are gathered by anchor, narrowed and suffix-sorted. An anchor with over
    ``group_kinds`` different segments isn't gathered: its windows are counted by their 128-bit hashes.
    Strings are judged on the input and never cross rows.

    Returns doc_id, n_bytes, n_removed, n_spans, spans (maximal removed runs) and kept (binary: what is left
    may end inside a character), with the columns named in ``carry``. A null text is empty; a text of fewer
    than ``size`` bytes loses nothing; equal rows are copies of each other; null doc_ids are kept; an empty
    table gives no rows.
    """
    schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])
    ddl = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary"
    return windows.remove(docs, repeated_strings(docs, size, gram, UNITS["byte"], group_kinds), _cut(size), schema, ddl, carry or [])


#: ASCII words, as everywhere here; the space after a word goes with it.
_WORD = re.compile(f"[^{SPACE}]+")


def _without_words(text: str, runs, size: int) -> str:
    """``text`` without the words of repeated windows and the white space after each; all else stays as it is."""
    gone = windows.covered(runs, size)
    if not gone:
        return text
    start = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at : start[a]])
        at = start[b]
    return "".join([*kept, text[at:]])


def clean(docs: DataFrame, size: int = 400, gram: int = 64, unit: str = "byte") -> DataFrame:
    """``docs`` without the strings of ``size`` symbols (``unit``: bytes or words) in texts that also start elsewhere, and
    with n_chars (if there) counted anew.

    Strings are judged on the input and never cross rows. Bytes that are left of a character partly removed go
    with it; with words goes the white space after them. A null text stays null; one shorter than ``size`` stays
    as it is; equal rows are copies of each other, and all lose what they share; null doc_ids are kept; further
    columns pass through, whatever their names; an empty table gives no rows.
    """

    def cut(text, runs):
        if text is None:
            return None, None
        left = _without_words(text, runs, size) if unit == "word" else _cut(size)(text, runs)[-1].decode(errors="ignore")
        return left, len(left)

    schema = pa.schema([("new_text", pa.string()), ("new_chars", pa.int64())])
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    safe = {c: f"other_{k}" for k, c in enumerate(others)}
    renamed = docs.select("doc_id", "text", *(named(c).alias(n) for c, n in safe.items()))
    done = windows.remove(renamed, repeated_strings(renamed, size, gram, UNITS[unit]), cut, schema, "new_text string, new_chars long", list(safe.values()))
    back = {"doc_id": F.col("doc_id"), "text": F.col("new_text"), "n_chars": F.col("new_chars")} | {c: F.col(n) for c, n in safe.items()}
    return done.select(*(back[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], size: int) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, by comparing all strings; for tests."""
    data = [(t or "").encode() for t in texts]
    counts: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - size + 1):
            counts[d[i : i + size]] = counts.get(d[i : i + size], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if counts[d[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for i, b in enumerate(d) if not gone[i])
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


#: Two hexadecimal digits stand for a byte.
ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800)
), again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1
), run AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM (
      SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM again)) GROUP BY doc_id, r
), part AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM run
), cut AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM part JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
