"""Removing passages of words that occur more than once, by the hashes of all their windows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import windows
from tesserae.llm.common import batches, keep, slices, table

#: Words whose codes each Python worker keeps.
CACHE_WORDS = 150_000
_SEEN: dict[bytes, int] = {}


def codes_of_words(text: str) -> np.ndarray:
    """64-bit codes of the words of ``text``, the runs between ASCII white space."""
    keep(_SEEN)
    words, seen = text.encode().split(), _SEEN
    out = np.empty(len(words), np.uint64)
    for k, w in enumerate(words):
        code = seen.get(w)
        if code is None:
            code = xxhash.xxh3_64_intdigest(w)
            if len(seen) < CACHE_WORDS:
                seen[w] = code
        out[k] = code
    return out


def _cut(size: int):
    def cut(text, runs):
        words = (text or "").encode().split()
        gone = windows.covered(runs, size)
        kept, at = [], 0
        for start, end in gone:
            kept += words[at:start]
            at = end
        kept += words[at:]
        return len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in gone], b" ".join(kept).decode()

    return cut


#: Windows that are hashed and sorted at once; a longer text is taken in pieces.
CHUNK = 1 << 19
#: Buckets of hashes for each shuffle partition; one bucket at a time is sorted.
BUCKETS = 4
_ROW = "chunk long, bucket int, docs array<struct<doc_id:long,text_hash:long,at:int,words:int,first:int>>, hashes binary, tags binary, places binary"
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32()), ("words", pa.int32()), ("first", pa.int32())]))
_SCHEMA = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("docs", _DOCS), ("hashes", pa.binary()), ("tags", pa.binary()), ("places", pa.binary())])
_FOUND = pa.schema([("chunk", pa.int64()), ("docs", _DOCS), ("places", pa.binary())])


def _hashed(chunk: int, held: list[tuple], size: int, buckets: int) -> pa.RecordBatch:
    """Rows of one chunk: for each bucket the hashes of the windows that fall into it, and one row that names the texts.

    ``held`` has (doc_id, text_hash, first word, codes). A window has a place, that of its first word among all
    words of the chunk. Windows that occur twice in the chunk are known to be repeated; the row that names the
    texts lists their places, and the buckets get one of each.
    """
    codes = np.concatenate([c for *_, c in held])
    ends = np.cumsum([len(c) for *_, c in held])
    change = np.zeros(len(codes) + 1, np.int8)
    change[ends - size + 1] -= 1
    change[ends] += 1
    places = np.flatnonzero(np.cumsum(change[:-1], dtype=np.int8) == 0)
    hashes = windows.Hashes(codes)
    one, two = (hashes.every(size, k)[places] for k in (0, 1))
    order = np.argsort(one, kind="stable")
    again = one[order][1:] == one[order][:-1]
    own = np.zeros(len(places), bool)
    own[order[1:][again]] = own[order[:-1][again]] = True
    once = np.ones(len(places), bool)
    once[order[1:][again]] = False
    own_places = places[own].astype("<u4")

    one, two, places = one[once], two[once], places[once].astype("<u4")
    bucket = ((two >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    one, tags, places, bucket = one[order], two[order].astype("<u2"), places[order], bucket[order].astype(np.int64)
    low, high = (places & 0xFFFF).astype("<u2"), (places >> 16).astype("<u2")
    start = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1))
    spans = list(zip(start.tolist(), [*start[1:].tolist(), len(bucket)]))
    texts = [{"doc_id": d, "text_hash": k, "at": int(e) - len(c), "words": len(c), "first": f} for (d, k, f, c), e in zip(held, ends)]
    columns = [
        [chunk] * (len(spans) + 1),
        [*bucket[start].tolist(), chunk % buckets],
        [None] * len(spans) + [texts],
        [*(one[a:b].tobytes() for a, b in spans), None],
        [*(tags[a:b].tobytes() for a, b in spans), None],
        # the low and the high halves apart, of which the latter compress well
        [*(low[a:b].tobytes() + high[a:b].tobytes() for a, b in spans), own_places.tobytes()],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types)], schema=_SCHEMA)


def hash_windows(docs: DataFrame, size: int, buckets: int, chunk: int = CHUNK) -> DataFrame:
    """Rabin-Karp hashes of every window of ``size`` words, packed by chunk of texts and bucket of hashes."""

    def run(part):
        number = TaskContext.get().partitionId() << 32
        held, n = [], 0
        for batch in part:
            for doc, key, text in slices(batch, ["doc_id", "text_hash", "text"]):
                own = codes_of_words(text) if text else ()
                for first in range(0, len(own) - size + 1, chunk):
                    held.append((doc, key, first, own[first : first + chunk + size - 1]))
                    n += len(held[-1][3])
                    if n >= chunk:
                        yield _hashed(number, held, size, buckets)
                        held, n, number = [], 0, number + 1
        if held:
            yield _hashed(number, held, size, buckets)

    return docs.mapInArrow(run, _ROW)


def _repeated_places(rows: list[tuple]) -> list[tuple]:
    """(chunk, None, places) of the windows in the rows of one bucket whose hash is there twice or more."""
    one = np.concatenate([np.frombuffer(r[3], "<u8") for r in rows])
    tag = np.concatenate([np.frombuffer(r[4], "<u2") for r in rows])
    order = np.argsort(one, kind="stable")
    same = one[order][1:] == one[order][:-1]
    if (same & (tag[order][1:] != tag[order][:-1])).any():  # 64 bits agree and 16 others don't
        order = np.lexsort((tag, one))
        same = one[order][1:] == one[order][:-1]
    same &= tag[order][1:] == tag[order][:-1]
    hit = np.zeros(len(one), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    out, at = [], 0
    for r in rows:
        n = len(r[3]) // 8
        own = hit[at : at + n]
        at += n
        if own.any():
            halves = np.frombuffer(r[5], "<u2").astype("<u4")
            out.append((r[0], None, (halves[:n] | halves[n:] << 16)[own].tobytes()))
    return out


def count_windows(hashed: DataFrame) -> DataFrame:
    """chunk, docs, places: the rows that name texts, and the places of windows whose hash occurs in another chunk."""

    def rows(part):
        group: list[tuple] = []
        for batch in part:
            for row in slices(batch, ["chunk", "bucket", "docs", "hashes", "tags", "places"]):
                if group and group[0][1] != row[1]:
                    yield from _repeated_places(group)
                    group = []
                if row[2] is not None:
                    yield row[0], row[2], row[5]
                else:
                    group.append(row)
        if group:
            yield from _repeated_places(group)

    parts = int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = hashed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda part: batches(rows(part), _FOUND, weight=2), "chunk long, docs array<struct<doc_id:long,text_hash:long,at:int,words:int,first:int>>, places binary")


def _spans_of(texts: list[dict], found: list[bytes]):
    """(doc_id, text_hash, first, windows) of the runs of repeated windows in one chunk."""
    hit = np.zeros(texts[-1]["at"] + texts[-1]["words"] + 1, bool)
    for places in found:
        hit[np.frombuffer(places, "<u4")] = True
    for t in texts:
        edge = np.flatnonzero(np.diff(hit[t["at"] : t["at"] + t["words"]], prepend=False, append=False))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            yield t["doc_id"], t["text_hash"], t["first"] + a, b - a


def repeated_words(docs: DataFrame, size: int, chunk: int = CHUNK) -> DataFrame:
    """The windows of ``size`` words whose sequence starts elsewhere too, as KEY, first, windows."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])

    def rows(part):
        number, texts, found = None, None, []
        for batch in part:
            for row in slices(batch, ["chunk", "docs", "places"]):
                if row[0] != number:
                    if texts:
                        yield from _spans_of(texts, found)
                    number, texts, found = row[0], None, []
                texts = row[1] or texts
                found.append(row[2])
        if texts:
            yield from _spans_of(texts, found)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = count_windows(hash_windows(windows.keyed(docs), size, BUCKETS * parts, chunk))
    by_chunk = counted.repartition(parts, "chunk").sortWithinPartitions("chunk")
    return by_chunk.mapInArrow(lambda part: batches(rows(part), schema, step=1 << 13), "doc_id long, text_hash long, first int, windows int")


def remove_repeats(docs: DataFrame, size: int = 35, carry: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Remove every word that is covered by a repeated window of ``size`` words.

    Every window is hashed (Rabin-Karp) and its hash goes to a bucket, where Spark's tasks count it: 64 bits and
    16 more of a second hash, beside those that chose the bucket. A window that occurs often in a chunk of
    ``chunk`` windows is sent once from there, so no hash meets more often than there are chunks. Windows are
    judged on the input, in all rows, and never cross rows.

    Returns doc_id, n_words, n_removed, spans (maximal removed intervals of words) and kept (text, one
    space between words), with the columns named in ``carry``. A null text has no words; a text shorter
    than a window loses nothing; rows that are equal throughout are copies of each other, and all lose
    what they share; null doc_ids are kept; an empty table gives no rows.
    """
    schema = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())])
    ddl = "n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"
    return windows.remove(docs, repeated_words(docs, size, chunk), _cut(size), schema, ddl, carry or [])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], size: int) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) of each text, by comparing all windows; for tests."""
    words = [(t or "").encode().split() for t in texts]
    counts: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - size + 1):
            counts[tuple(w[i : i + size])] = counts.get(tuple(w[i : i + size]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if counts[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p, true AS cut FROM again
), word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT doc_id, count(cut) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY p) FILTER (cut IS NULL), '') AS kept
  FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
