"""Quality rules: simple counts, and a likelihood ratio of hashed n-grams."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import SPACE, broadcast_if_small, carried, keep, map_rows, named, slices, table

#: Buckets for single words, and as many for pairs.
BUCKETS = 1 << 16
#: Added to the trusted count of every bucket, and to the count it would have if trusted text were like the rest.
SMOOTHING = 3
#: Weights are whole millionths, so sums don't depend on the order of rows.
UNIT = 1_000_000
#: Least mean log-likelihood ratio of a document that is kept, in millionths.
THRESHOLD = -250_000
SYMBOLS = "#*$%&|<>"
#: Words whose codes each Python worker keeps.
CACHE_WORDS = 150_000
_CODES: dict[bytes, int] = {}


def _code(word: bytes) -> int:
    code = _CODES.get(word)
    if code is None:
        code = int.from_bytes(hashlib.md5(word).digest()[:4], "big")
        if len(_CODES) < CACHE_WORDS:
            _CODES[word] = code
    return code


def _words(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words, in order, and the code of each number."""
    keep(_CODES)
    own: dict[bytes, int] = {}
    order = np.array([own.setdefault(w, len(own)) for w in (text or "").encode().split()], np.int64)
    return order, np.array([_code(w) for w in own], np.int64)


def grams(order: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Buckets of all words, then of all pairs of neighbours."""
    if not len(order):
        return order
    code = codes[order]
    return np.concatenate([code % BUCKETS, BUCKETS + (31 * code[:-1] + code[1:]) % BUCKETS])


def gram_counts(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """(2 * BUCKETS, 2): how often each bucket occurs in all rows, and in rows whose doc_id is in ``target``."""
    trusted = target.select(F.col("doc_id").alias("_id")).distinct().withColumn("trusted", F.lit(True))
    marked = docs.select("doc_id", "text").join(broadcast_if_small(trusted, 1_000_000), F.col("doc_id") == F.col("_id"), "left").select("text", "trusted")
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("n_trusted", pa.int64())])

    def run(part: Iterator[pa.RecordBatch]):
        total = np.zeros((2, 2 * BUCKETS), np.int64)
        for batch in part:
            for text, good in slices(batch, ["text", "trusted"]):
                found = grams(*_words(text))
                np.add.at(total[0], found, 1)
                if good:
                    np.add.at(total[1], found, 1)
        there = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[0][there]), pa.array(total[1][there])], schema=schema)

    sums = marked.mapInArrow(run, "bucket int, n long, n_trusted long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted"))
    counts = np.zeros((2 * BUCKETS, 2), np.int64)
    for row in sums.collect():  # a row for each bucket at most
        counts[row.bucket] = row.n, row.n_trusted
    return counts


def weights(counts: np.ndarray) -> np.ndarray:
    """Log of the trusted multinomial over the raw one, in millionths; zeros where nothing is trusted.

    The raw counts are scaled to the trusted text's size before both are smoothed, so a bucket that is too
    rare to tell weighs next to nothing, whichever text its words are from.
    """
    raw, trusted = counts.sum(axis=0).astype(float)
    if not trusted:
        return np.zeros(len(counts), np.int64)
    expected = counts[:, 0].astype(float) * trusted / raw
    return np.round(UNIT * (np.log(counts[:, 1] + SMOOTHING) - np.log(expected + SMOOTHING))).astype(np.int64)


def measures(text: str | None, weight: np.ndarray) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio (sum of weights), n_grams."""
    text = text or ""
    order, codes = _words(text)
    n = len(order)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated = 0
    if n > 3:
        v = len(codes)
        pair = order[:-2] * v + order[1:-1]
        if v >= 1 << 21:  # three numbers don't fit in 64 bits
            pair = np.unique(pair, return_inverse=True)[1]
        _, same, count = np.unique(pair * v + order[2:], return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[same] > 1)
        hit = np.zeros(n, bool)
        for k in range(3):
            hit[again + k] = True
        repeated = int(hit.sum())
    found = grams(order, codes)
    chars = len(text) - sum(text.count(c) for c in SPACE)
    return n, chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated, int(weight[found].sum()), len(found)


def assess(docs: DataFrame, target: DataFrame, threshold: int = THRESHOLD, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Measure every row of ``docs`` (doc_id, text) and decide whether it is kept.

    ``target`` names the trusted documents (doc_id). Words and pairs of neighbours are hashed to buckets; the
    mean over a text of log(trusted / raw) decides at ``threshold`` millionths. Base rules reject first:
    fewer than 50 words, or over half of them in 3-word windows that occur twice or more in the text.

    Returns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio and n_grams (long), base_failed
    and kept, beside the columns in ``carry`` (with _carry_ before a name of these). A null or empty text has no words and fails; rows that are equal
    get equal results; null doc_ids are never trusted; with no trusted row at hand all ratios are 0; an empty
    table gives no rows.
    """
    weight = docs.sparkSession.sparkContext.broadcast(weights(gram_counts(docs, target)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "n_grams"]
    schema = pa.schema([(n, pa.int64()) for n in names])
    out = map_rows(docs, lambda text: measures(text, weight.value), ["text"], schema, ", ".join(f"{n} long" for n in names), carry)
    out = out.toDF(*names, *carried(carry, [*names, "base_failed", "kept"]))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold * F.col("n_grams")))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = assess(table(spark, sf_dir, "documents"), trusted(spark, sf_dir))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "base_failed", "kept")


def kept_docs(docs: DataFrame, target: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, whatever the names of those; see ``assess``."""
    held = [c if c in ("doc_id", "text") else f"other_{k}" for k, c in enumerate(docs.columns)]
    safe = docs.select(*(named(c).alias(n) for c, n in zip(docs.columns, held)))
    return assess(safe, target, threshold, held).where("kept").select(*held).toDF(*docs.columns)


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (SELECT count(*) - count(DISTINCT l) FROM (SELECT unnest(string_split(text, chr(10))) AS l) WHERE regexp_matches(l, '[^\x20\x09-\x0D]'))::BIGINT AS n_dup_lines, w
  FROM words
), spot AS (SELECT doc_id, w, n_words, unnest(range(1, n_words + 1)) AS i FROM base
), tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM spot WHERE i + 2 <= n_words
), again AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1
), hit AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), code AS (SELECT doc_id, i, n_words, ('0x' || substr(md5(w[i]), 1, 8))::BIGINT AS c, lead(('0x' || substr(md5(w[i]), 1, 8))::BIGINT) OVER (PARTITION BY doc_id ORDER BY i) AS d FROM spot
), gram AS (
  SELECT doc_id, c % 65536 AS bucket FROM code UNION ALL SELECT doc_id, 65536 + (31 * c + d) % 65536 FROM code WHERE i < n_words
), counts AS (
  SELECT b.bucket, coalesce(n, 0) AS n, coalesce(t, 0) AS t FROM (SELECT unnest(range(131072)) AS bucket) b LEFT JOIN (
    SELECT bucket, count(*) AS n, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS t FROM gram GROUP BY bucket) g USING (bucket)
), weight AS (
  SELECT bucket, round(1000000 * (ln(t + 3) - ln(n::DOUBLE * sum(t) OVER () / sum(n) OVER () + 3)))::BIGINT AS v FROM counts
), score AS (SELECT doc_id, sum(v)::BIGINT AS ratio, count(*) AS n_grams FROM gram JOIN weight USING (bucket) GROUP BY doc_id
), done AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(ratio, 0) AS ratio, coalesce(n_grams, 0) AS n_grams,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM base LEFT JOIN hit USING (doc_id) LEFT JOIN score USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio, base_failed, NOT base_failed AND ratio >= -250000 * n_grams AS kept FROM done
"""
