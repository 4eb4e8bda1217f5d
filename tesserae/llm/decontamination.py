"""Finding benchmark items in documents by a prefix-filtered set join, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import broadcast_if_small, materialize, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of benchmark windows or shingles that may be broadcast.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of all ``size``-word shingles, in order; none if there are fewer words."""

    def one(i):
        return F.xxhash64(F.lit(size), *(F.get(words, i + k) for k in range(size)))

    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), one)).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, text of the window (words joined by a space), n (its words), for every window of every item."""
    split = items.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    starts = split.select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    return starts.select("item_id", F.array_join(F.slice("w", F.col("at"), F.col("n")), " ").alias("window"), "n").distinct()


def contaminated(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """Which windows of ``items`` (item_id, text) occur in which row of ``docs`` (doc_id, text).

    A window is ``window`` consecutive words of an item, or all of a shorter one. It is a set of
    ``shingle``-word shingles; a text holds the window only if it holds them all, so its rarest shingle (by
    occurrences in ``docs``) is prefix enough. Documents' shingles are joined with the benchmark's; where a
    window's rarest is found, the window's start and length must fit in the text, and its words are compared.

    Returns one row for each distinct (doc_id, text_hash) with a window: hits (array of struct(start, n,
    window), words from 0) and items (the sorted texts of their item_ids). Null and empty texts and items
    have no words and match nothing; items with equal text are all named; equal rows are one here.
    """
    every = materialize(item_windows(items, window), "windows")
    kinds = every.select("window", "n").distinct()
    parts = kinds.select("window", "n", F.least("n", F.lit(shingle)).alias("size"), F.split("window", " ").alias("w"))
    sizes = sorted(r[0] for r in parts.select("size").distinct().collect())
    empty = F.array().cast("array<bigint>")
    own = empty
    for size in sizes:  # no more than ``shingle`` of them
        own = F.when(F.col("size") == size, _shingles(F.col("w"), size)).otherwise(own)
    tokens = materialize(parts.select("window", "n", F.posexplode(own).alias("offset", "h")), "tokens")

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    rows = named.select("doc_id", "text_hash", words_of(F.col("text")).alias("w"))
    wanted = broadcast_if_small(tokens.select("h").distinct(), BROADCAST_ROWS)
    found = None
    for size in sizes:
        spread = rows.select("doc_id", "text_hash", F.size("w").alias("n_words"), F.posexplode(_shingles(F.col("w"), size)).alias("pos", "h"))
        part = spread.join(wanted, "h", "left_semi")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.select("doc_id", "text_hash", F.size("w").alias("n_words"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h")).where(F.lit(False))
    found = materialize(found.distinct(), "shingles")

    seen = found.groupBy("h").agg(F.count("*").alias("seen"))
    rarity = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "h")
    prefix = tokens.join(broadcast_if_small(seen, BROADCAST_ROWS), "h", "left").groupBy("window", "n").agg(F.min(rarity).alias("p"))
    prefix = prefix.where("p.seen > 0").select("window", "n", "p.offset", "p.h")
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    starts = found.join(broadcast_if_small(prefix, BROADCAST_ROWS), "h").where(fits).select("doc_id", "text_hash", F.struct(start.alias("start"), "n", "window").alias("c"))
    starts = materialize(starts.groupBy("doc_id", "text_hash").agg(F.collect_set("c").alias("c")), "candidates")

    size = F.aggregate("c", F.lit(0), lambda n, c: n + 40 + F.length(c["window"]))
    side = broadcast_if_small(starts.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"}), 50_000, size)
    both = named.join(side, named["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")))
    both = both.select("doc_id", "text_hash", words_of(F.col("text")).alias("w"), "c").dropDuplicates(["doc_id", "text_hash"])
    same = F.filter("c", lambda c: F.array_join(F.slice(F.col("w"), c["start"] + 1, c["n"]), " ") == c["window"])
    hits = materialize(both.select("doc_id", "text_hash", same.alias("hits")).where(F.size("hits") > 0), "hits")
    names = broadcast_if_small(every.select("window", F.col("item_id").cast("string").alias("item")), BROADCAST_ROWS, F.length("window"))
    items_of = hits.select("doc_id", "text_hash", F.explode(F.array_distinct(F.transform("hits", lambda c: c["window"]))).alias("window")).join(names, "window")
    items_of = items_of.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    return hits.join(items_of, hits["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))).drop("_doc", "_hash")


def report(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit (words in an occurrence of a window), items and contaminated of every row."""
    found = materialize(contaminated(docs, items, window, shingle), "found").withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    places = F.flatten(F.transform("hits", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    found = found.select("_doc", "_hash", F.size(F.array_distinct(places)).cast("long").alias("n_hit"), "items")
    both = named.join(broadcast_if_small(found, 50_000, F.length(F.array_join("items", " "))), named["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return both.select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), items_.alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` without any window of ``items``, with their columns."""
    found = materialize(contaminated(docs, items, window, shingle).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")), "found")
    here = docs["doc_id"].cast("long").eqNullSafe(found["_doc"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_hash"])
    return docs.join(broadcast_if_small(found, 500_000), here, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item AS (
  SELECT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM (
    SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0))
), spot AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM item) WHERE len(w) >= n)
), hit AS (SELECT doc_id, i, spot.n, item_id FROM spot JOIN item ON spot.k = item.k AND spot.n = item.n
), covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
