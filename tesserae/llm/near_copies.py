"""Near copies by Jaccard similarity: SimHash prints propose pairs, MinHash bands those that prints can't tell, and the whole
sets of shingles decide all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm import simhash
from tesserae.llm.common import batches, broadcast_if_small, keep, materialize, slices
from tesserae.llm.components import components
from tesserae.llm.simhash import BROADCAST_ROWS, keep_least, named, print_of, shingle_hashes

#: Texts are linked if so many percent of the different shingles of both are in both.
SHINGLE, PERCENT = 5, 80
#: Prints so many bits apart propose a pair; five take the same three segments as four.
PRINT_BITS = 5
#: Of BANDS bands of ROWS least hashes each, two texts share one with probability 1 - (1 - J^ROWS)^BANDS: all but 7 in a
#: million at J = 0.8, fewer missed above.
BANDS, ROWS = 30, 5

_MIX = np.array([xxhash.xxh64_intdigest(b"%d" % k) for k in range(2 * BANDS * ROWS)], np.uint64).astype(np.uint32).reshape(2, -1)
_MIX[1] |= 1


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def bands(hashes: np.ndarray) -> list[int]:
    """Signed 64-bit keys, one a band, of a text's distinct shingle hashes."""
    least, short = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        np.minimum(least, ((short[at : at + 512, None] ^ _MIX[0]) * _MIX[1]).min(axis=0), out=least)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64).tolist()


def _node(words: list[bytes]) -> int:
    return np.uint64(xxhash.xxh64_intdigest(b" ".join(words), 42)).astype(np.int64).item() if words else 0


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp (hash of the words), print (SimHash of the shingles, repeats included) and the keys of the bands
    of every row; print 0 and no keys for a text without words."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64()), ("print", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def rows(part: Iterator[pa.RecordBatch]):
        keep()
        for batch in part:
            for doc, key, text in slices(batch, ["doc_id", "text_hash", "text"]):
                words = _words(text)
                hashes = shingle_hashes(words, SHINGLE)
                yield doc, key, _node(words), print_of(hashes) if words else 0, bands(np.unique(hashes)) if words else []

    return _keyed(docs).mapInArrow(lambda part: batches(rows(part), schema, step=1 << 12), "doc_id long, text_hash long, fp long, print long, keys array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """fp and the distinct shingle hashes of every row, each fp once."""
    schema = pa.schema([("fp", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def rows(part: Iterator[pa.RecordBatch]):
        for batch in part:
            for (text,) in slices(batch, ["text"], step=64):
                words = _words(text)
                yield _node(words), np.unique(shingle_hashes(words, SHINGLE)).view(np.int64)

    return docs.mapInArrow(lambda part: batches(rows(part), schema, step=64), "fp long, shingles array<long>").dropDuplicates(["fp"])


def similar(a: str, b: str) -> Column:
    """Whether the sets of shingles in two columns are similar enough."""
    m, n = F.size(a), F.size(b)
    return (F.least(m, n) * 100 >= F.greatest(m, n) * PERCENT) & (F.size(F.array_intersect(a, b)) * (100 + PERCENT) >= (m + n) * PERCENT)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets of shingles are similar enough."""
    a = sets.select(F.col("fp").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("fp").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(b, "v").join(a, "u").where(similar("a", "b")).select("u", "v")


def alike(nodes: DataFrame) -> DataFrame:
    """(u, v) of each text v (fp) and the least text u of the component that SimHash makes of their prints, which is op5's
    operator; links between other texts of a component are left to the bands, so there are no more pairs than texts."""
    roots = simhash.connected(nodes.select(F.col("print").alias("fp")).distinct(), PRINT_BITS)
    grouped = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select("fp", F.coalesce("root", "print").alias("root"))
    least = grouped.groupBy("root").agg(F.min("fp").alias("u"), F.max("fp").alias("last")).where("u < last").select("root", "u")
    return grouped.join(least, "root").where("u <> fp").select("u", F.col("fp").alias("v"))


def connected(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of the texts (fp) that link to another.

    Texts with prints alike, and in each band key the text with the most company and all others, are tried
    first, which takes no pairs of the others; a large group of near copies is mostly one component then. After
    that every pair that shares a key and is not yet in one component is tried, and what doesn't verify never leaves the join.
    """
    nodes = rows.select("fp", "print", "keys").dropDuplicates(["fp"])
    prints_alike = materialize(alike(nodes.select("fp", "print")), "alike")
    same = Window.partitionBy("key")
    index = nodes.select("fp", F.explode("keys").alias("key")).withColumn("n", F.count("*").over(same)).where("n > 1")
    index = materialize(index, "index")
    met = materialize(index.groupBy("fp").agg(F.sum("n").alias("company")), "met")
    # one row of each text that met another
    company = met.select("fp").unionByName(prints_alike.select(F.explode(F.array("u", "v")).alias("fp")))
    # copies are made one before they are shuffled for the join; a semi-join would be pushed below that
    chosen = rows.groupBy("fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).join(company.distinct(), "fp")
    chosen = materialize(chosen.select(F.col("k.doc_id").alias("_doc"), F.col("k.text_hash").alias("_hash")), "chosen")
    side = broadcast_if_small(chosen, BROADCAST_ROWS)
    keyed = _keyed(docs)
    sets = materialize(shingle_sets(keyed.join(side, keyed["doc_id"].eqNullSafe(side["_doc"]) & (keyed["text_hash"] == side["_hash"]), "left_semi").select("text")), "sets")

    centres = index.join(met, "fp").groupBy("key").agg(F.max(F.struct("company", "fp")).alias("c")).select("key", F.col("c.fp").alias("u"))
    stars = index.join(centres, "key").where("u <> fp").select("u", F.col("fp").alias("v"))
    first = materialize(verified(stars.unionByName(prints_alike).distinct(), sets), "first")
    roots = materialize(components(first), "roots")
    grouped = index.select("key", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("group"))
    grouped = grouped.withColumn("low", F.min("group").over(same)).withColumn("high", F.max("group").over(same)).where("low < high").drop("low", "high")
    grouped = materialize(grouped.join(sets, "fp"), "groups")
    a, b = grouped.alias("a"), grouped.alias("b")
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (F.col("a.group") != F.col("b.group"))
    near = near & similar("a.shingles", "b.shingles")
    second = a.join(b.hint("merge"), near).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct()
    second = materialize(second, "second")
    return components(first.unionByName(second))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp and component_id of every row.

    Rows whose words are equal but for case are one node; nodes link at a Jaccard similarity of PERCENT or more of their
    sets of SHINGLE words, and component_id is the least doc_id in the component (null if all are null). Texts
    without words are one node; a text of fewer words is one shingle; other columns are not read.
    """
    rows = materialize(prints(docs), "prints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    roots = materialize(connected(rows, docs), "components")
    return named(rows.drop("keys", "print"), nodes, roots)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, as ``simhash.keep_least`` chooses it."""
    return keep_least(docs, near_duplicates(docs))
