"""Near duplicates by SimHash fingerprints and deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import batches, broadcast_if_small, fresh, materialize, slices, table
from tesserae.llm.components import components

BITS = 64
#: Rows that may be broadcast to select the documents that stay.
BROADCAST_ROWS = 500_000


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """64-bit hashes of all runs of ``shingle`` words in order; of all words together if there are fewer."""
    hash_of = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([hash_of(joined, 42)], "<u8")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - shingle].tolist()]
    return np.array([hash_of(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())], "<u8")


def print_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash: the bits that over half of ``hashes``, repeats included, have set."""
    set_in = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        set_in += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * set_in > len(hashes), bitorder="little").view("<i8").item()


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of the text's word shingles, each counted as often as it occurs."""
    words = (text or "").encode().lower().split()
    return print_of(shingle_hashes(words, shingle)) if words else 0


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, fp of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def rows(part: Iterator[pa.RecordBatch]):
        for batch in part:
            for doc, key, text in slices(batch, ["doc_id", "text_hash", "text"]):
                yield doc, key, fingerprint(text, shingle)

    def run(part):
        return batches(rows(part), schema, step=1 << 13)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_hash long, fp long")


def cuts(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of segments, so few that one of them differs by one bit at most."""
    n = max(2, distance // 2 + 1)  # two at least, so that a segment and its place fit one key
    edges = [BITS * k // n for k in range(n + 1)]
    return list(zip(edges, (b - a for a, b in zip(edges, edges[1:]))))


def _once(differing: Column, left_out: Column, distance: int) -> Column:
    """Whether this is the one key by which a pair is told: of the first segment that differs by a bit at most,
    the bit that differs, or the segment's first bit if none does."""
    out, earlier = F.lit(False), F.lit(True)
    for first, width in cuts(distance):
        bits = F.bit_count(F.shiftrightunsigned(differing, first).bitwiseAND(F.lit((1 << width) - 1)))
        out = out | (left_out.between(first, first + width - 1) & earlier & ((bits == 1) | (left_out == first)))
        earlier = earlier & (bits > 1)
    return out


def neighbours(prints: DataFrame) -> DataFrame:
    """(u, v), u < v, of the prints that differ in one bit: with that bit cleared they are the same key, which no
    third print has."""
    one = F.lit(1).cast("long")
    cleared = [F.struct(F.lit(bit).alias("bit"), F.col("fp").bitwiseAND(F.bitwise_not(F.shiftleft(one, bit))).alias("rest")) for bit in range(BITS)]
    pairs = prints.select("fp", F.explode(F.array(*cleared)).alias("k")).groupBy("k.bit", "k.rest").agg(F.min("fp").alias("u"), F.max("fp").alias("v"))
    return pairs.where("u < v").select("u", "v")


def links(prints: DataFrame, distance: int) -> DataFrame:
    """(u, v), u < v, of the distinct fingerprints in ``prints`` (fp, and group) that differ in 1 to ``distance`` bits
    and are of different groups, each pair once.

    Of ``distance`` // 2 + 1 segments one differs by a bit at most, so it is equal once that bit is left
    out. Each fingerprint is indexed under every segment with each of its bits left out in turn; keys that
    only one group has are dropped, the index is joined with itself, and what doesn't verify never leaves
    the join.
    """
    variants = []
    for first, width in cuts(distance):
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            # 64 // 2 bits at most, then 6 for the place left out
            variants.append(F.shiftleft(segment.bitwiseAND(F.lit(~(1 << bit) & ((1 << width) - 1))), 6).bitwiseOR(F.lit(first + bit)))
    keys = prints.select("fp", "group", F.explode(F.array(*variants)).alias("key"))
    same = Window.partitionBy("key")
    keys = keys.withColumn("low", F.min("group").over(same)).withColumn("high", F.max("group").over(same)).where("low < high").drop("low", "high")
    # Spark's estimate of the index leaves out that each print has 64 rows in it, so it could choose to broadcast it
    a, b = keys.alias("a"), keys.alias("b")
    differing = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (F.col("a.group") != F.col("b.group"))
    near = near & (F.bit_count(differing) <= distance) & _once(differing, F.col("a.key").bitwiseAND(F.lit(63)), distance)
    return a.join(b.hint("merge"), near).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def connected(prints: DataFrame, distance: int) -> DataFrame:
    """(node, root) of the distinct prints (fp) that link to another at ``distance`` or fewer bits.

    Prints one bit apart are joined first, which takes no pairs; a large group of near copies is mostly one
    component then. Links are looked for between components only.
    """
    first = materialize(components(neighbours(prints)), "neighbours")
    grouped = prints.join(first.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"))
    grouped = materialize(grouped, "groups")
    found = materialize(links(grouped, distance), "links")
    group = grouped.select(F.col("fp").alias("u"), F.col("group").alias("gu"))
    between = found.join(group, "u").join(group.withColumnsRenamed({"u": "v", "gu": "gv"}), "v")
    second = materialize(components(between.select(F.col("gu").alias("u"), F.col("gv").alias("v")).distinct()), "roots")
    both = grouped.join(second.withColumnRenamed("node", "group"), "group", "left")
    # a print without a link has no row: neither its group nor any other print of it was joined to another
    linked = first.select(F.col("node").alias("fp"), F.lit(True).alias("one"))
    both = both.join(linked, "fp", "left").where(F.col("root").isNotNull() | F.col("one"))
    return both.select(F.col("fp").alias("node"), F.coalesce("root", "group").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, heavy: int = 256) -> DataFrame:
    """doc_id, text_hash, fp and component_id of every row.

    Rows with equal fingerprints are one node; nodes link at ``distance`` or fewer differing bits, and
    component_id is the least doc_id in the component (null if all are null). A null or empty text, or one
    without words, has fingerprint 0, linked like any other; equal rows belong together; an empty table
    gives no rows; other columns are not read.
    """
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    roots = materialize(connected(nodes.select("fp"), distance), "components")
    return named(prints, nodes, roots, heavy)


def named(prints: DataFrame, nodes: DataFrame, roots: DataFrame, heavy: int = 256) -> DataFrame:
    """doc_id, text_hash, fp and component_id of every row in ``prints``; ``nodes`` (fp, least, n) has each fp once,
    ``roots`` (node, root) the linked ones."""
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(ids, "root").select("fp", "component_id", "n")
    # fingerprints of one row without links need no lookup
    alone = nodes.where("n > 1").join(roots.select(F.col("node").alias("fp")), "fp", "left_anti").select("fp", F.col("least").alias("component_id"), "n")
    known = materialize(linked.unionByName(alone), "known")
    # the most frequent fingerprints, ``heavy`` of them, are looked up by broadcast, so they meet in no task
    top = F.broadcast(known.orderBy(F.desc("n"), "fp").limit(heavy).select("fp", "component_id", F.lit(True).alias("found")))
    by_top = prints.join(top, "fp", "left")
    rest = by_top.where("found is null").drop("component_id", "found").join(known.select("fp", "component_id", F.lit(True).alias("found")), "fp", "left")
    own = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    return by_top.where("found").unionByName(rest).select("doc_id", "text_hash", "fp", own.alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component of ``near_duplicates``, as ``keep_least`` chooses it."""
    return keep_least(docs, near_duplicates(docs, shingle, distance))


def keep_least(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each component in ``groups``: that with the least doc_id (nulls last), then the least hash of its text.

    Equal rows are one. All columns are kept.
    """
    # rows of a component without any doc_id can't be told apart by it: the fingerprint stands in
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")
    rows = groups.groupBy(group.alias("g"), "doc_id", "text_hash").agg(F.count("*").alias("n"))
    kept = rows.groupBy("g").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("_doc"), F.col("k.text_hash").alias("_hash"), F.col("k.n").alias("_n"))
    kept = materialize(kept, "kept")
    key = fresh(docs, "_key")
    marked = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))

    def of(side):
        side = broadcast_if_small(side, BROADCAST_ROWS)
        return marked.join(side, marked["doc_id"].cast("long").eqNullSafe(side["_doc"]) & (marked[key] == side["_hash"]), "left_semi")

    out = of(kept.where("_n = 1"))
    equal = kept.where("_n > 1")
    if not equal.isEmpty():  # only rows that are equal to another need to be shuffled, text and all, to be made one
        out = out.unionByName(of(equal).dropDuplicates(["doc_id", key]))
    return out.drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
