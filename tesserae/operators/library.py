"""Tile libraries: ranking, tidying, merging, slicing, statistics and dumps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def allele_counts(calls: DataFrame, ref: DataFrame | None = None, counted: Column | None = None) -> DataFrame:
    """(tag, hash, n): known alleles over the rows where ``counted``; alleles of ``ref`` (tag, hash) count 0 at least."""
    rows = calls.where("known")
    if counted is not None:
        rows = rows.where(counted)
    counts = rows.groupBy("tag", "hash").agg(F.count("*").alias("n"))
    if ref is not None:
        zero = ref.select("tag", "hash", F.lit(0).cast("long").alias("n")).distinct()
        counts = counts.unionByName(zero).groupBy("tag", "hash").agg(F.sum("n").alias("n"))
    return counts


def rank_variants(counts: DataFrame) -> DataFrame:
    """Number the alleles of each tag from 1, by falling count, then by rising hash."""
    order = Window.partitionBy("tag").orderBy(F.desc("n"), F.asc("hash"))
    return counts.withColumn("variant", F.row_number().over(order).cast("long"))


def tidy(calls: DataFrame, ref: DataFrame) -> DataFrame:
    """Rank by use, after dropping what neither a call nor the reference uses: (tag, hash, n, in_ref, variant)."""
    uses = calls.groupBy("tag", "hash").agg(F.count("*").alias("n"), F.lit(0).alias("r"))
    marks = ref.select("tag", "hash", F.lit(0).cast("long").alias("n"), F.lit(1).alias("r")).distinct()
    rows = uses.unionByName(marks).groupBy("tag", "hash").agg(F.sum("n").alias("n"), (F.max("r") == 1).alias("in_ref"))
    return rank_variants(rows.where((F.col("n") > 0) | F.col("in_ref")))


def intern(tiles: DataFrame) -> DataFrame:
    """Distinct (tag, hash) with the known sequence if any row has it."""
    return tiles.groupBy("tag", "hash").agg(F.max("seq").alias("seq"), F.max("is_ref").alias("is_ref"))


def merge_libraries(*variants: DataFrame) -> DataFrame:
    """Union of libraries' tile variants, one row for each (tag, hash); a known sequence wins over an unknown one."""
    return intern(reduce(DataFrame.unionByName, variants))


def missing_variants(calls: DataFrame, variants: DataFrame) -> DataFrame:
    """Calls whose (tag, hash) the library lacks; empty for a library that is whole."""
    return calls.join(variants.select("tag", "hash"), ["tag", "hash"], "left_anti")


def renumber(calls: DataFrame, ranked: DataFrame) -> DataFrame:
    """Calls with the variant number of their (tag, hash); 0 for a hash without one."""
    return calls.join(ranked.select("tag", "hash", "variant"), ["tag", "hash"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))


def renumber_path(path: DataFrame, ranked: DataFrame) -> DataFrame:
    """A reference path (seqname, step, tag, hash) with variant numbers; a null hash is variant 0."""
    return path.join(ranked.select("tag", "hash", "variant"), ["tag", "hash"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))


def same_tags(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tag sets are equal, rows counted."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def tag_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either tag set that the other lacks, with the side they are on."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def slices(rows: DataFrame, tags_per_file: int = 50_000) -> DataFrame:
    """Rows with the number of their slice, a range of tags."""
    return rows.withColumn("chunk", F.floor(F.col("tag") / tags_per_file).cast("long"))


def slice_offsets(rows: DataFrame, tags_per_file: int = 50_000) -> DataFrame:
    """First tag and number of rows of each slice."""
    return slices(rows, tags_per_file).groupBy("chunk").agg(F.min("tag").alias("start_tag"), F.count("*").alias("n"))


def union_namespaced(parts: Sequence[DataFrame]) -> DataFrame:
    """Union without dedup; ``variant`` of input k of n becomes variant * n + k, 0 stays 0."""
    n = len(parts)
    return reduce(DataFrame.unionByName, [p.withColumn("ns", F.lit(k)).withColumn("variant", F.when(F.col("variant") > 0, F.col("variant") * n + k).otherwise(0)) for k, p in enumerate(parts)])


def totals(calls: DataFrame, variants: DataFrame) -> DataFrame:
    """One row: genomes, tags and tile variants of a library."""
    return calls.agg(F.countDistinct("sample").alias("genomes")).join(variants.agg(F.countDistinct("tag").alias("tags"), F.count("*").alias("tile_variants")))


def called_bases(calls: DataFrame, variants: DataFrame) -> DataFrame:
    """Bases in the known tiles of each sample; variants have ``bases``."""
    both = calls.join(variants.select("tag", "hash", "bases"), ["tag", "hash"], "left")
    return both.groupBy("sample").agg(F.sum(F.coalesce("bases", F.lit(0))).cast("long").alias("called_bases"))


def placement_histogram(path: DataFrame) -> DataFrame:
    """How many tags are placed so many times on a reference path."""
    return path.groupBy("tag").agg(F.count("*").alias("times")).groupBy("times").agg(F.count("*").alias("tags"))


def size_histogram(variants: DataFrame) -> DataFrame:
    """Tile variants by length and by whether their bases are known; variants have ``len`` and ``known``."""
    return variants.groupBy("len", "known").agg(F.count("*").alias("n"))


def describe(**entities: DataFrame) -> DataFrame:
    """Rows of each part of a library: (entity, n)."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("entity"), "n") for name, df in entities.items()]
    return reduce(DataFrame.unionByName, counts)


def dump_variants(ranked: DataFrame, ref_tiles: DataFrame, tags: Sequence[int] | None = None) -> DataFrame:
    """Ranked variants with the place of their tag on the reference: tag, variant, is_ref, seqname, pos (from 1), seq."""
    rows = ranked if tags is None else ranked.where(F.col("tag").isin(list(tags)))
    place = ref_tiles.select("tag", "seqname", "pos", F.col("hash").alias("ref_hash"))
    both = rows.join(place, "tag")
    seq = F.upper("seq").alias("seq") if "seq" in ranked.columns else F.upper("hash").alias("seq")
    return both.select("tag", "variant", (F.col("hash") == F.col("ref_hash")).alias("is_ref"), "seqname", (F.col("pos") + 1).alias("pos"), seq)


def common_variants(calls: DataFrame, low: float, high: float, n_samples: int, variants: Sequence[int] = (1, 2, 3, 4), limit: int | None = None) -> DataFrame:
    """(tag, variant, n, example) of variants called between ``low`` and ``high`` of all 2n times; an example carrier.

    With ``limit``, tags are taken in order while the variants before them are fewer, so the last tag can
    exceed it.
    """
    counts = calls.where(F.col("variant").isin(list(variants))).groupBy("tag", "variant").agg(F.count("*").alias("n"), F.max("sample").alias("example"))
    kept = counts.where(F.col("n").between(low * 2 * n_samples, high * 2 * n_samples))
    if limit is not None:
        per_tag = kept.groupBy("tag").agg(F.count("*").alias("m"))
        before = F.coalesce(F.sum("m").over(Window.orderBy("tag").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each tag
        kept = kept.join(per_tag.withColumn("before", before).where(F.col("before") < limit).select("tag"), "tag", "left_semi")
    return kept


def with_annotations(variants: DataFrame, annotations: DataFrame) -> DataFrame:
    """Variants joined to their annotation rows on (tag, variant)."""
    return variants.join(annotations, ["tag", "variant"])
