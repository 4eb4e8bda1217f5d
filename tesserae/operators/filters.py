"""Filters over calls. A call that is filtered out loses its row, which stands for variant 0."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def match_chromosome(contigs: DataFrame, pattern: str = r"^(chr)?([0-9]+|X|Y|MT?)$") -> DataFrame:
    return contigs.where(F.col("seqname").rlike(pattern))


def match_genome(calls: DataFrame, pattern: str) -> DataFrame:
    """Samples whose name matches; an empty pattern matches all."""
    return calls.where(F.col("sample").cast("string").rlike(pattern)) if pattern else calls


def max_variants(calls: DataFrame, most: int) -> DataFrame:
    """Drop tags with more than ``most`` different alleles."""
    many = calls.groupBy("tag").agg(F.countDistinct("hash").alias("kinds")).where(F.col("kinds") > most).select("tag")
    return calls.join(many, "tag", "left_anti")


def max_variant_number(calls: DataFrame, most: int) -> DataFrame:
    """Drop tags where any call has a variant number over ``most``."""
    return calls.join(calls.where(F.col("variant") > most).select("tag").distinct(), "tag", "left_anti")


def _covered(calls: DataFrame, least: Column | int | float, counted: Column | None = None) -> DataFrame:
    rows = calls if counted is None else calls.where(counted)
    kept = rows.groupBy("tag").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("tag")
    return calls.join(kept, "tag", "left_semi")


def min_coverage(calls: DataFrame, fraction: float, n_samples: int, mode: str = "library") -> DataFrame:
    """Drop tags with too few calls.

    Three thresholds are in use: ``library`` int(2 * fraction * n + 1) calls; ``command`` int(fraction * n * 2)
    calls, if fraction is over 0; ``matrix`` twice ceil(fraction * n) calls of known sequence, n itself if
    fraction is 1 or more.
    """
    if mode == "library":
        return _covered(calls, int(2 * fraction * n_samples + 1))
    if mode == "command":
        return _covered(calls, int(fraction * n_samples * 2)) if fraction > 0 else calls
    if mode == "matrix":
        least = math.ceil(fraction * n_samples) if fraction < 1 else n_samples
        return _covered(calls, 2 * least, F.col("known"))
    raise ValueError(mode)


def pair_coverage(calls: DataFrame, least: int) -> DataFrame:
    """(tag, n_both) of tags where at least ``least`` samples have both alleles known."""
    both = calls.where("known").groupBy("tag", "sample").agg(F.count("*").alias("alleles")).where("alleles = 2")
    return both.groupBy("tag").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= least)


def max_tag(rows: DataFrame, most: int, inclusive: bool = False) -> DataFrame:
    """Libraries keep tags below ``most``, matrices up to it."""
    return rows.where(F.col("tag") <= most if inclusive else F.col("tag") < most) if most >= 0 else rows


def apply(calls: DataFrame, n_samples: int, variants: int = -1, coverage: float = 0, tag: int = -1, genome: str = "") -> DataFrame:
    """The library filter: variants, then coverage (which counts genomes that go later), tags, genomes."""
    out = max_variants(calls, variants) if variants >= 0 else calls
    out = min_coverage(out, coverage, n_samples) if coverage > 0 else out
    return match_genome(max_tag(out, tag), genome)


def drop_duplicate_tags(hits: DataFrame, keep: bool = False) -> DataFrame:
    """Drop all occurrences of a tag that is found twice or more on a contig."""
    if keep:
        return hits
    n = F.count("*").over(Window.partitionBy("sample", "phase", "seqname", "tag"))
    return hits.withColumn("_n", n).where("_n = 1").drop("_n")


def hide_no_calls(tiles: DataFrame, retain: bool = False) -> DataFrame:
    """Null the sequence of tiles with bases other than a, c, g, t; their hash stays."""
    bad = F.col("seq").rlike("[^acgtACGT]")
    return tiles if retain else tiles.withColumn("seq", F.when(~bad, F.col("seq")))


def spanning_candidates(variants: DataFrame, ref_tiles: DataFrame, tags: DataFrame) -> DataFrame:
    """Variants (tag, seq) that can matter for tiles that aren't excluded.

    ``ref_tiles`` (tag, next_tag, excluded). A variant of an excluded tile stays if it doesn't end with the next
    tag, since it may then run on into a tile that isn't.
    """
    ends = ref_tiles.join(tags.select(F.col("tag").alias("next_tag"), F.col("tagseq").alias("_end")), "next_tag", "left").select("tag", "excluded", "_end")
    both = variants.join(ends, "tag")
    return both.where(~F.col("excluded") | ~F.col("seq").endswith(F.col("_end"))).drop("excluded", "_end")


def size_guard(rows: DataFrame, a: str, b: str, most: int = 50_000, most_apart: int | None = None) -> DataFrame:
    """Rows whose two sequences are short enough, and near enough in length, to be compared."""
    ok = (F.length(a) <= most) & (F.length(b) <= most)
    if most_apart is not None:
        ok = ok & (F.abs(F.length(a) - F.length(b)) <= most_apart)
    return rows.where(ok)


def case_control_only(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("training").isNotNull())
