"""The reference genome's tiles and their places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators.tiling import kmers

TAG_LENGTH = 24


def place_tiles(path: DataFrame, tag_length: int = TAG_LENGTH) -> DataFrame:
    """A path (seqname, step, tag, len) with ``pos``: neighbours overlap by a tag."""
    before = Window.partitionBy("seqname").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    return path.withColumn("pos", F.coalesce(F.sum(F.col("len") - tag_length).over(before), F.lit(0)).cast("long"))


def unique_tiles(placed: DataFrame) -> DataFrame:
    """Tiles whose tag is placed once on the whole reference."""
    many = placed.groupBy("tag").agg(F.count("*").alias("n")).where("n > 1").select("tag")
    return placed.join(many, "tag", "left_anti")


def without_inner_tags(placed: DataFrame, tags: DataFrame, tag_length: int = TAG_LENGTH) -> DataFrame:
    """Drop tiles whose tag also occurs inside another reference tile (seq), past its first base.

    Every k-mer of the tiles is one row of an equi-join with the tags; no pairs are tried.
    """
    grams = kmers(placed.select(F.col("tag").alias("host"), F.length("seq").alias("n"), "seq"), tag_length)
    # the last k-mer of a tile is the next tile's tag; its own stands first, or further on in a chromosome's first tile
    inner = grams.where((F.col("pos") > 0) & (F.col("pos") < F.col("n") - tag_length)).select("host", F.col("kmer").alias("tagseq"))
    hit = inner.join(tags, "tagseq").where(F.col("host") != F.col("tag")).select("tag").distinct()
    return placed.join(hit, "tag", "left_anti")


def successors(placed: DataFrame) -> DataFrame:
    """``next_tag``, the next kept tile on the chromosome; -1 after the last."""
    order = Window.partitionBy("seqname").orderBy("pos", "tag")
    return placed.withColumn("next_tag", F.coalesce(F.lead("tag").over(order), F.lit(-1)))


def tile_bounds(hits: DataFrame, length: Column, tag_length: int = TAG_LENGTH, key: tuple[str, ...] = ("seqname",)) -> DataFrame:
    """Bounds of the tiles between tag hits (pos): from the hit (the first from 0) to the end of the next tag (the last to the end)."""
    order = Window.partitionBy(*key).orderBy("pos")
    start = F.when(F.row_number().over(order) == 1, 0).otherwise(F.col("pos"))
    end = F.coalesce(F.lead("pos").over(order) + tag_length, length)
    return hits.withColumn("start", start.cast("long")).withColumn("end", end.cast("long"))


def reference_sequence(placed: DataFrame, tag_length: int = TAG_LENGTH) -> DataFrame:
    """Whole sequence of each chromosome: tiles (step, seq) in order, overlaps trimmed."""
    ordered = F.array_sort(F.collect_list(F.struct("step", "seq")))
    rows = placed.groupBy("seqname").agg(ordered.alias("tiles"))
    parts = F.transform("tiles", lambda t, i: F.when(i == 0, t["seq"]).otherwise(F.substring(t["seq"], tag_length + 1, 2_000_000_000)))
    return rows.select("seqname", F.array_join(parts, "").alias("seq"))


def reference_lengths(lines: DataFrame) -> DataFrame:
    """Length of each label from FASTA lines (label, line)."""
    return lines.groupBy("label").agg(F.sum(F.length(F.trim("line"))).cast("long").alias("length"))


def _bed(placed: DataFrame, score: Column, tag_length: int) -> DataFrame:
    end = F.col("pos") + F.col("len")
    last = F.lead("pos").over(Window.partitionBy("seqname").orderBy("pos")).isNull()
    first = F.lag("pos").over(Window.partitionBy("seqname").orderBy("pos")).isNull()
    thick_start = F.when(first, F.col("pos")).otherwise(F.col("pos") + tag_length)
    thick_end = F.when(last, end).otherwise(end - tag_length)
    return placed.select("seqname", F.col("pos").alias("start"), end.alias("end"), "tag", score.cast("long").alias("score"), thick_start.alias("thick_start"), thick_end.alias("thick_end"))


def tiling_bed(placed: DataFrame, tag_length: int = TAG_LENGTH) -> DataFrame:
    """BED rows of tiles; the score is a thousand times the share of called bases, whole."""
    return _bed(placed, F.floor(1000 * F.col("bases") / F.col("len")), tag_length)


def coverage_bed(placed: DataFrame, calls: DataFrame, n_samples: int, tag_length: int = TAG_LENGTH) -> DataFrame:
    """BED rows of tiles; the score is 1000 * calls / n / 2, divided whole each time."""
    covered = calls.groupBy("tag").agg(F.count("*").alias("calls"))
    rows = placed.join(covered, "tag", "left").withColumn("calls", F.coalesce("calls", F.lit(0)))
    return _bed(rows, F.floor(F.floor(1000 * F.col("calls") / n_samples) / 2), tag_length)


def bed_line(bed: DataFrame) -> DataFrame:
    """BED rows as lines of text, with spaces between fields."""
    return bed.select(F.concat_ws(" ", "seqname", "start", "end", "tag", "score", F.lit("."), "thick_start", "thick_end").alias("value"))
