"""Tile matrices, one-hot columns and HGVS matrices, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matrix_cells(calls: DataFrame, ranked: DataFrame, kept_tags: DataFrame | None = None) -> DataFrame:
    """(sample, tag, phase, value): the variant's rank, -1 where its bases aren't known; tags not kept are 0.

    Only calls have rows; every other cell of the matrix is 0.
    """
    rows = calls.join(ranked.select("tag", "hash", "variant"), ["tag", "hash"], "left")
    value = F.when(F.col("known"), F.coalesce("variant", F.lit(0))).otherwise(-1)
    if kept_tags is not None:
        rows = rows.join(kept_tags.select("tag", F.lit(True).alias("_kept")), "tag", "left")
        value = F.when(F.col("_kept"), value).otherwise(0)
    return rows.select("sample", "tag", "phase", value.cast("long").alias("value"))


def output_columns(tags: DataFrame) -> DataFrame:
    """(tag, outcol): tags numbered from 0 in order. A low-coverage tag keeps its number, an excluded one has none."""
    return tags.select("tag").distinct().withColumn("outcol", (F.row_number().over(Window.orderBy("tag")) - 1).cast("long"))


def dense_rows(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(sample, row): arrays of 2 cells for each output column, phases side by side, absent cells 0.

    A row is as wide as the matrix, so this belongs to a slice of tags, not to a whole genome.
    """
    n = columns.count()
    placed = cells.join(F.broadcast(columns) if n <= 1_000_000 else columns, "tag").select("sample", (2 * F.col("outcol") + F.col("phase")).cast("int").alias("col"), "value")
    held = placed.groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("m"))
    row = F.transform(F.sequence(F.lit(0), F.lit(2 * n - 1)), lambda c: F.coalesce(F.element_at("m", c), F.lit(0).cast("long")))
    return held.select("sample", row.alias("row"))


def onehot_recode(cells: DataFrame) -> DataFrame:
    """(tag, phase, value, outcol): indicator columns 1..max of each matrix column, absent values included.

    Values 0 and -1 have no indicator. Numbers are running sums over the matrix's columns, so that is what one
    task sees, not the indicators.
    """
    top = cells.groupBy("tag", "phase").agg(F.max("value").alias("top")).where("top > 0")
    before = F.sum("top").over(Window.orderBy("tag", "phase").rowsBetween(Window.unboundedPreceding, -1))
    every = top.withColumn("_before", F.coalesce(before, F.lit(0))).select("tag", "phase", "_before", F.explode(F.sequence(F.lit(1).cast("long"), "top")).alias("value"))
    return every.select("tag", "phase", "value", (F.col("_before") + F.col("value") - 1).cast("long").alias("outcol"))


def onehot_cells(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(sample, outcol) of the ones in the recoded matrix."""
    return cells.join(columns, ["tag", "phase", "value"]).select("sample", "outcol")


def genotypes(ranked_calls: DataFrame) -> DataFrame:
    """(sample, tag, variant, hom): each known variant of a sample, and whether both alleles are it."""
    known = ranked_calls.where(F.col("known") & (F.col("variant") > 0))
    return known.groupBy("sample", "tag", "variant").agg((F.count("*") >= 2).alias("hom"))


def homhet_columns(carriers: DataFrame, include_first: bool = False) -> DataFrame:
    """(tag, variant, hom, carriers) of the hom and het columns; tags with one variant have none, and variant 1,
    the most common, is left out unless ``include_first``."""
    several = carriers.groupBy("tag").agg(F.max("variant").alias("m")).where("m >= 2").select("tag")
    rows = carriers.join(several, "tag", "left_semi")
    if not include_first:
        rows = rows.where("variant > 1")
    return rows.groupBy("tag", "variant", "hom").agg(F.count("*").alias("carriers"))


def numbered_columns(columns: DataFrame) -> DataFrame:
    """Columns with ``col``, from 0 by tag, variant, hom before het.

    The global number is a running count over tags plus the place within the tag, so one task sees a row
    for each tag at most.
    """
    per_tag = columns.groupBy("tag").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("tag").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("tag").orderBy("variant", F.desc("hom"))) - 1
    return columns.join(per_tag.select("tag", before.alias("_before")), "tag").withColumn("col", (F.col("_before") + within).cast("long")).drop("_before")


def coordinates(carriers: DataFrame, columns: DataFrame, samples: DataFrame) -> DataFrame:
    """(row, col) of the ones: carriers in numbered columns, samples by their ``idx``."""
    return carriers.join(columns, ["tag", "variant", "hom"]).join(samples, "sample").select(F.col("idx").alias("row"), "col")


def chunk_columns(columns: DataFrame, tags_per_file: int) -> DataFrame:
    """First global column of each chunk: (chunk, n, first)."""
    sizes = columns.groupBy(F.floor(F.col("tag") / tags_per_file).cast("long").alias("chunk")).agg(F.count("*").alias("n"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def stride_sample(columns: DataFrame, most: int) -> DataFrame:
    """At most ``most`` pairs of columns: every stride-th pair (col // 2), numbered anew."""
    top = columns.agg(F.max("col")).first()[0]
    pairs = 0 if top is None else top // 2 + 1
    stride = max(1, -(-pairs // most)) if most > 0 else 1
    pair = F.floor(F.col("col") / 2)
    return columns.where(pair % stride == 0).withColumn("col", (2 * F.floor(pair / stride) + F.col("col") % 2).cast("long"))


def recode_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """(hom, het) of two alleles' flags: -1, -1 if either is not called (-1)."""
    hom = F.when((a < 0) | (b < 0), -1).when((a == 1) & (b == 1), 1).otherwise(0)
    het = F.when((a < 0) | (b < 0), -1).when((a == 1) != (b == 1), 1).otherwise(0)
    return hom, het


def hgvs_cells(annotations: DataFrame, calls: DataFrame, ref: DataFrame, mode: str = "single") -> DataFrame:
    """(hgvs, sample, phase, value) from annotations (tag, variant, hgvs), ranked calls and the reference's variants.

    A call of the reference's variant is 0, one with the difference 1, one without coverage or comparison
    -1. Another compared variant is 0 if ``mode`` is "chunked", and -1 as long as only rows with the
    difference are merged ("single"); "present" knows 0 and 1 alone. Rows from several tiles merge to the
    greatest value.
    """
    differ = annotations.where(~F.col("hgvs").isin("", "=") & F.col("hgvs").isNotNull()).select("hgvs", "tag", "variant").distinct()
    compared = annotations.where("hgvs <> ''").select("tag", "variant").distinct().withColumn("_compared", F.lit(True))
    here = differ.select("hgvs", "tag").distinct().join(calls.select("sample", "tag", "phase", "variant"), "tag")
    here = here.join(ref.select("tag", F.col("variant").alias("_ref")), "tag", "left")
    here = here.join(differ.withColumn("_has", F.lit(True)), ["hgvs", "tag", "variant"], "left").join(compared, ["tag", "variant"], "left")
    if mode == "present":
        value = F.when(F.col("_has"), 1).otherwise(0)
    else:
        other = F.when(F.col("_compared"), 0).otherwise(-1) if mode == "chunked" else F.lit(-1)
        value = F.when(F.col("_has"), 1).when(F.col("variant") == F.col("_ref"), 0).otherwise(other)
    return here.groupBy("hgvs", "sample", "phase").agg(F.max(value).cast("long").alias("value"))


def hgvs_homhet(cells: DataFrame) -> DataFrame:
    """(hgvs, sample, hom, het); a phase without a cell counts as not called."""
    pair = cells.groupBy("hgvs", "sample").agg(F.coalesce(F.max(F.when(F.col("phase") == 0, F.col("value"))), F.lit(-1)).alias("a"), F.coalesce(F.max(F.when(F.col("phase") == 1, F.col("value"))), F.lit(-1)).alias("b"))
    hom, het = recode_pair(F.col("a"), F.col("b"))
    return pair.select("hgvs", "sample", hom.cast("long").alias("hom"), het.cast("long").alias("het"))
