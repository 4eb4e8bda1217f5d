"""Operations on intervals of sequences."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the bins by which interval joins find partners.
BIN = 1 << 14


def _binned(rows: DataFrame, start: str, end: str, width: int) -> DataFrame:
    first, last = F.floor(F.col(start) / width), F.floor(F.col(end) / width)
    return rows.withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last))))


def overlap(a: Column, b: Column, c: Column, d: Column, closed: bool = True) -> Column:
    """Whether [a, b] and [c, d] overlap; closed intervals that touch do."""
    return (a <= d) & (b >= c) if closed else (a < d) & (b > c)


def semi_join(rows: DataFrame, regions: DataFrame, closed: bool = True, how: str = "left_semi", width: int = BIN, broadcast_rows: int = 10_000) -> DataFrame:
    """Rows (seqname, start, end) that overlap any region (or none, with ``left_anti``).

    Up to ``broadcast_rows`` regions are broadcast. Beyond that both sides are joined on (seqname, bin), and
    the rows' own places are told apart by all their columns.
    """
    r = regions.select(F.col("seqname").alias("_s"), F.col("start").alias("_a"), F.col("end").alias("_b"))
    meets = (F.col("seqname") == F.col("_s")) & overlap(F.col("start"), F.col("end"), F.col("_a"), F.col("_b"), closed)
    if regions.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(r), meets, how)
    return binned_semi_join(rows, regions, closed, how, width)


def binned_semi_join(rows: DataFrame, regions: DataFrame, closed: bool = True, how: str = "left_semi", width: int = BIN) -> DataFrame:
    """``semi_join`` by an equi-join on coordinate bins."""
    r = _binned(regions.select(F.col("seqname").alias("_s"), F.col("start").alias("_a"), F.col("end").alias("_b")), "_a", "_b", width).withColumnRenamed("_bin", "_rbin")
    meets = (F.col("seqname") == F.col("_s")) & (F.col("_bin") == F.col("_rbin")) & overlap(F.col("start"), F.col("end"), F.col("_a"), F.col("_b"), closed)
    spans = rows.select("seqname", "start", "end").distinct()
    hit = _binned(spans, "start", "end", width).join(r, meets, "left_semi").select("seqname", "start", "end").distinct()
    return rows.join(hit, ["seqname", "start", "end"], how).select(*rows.columns)


def intersect(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """Common part of every pair of half-open intervals that overlap."""
    x = _binned(a.select("seqname", "start", "end"), "start", "end", width)
    y = _binned(b.select(F.col("seqname").alias("_s"), F.col("start").alias("_a"), F.col("end").alias("_b")), "_a", "_b", width).withColumnRenamed("_bin", "_rbin")
    start, end = F.greatest("start", "_a"), F.least("end", "_b")
    pairs = x.join(y, (F.col("seqname") == F.col("_s")) & (F.col("_bin") == F.col("_rbin")) & overlap(F.col("start"), F.col("end"), F.col("_a"), F.col("_b"), False))
    # a pair that shares several bins is told by the bin where its common part begins
    return pairs.where(F.col("_bin") == F.floor(start / width)).select("seqname", start.alias("start"), end.alias("end"))


def contained(rows: DataFrame, regions: DataFrame, width: int = BIN) -> DataFrame:
    """Rows that lie fully inside one region."""
    y = _binned(regions.select(F.col("seqname").alias("_s"), F.col("start").alias("_a"), F.col("end").alias("_b")), "_a", "_b", width).withColumnRenamed("_bin", "_rbin")
    x = rows.withColumn("_bin", F.floor(F.col("start") / width))
    inside = (F.col("seqname") == F.col("_s")) & (F.col("_bin") == F.col("_rbin")) & (F.col("start") >= F.col("_a")) & (F.col("end") <= F.col("_b"))
    return x.join(y, inside, "left_semi").drop("_bin")


def _with_reach(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with _bin and _reach: the greatest end of all before it on its sequence, in order of start, then end.

    Within a bin by a window, and from the bins before by a window over one row for each bin, so that no
    task sees all intervals of a sequence.
    """
    binned = rows.withColumn("_bin", F.floor(F.col("start") / width))
    ends = binned.groupBy("seqname", "_bin").agg(F.max("end").alias("_max"))
    before = F.max("_max").over(Window.partitionBy("seqname").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    within = F.max("end").over(Window.partitionBy("seqname", "_bin").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    return binned.join(ends.select("seqname", "_bin", before.alias("_carry")), ["seqname", "_bin"]).withColumn("_reach", F.greatest("_carry", within)).drop("_carry")


def _with_island(rows: DataFrame, new: Column, width: int) -> DataFrame:
    """``rows`` with _island: how many rows up to it on its sequence begin one (``new``, of _reach), counted by bins."""
    marked = _with_reach(rows, width).withColumn("_new", F.when(F.col("_reach").isNull() | new, 1).otherwise(0))
    opened = marked.groupBy("seqname", "_bin").agg(F.sum("_new").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("seqname").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    # equal intervals are one step, whatever their order
    within = F.sum("_new").over(Window.partitionBy("seqname", "_bin").orderBy("start", "end").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    joined = marked.join(opened.select("seqname", "_bin", F.coalesce(before, F.lit(0)).alias("_before")), ["seqname", "_bin"])
    return joined.withColumn("_island", F.col("_before") + within).drop("_before", "_new", "_reach", "_bin")


def merge(rows: DataFrame, width: int = BIN) -> DataFrame:
    """Union of half-open intervals; those that touch become one."""
    island = _with_island(rows.select("seqname", "start", "end"), F.col("start") > F.col("_reach"), width)
    return island.groupBy("seqname", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def complement(rows: DataFrame, sizes: DataFrame, width: int = BIN) -> DataFrame:
    """Gaps between the intervals on each sequence of ``sizes`` (seqname, size)."""
    edges = merge(rows, width).join(sizes, "seqname", "left_semi").unionByName(sizes.select("seqname", F.col("size").alias("start"), F.col("size").alias("end")))
    before = F.coalesce("_reach", F.lit(0)).cast("long")
    return _with_reach(edges, width).select("seqname", before.alias("a"), F.col("start").alias("b")).where("a < b").select("seqname", F.col("a").alias("start"), F.col("b").alias("end"))


def subtract(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """What is left of the union of ``a`` outside of ``b``."""
    whole = merge(a)
    sizes = whole.groupBy("seqname").agg(F.max("end").alias("size"))
    return intersect(whole, complement(b, sizes), width)


def called_regions(blocks: DataFrame, unreported_called: bool = False, width: int = BIN) -> DataFrame:
    """Called regions of gVCF blocks (seqname, start, end, called).

    Blocks of a sequence are read in order of start, then end. A called region runs on over called blocks
    that adjoin it, and over gaps if what is unreported counts as called. A block that overlaps what came
    before can only extend it, if it is called after a called one and longer; else it is ignored.

    Runs of blocks that overlap are told apart first, each is one ordered pass, and what they give is merged, so a
    sequence is the work of many tasks.
    """
    own = blocks.select("seqname", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "called")
    runs = _with_island(own, F.col("start") >= F.col("_reach"), width)
    ordered = runs.repartition("seqname", "_island").sortWithinPartitions("seqname", "_island", "start", "end", F.desc("called"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = begun = end = opened = None  # begun: where the run began; opened: where its called region, still open, did
        for pdf in batches:
            out = []
            for s, i, a, b, now in zip(pdf["seqname"], pdf["_island"], pdf["start"], pdf["end"], pdf["called"]):
                if (s, i) != name:
                    if name is not None:
                        out.append((name[0], opened, end, begun))
                    name, begun, end, opened = (s, i), a, b, a if now else None
                elif a < end:
                    if opened is not None and now:
                        end = max(end, b)
                else:  # after an ignored block, with or without a gap
                    if a > end and opened is not None:
                        out.append((s, opened, end, None))
                        opened = None
                    if a > end and unreported_called:
                        out.append((s, end, a, None))
                    if now:
                        opened = a if opened is None else opened
                    elif opened is not None:
                        out.append((s, opened, a, None))
                        opened = None
                    end = b
            yield pd.DataFrame(out, columns=["seqname", "start", "end", "begun"]).astype({"start": "Int64", "end": "Int64", "begun": "Int64"})
        if name is not None:
            yield pd.DataFrame([(name[0], opened, end, begun)], columns=["seqname", "start", "end", "begun"]).astype({"start": "Int64", "end": "Int64", "begun": "Int64"})

    found = ordered.mapInPandas(run, "seqname string, start long, end long, begun long")
    regions = found.where("start is not null").select("seqname", "start", "end")
    if unreported_called:
        bounds = found.where("begun is not null").select("seqname", F.col("begun").alias("start"), "end")
        gaps = _with_reach(bounds, width).where(F.col("_reach") < F.col("start")).select("seqname", F.col("_reach").alias("a"), F.col("start").alias("b"))
        regions = regions.unionByName(gaps.select("seqname", F.col("a").alias("start"), F.col("b").alias("end")))
    return merge(regions, width)


def called_islands(blocks: DataFrame) -> DataFrame:
    """``called_regions`` where blocks don't overlap and nothing unreported is called: islands of called blocks."""
    return merge(blocks.where("called"))


def drop_overlapping(rows: DataFrame, key: str = "seqname") -> DataFrame:
    """Keep the first of overlapping intervals, greedily; a dropped one doesn't cover what follows.

    Runs of intervals that overlap are told apart first; each is one ordered pass that holds a batch at a time.
    """
    fields = rows.schema
    runs = _with_island(rows.withColumnRenamed(key, "seqname"), F.col("start") >= F.col("_reach"), BIN)
    ordered = runs.repartition("seqname", "_island").sortWithinPartitions("seqname", "_island", "start", "end")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, reach = None, None
        for pdf in batches:
            keep = []
            for s, i, a, b in zip(pdf["seqname"], pdf["_island"], pdf["start"], pdf["end"]):
                if (s, i) != name:
                    name, reach = (s, i), None
                ok = reach is None or a >= reach
                keep.append(ok)
                if ok:
                    reach = b
            yield pdf[keep].rename(columns={"seqname": key})[fields.names]

    return ordered.mapInPandas(run, fields)
