"""Choosing samples and their case/control status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pieces(lengths: list[int]) -> Column:
    """The different substrings of ``name`` that are of one of ``lengths``."""
    name = F.col("name").cast("string")
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda k: k <= F.length(name))
    every = F.transform(fitting, lambda k: F.transform(F.sequence(F.lit(1), F.length(name) - k + 1), lambda at: name.substr(at, k)))
    return F.array_distinct(F.flatten(every))


def match_patterns(names: DataFrame, patterns: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """(name, pattern, status) of every name that contains a pattern.

    Substrings of a name that are as long as any pattern are joined with the patterns by equality, so the work grows with the
    names, how long they are and what is found. Up to ``broadcast_rows`` patterns are broadcast, more are shuffled.
    A null name or pattern matches nothing, an empty pattern all names; equal rows each count.
    """
    n, lengths = patterns.agg(F.count("*"), F.collect_set(F.length(F.col("pattern").cast("string")))).first()
    side = F.broadcast(patterns) if n <= broadcast_rows else patterns
    found = names.withColumn("_piece", F.explode(_pieces(lengths))).join(side, F.col("_piece") == F.col("pattern").cast("string"))
    return found.drop("_piece")


def _tally(names: DataFrame, patterns: DataFrame, *greatest: str) -> DataFrame:
    """(name, n, ...) of the names with a pattern in them: how many pairs of a row of the name and a row of a pattern
    there are, and the greatest of the columns named. Equal names, and equal patterns, are counted before they meet."""
    few = names.groupBy("name").agg(F.count("*").alias("_names"))
    held = patterns.groupBy("pattern").agg(F.count("*").alias("_patterns"), *(F.max(c).alias(c) for c in greatest))
    return match_patterns(few, held).groupBy("name").agg(F.sum(F.col("_names") * F.col("_patterns")).alias("n"), *(F.max(c).alias(c) for c in greatest))


def case_control(names: DataFrame, patterns: DataFrame | None) -> DataFrame:
    """(name, case_control): 1 or 0 of the one pattern a name contains.

    A name with several patterns, or with a status other than 0 and 1, is left unassigned (null). Without
    patterns all are controls.
    """
    if patterns is None:
        return names.select("name", F.lit(0).alias("case_control"))
    found = _tally(names, patterns, "status")
    status = F.when((F.col("n") == 1) & F.col("status").isin("0", "1"), F.col("status").cast("int"))
    return names.select("name").join(found, "name", "left").select("name", status.alias("case_control"))


def case_flags(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """(name, is_case, n): a case contains a pattern; n over 1 is an ambiguity the caller should refuse."""
    found = _tally(names, patterns)
    return names.select("name").join(found, "name", "left").select("name", F.col("n").isNotNull().alias("is_case"), F.coalesce("n", F.lit(0)).alias("n"))


def unused_patterns(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """Patterns that no name contains, which deserve a warning."""
    return patterns.join(match_patterns(names, patterns).select("pattern").distinct(), "pattern", "left_anti")


def phenotype(names: DataFrame, table: DataFrame) -> DataFrame:
    """(name, value): the last row (greatest ``line``) of ``table`` whose pattern the name contains; of equal lines the
    greatest value, and rows without a line are passed over. Of equal patterns only the last row meets the names, each once."""
    last = table.where("line is not null").groupBy("pattern").agg(F.max(F.struct("line", "value")).alias("last"))
    found = match_patterns(names.select("name").distinct(), last).groupBy("name").agg(F.max("last").alias("last"))
    return names.select("name").join(found, "name", "left").select("name", F.col("last.value").alias("value"))


def training_split(samples: DataFrame, size: float = 0.8, seed: int = 0, order: Column | None = None) -> DataFrame:
    """Samples with training 1 or 0 where case_control is known, null elsewhere.

    ``size`` is a share of the eligible samples up to 1, else a number of them. The choice follows a
    hash of the name and the seed, so it doesn't depend on partitions.
    """
    eligible = samples.where(F.col("case_control").isNotNull())
    n = eligible.count()
    if n == 0:
        raise ValueError("no eligible samples")
    want = int(size * n) if size <= 1 else min(n, int(size))
    order = F.xxhash64("name", F.lit(seed)) if order is None else order
    place = F.row_number().over(Window.orderBy(order, "name"))  # a row for each genome
    chosen = eligible.select("name", F.when(place <= want, 1).otherwise(0).alias("training"))
    return samples.join(chosen, "name", "left")


def numbered(samples: DataFrame) -> DataFrame:
    """Samples with ``idx``, from 0 by name."""
    return samples.withColumn("idx", F.row_number().over(Window.orderBy("name")) - 1)


def misplaced(library: DataFrame, samples: DataFrame) -> DataFrame:
    """Places where the library's samples (idx, sample_id) and samples.csv disagree; empty if they match."""
    a, b = library.select("idx", F.col("sample_id").alias("here")), samples.select("idx", F.col("sample_id").alias("there"))
    return a.join(b, "idx", "full_outer").where(~F.col("here").eqNullSafe(F.col("there")))


def batch(rows: DataFrame, batches: int, which: int, order: str) -> DataFrame:
    """One of ``batches`` contiguous parts of a list, each of ceil(n / batches) rows."""
    n = rows.count()
    size = -(-n // batches) if n else 1
    place = F.row_number().over(Window.orderBy(order)) - 1
    return rows.withColumn("_at", place).where(F.floor(F.col("_at") / size) == which).drop("_at")


def fixed_batches(rows: DataFrame, size: int, order: str) -> DataFrame:
    """Rows with ``batch``, ``size`` rows to each."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(order)) - 1) / size).cast("long"))
