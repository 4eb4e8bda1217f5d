"""Preparing and comparing variant files, row by row."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Settings of the callers whose files are known: whether unreported sites are called, and what a line must hold.
PRESETS = {
    "complete_genomics": {"unreported_called": True, "ignore": ("CNV", "INS:ME"), "least_gq": None, "least_qual": None, "passing": ("PASS",)},
    "freebayes": {"unreported_called": False, "ignore": (), "least_gq": None, "least_qual": None, "passing": ("PASS",)},
    "gatk": {"unreported_called": False, "ignore": (), "least_gq": 5, "least_qual": None, "passing": ()},
}


def format_field(name: str, fmt: str = "format", sample: str = "sample") -> Column:
    """Value of a FORMAT key in the sample column; null if the key is absent."""
    place = F.array_position(F.split(fmt, ":"), name).cast("int")
    return F.when(place > 0, F.try_element_at(F.split(sample, ":"), F.greatest(place, F.lit(1))))


def info_field(name: str, info: str = "info") -> Column:
    value = F.regexp_extract(info, f"(?:^|;){name}=([^;]*)", 1)
    return F.when(value != "", value)


def bed_interval() -> tuple[Column, Column]:
    """Half-open interval of a record: from POS - 1 (0 stays 0) to END, or past the reference bases."""
    start = F.greatest(F.col("pos") - 1, F.lit(0))
    return start.cast("long"), F.coalesce(info_field("END").try_cast("long"), start + F.length("ref")).cast("long")


def is_called(least_gq: int | None = None, least_qual: float | None = None, passing: Sequence[str] = ()) -> Column:
    """Whether a line is called: GQ and QUAL high enough (absent GQ is 0), a passing phrase, and no . in the genotype."""
    out = ~F.coalesce(format_field("GT"), F.lit(".")).contains(".")
    if least_gq is not None:
        out = out & (F.coalesce(format_field("GQ").try_cast("int"), F.lit(0)) >= least_gq)
    if least_qual is not None:
        out = out & (F.coalesce(F.col("qual"), F.lit(0.0)) >= least_qual)
    if passing:
        any_ = F.lit(False)
        for phrase in passing:
            any_ = any_ | F.col("line").contains(phrase)
        out = out & any_
    return out


def considered(phrases: Sequence[str]) -> Column:
    out = F.lit(True)
    for phrase in phrases:
        out = out & ~F.col("line").contains(phrase)
    return out


def gvcf_blocks(records: DataFrame, preset: str = "gatk") -> DataFrame:
    """(seqname, start, end, called) of gVCF records, by a caller's settings."""
    p = PRESETS[preset]
    start, end = bed_interval()
    return records.where(considered(p["ignore"])).select(F.col("chrom").alias("seqname"), start.alias("start"), end.alias("end"), is_called(p["least_gq"], p["least_qual"], p["passing"]).alias("called"))


def filter_gq(records: DataFrame, cutoff: int, keep_missing: bool = False) -> DataFrame:
    """Records with GQ at least ``cutoff``, or without the key; . only with ``keep_missing``; short lines go."""
    gq = format_field("GQ")
    ok = F.when(gq.isNull(), True).when(gq == ".", keep_missing).otherwise(gq.try_cast("double") >= cutoff)
    return records.where((F.size(F.split("line", "\t")) >= 10) & F.coalesce(ok, F.lit(False)))


def filter_quality(records: DataFrame, least_qual: float, least_gq: float) -> DataFrame:
    """Records without QUAL, or with QUAL or GQ too low, go."""
    return records.where((F.col("qual") >= least_qual) & (F.coalesce(format_field("GQ").try_cast("double"), F.lit(0.0)) >= least_gq))


def variants_only(records: DataFrame) -> DataFrame:
    """Records with a real alternative: neither * nor <NON_REF>, and not . alone."""
    return records.where(~F.col("line").contains("*") & ~F.col("line").contains("<NON_REF>") & (F.col("alt") != "."))


def ref_differs(records: DataFrame) -> DataFrame:
    return records.where(F.col("ref") != F.col("alt"))


def imputed(records: DataFrame) -> DataFrame:
    return records.where(F.col("line").contains("IMP") & ~F.col("line").contains("0|0"))


def phased(records: DataFrame) -> DataFrame:
    return records.where(~F.col("line").contains("IMP") & ~F.col("line").contains("0|0"))


def diploid(records: DataFrame) -> DataFrame:
    """A haploid genotype g becomes g/g."""
    gt, rest = F.substring_index("sample", ":", 1), F.regexp_extract("sample", "^[^:]*(.*)$", 1)
    one = ~gt.rlike(r"[/|]")
    return records.withColumn("sample", F.when(one, F.concat(gt, F.lit("/"), gt, rest)).otherwise(F.col("sample")))


def mitochondrial(records: DataFrame) -> DataFrame:
    """Heterozygous records of the mitochondrion go; others become diploid."""
    alleles = F.split(F.substring_index("sample", ":", 1), r"[/|]")
    return diploid(records.where(~F.col("chrom").rlike("^(chr)?MT?$") | (F.size(F.array_distinct(alleles)) == 1)))


def real_alleles(records: DataFrame) -> DataFrame:
    """Records with one alternative, or whose genotype doesn't name the last of them (the placeholder)."""
    n = F.size(F.split("alt", ","))
    alleles = F.split(F.substring_index("sample", ":", 1), r"[/|]")
    return records.where((n == 1) | ~F.array_contains(alleles, n.cast("string")))


def fix_end(info: Column) -> Column:
    """INFO without the dot in END=."""
    return F.regexp_replace(info, r"(^|;)END=([0-9]*)\.([0-9]*)", "$1END=$2$3")


def drop_info(info: Column, names: Sequence[str]) -> Column:
    """INFO without the named keys; . if none is left."""
    kept = F.filter(F.split(info, ";"), lambda x: ~F.substring_index(x, "=", 1).isin(list(names)))
    return F.when(F.size(kept) == 0, ".").otherwise(F.array_join(kept, ";"))


def with_known_ids(records: DataFrame, known: DataFrame) -> DataFrame:
    """Records with rsid and af of the same allele (chrom, pos, ref, alt), and the rsid added to their id."""
    k = known.select("chrom", "pos", "ref", "alt", "rsid", "af")
    both = records.join(k, ["chrom", "pos", "ref", "alt"], "left")
    return both.withColumn("id", F.when(F.col("id") == ".", F.coalesce("rsid", F.lit("."))).otherwise(F.concat_ws(";", "id", "rsid")))


def compare(baseline: DataFrame, calls: DataFrame, key: Sequence[str] = ("chrom", "pos", "ref", "alt")) -> DataFrame:
    """Alleles of either set, each TP (in both), FN (baseline alone) or FP (calls alone)."""
    a, b = baseline.select(*key).distinct().withColumn("_a", F.lit(1)), calls.select(*key).distinct().withColumn("_b", F.lit(1))
    status = F.when(F.col("_b").isNull(), "FN").when(F.col("_a").isNull(), "FP").otherwise("TP")
    return a.join(b, list(key), "full_outer").select(*key, status.alias("status"))


def merge_records(*files: DataFrame, key: Sequence[str] = ("chrom", "pos", "ref", "alt")) -> DataFrame:
    """Union of records by allele, the first file's record winning."""
    out = None
    for k, f in enumerate(files):
        part = f.withColumn("_file", F.lit(k))
        out = part if out is None else out.unionByName(part)
    rest = [c for c in files[0].columns if c not in key]
    first = F.min_by(F.struct(*rest), "_file").alias("r")
    return out.groupBy(*key).agg(first).select(*key, "r.*").select(*files[0].columns)


def concat_chromosomes(records: DataFrame, chromosomes: Sequence[str]) -> DataFrame:
    """Records in a given order of chromosomes, then by position; others go."""
    place = F.array_position(F.array(*map(F.lit, chromosomes)), F.col("chrom"))
    return records.withColumn("_at", place).where("_at > 0").orderBy("_at", "pos").drop("_at")


def match_by_base(a: DataFrame, b: DataFrame, suffix: str) -> DataFrame:
    """Files paired by their base name, up to ``suffix`` (a pattern)."""
    base = F.regexp_replace(F.regexp_replace("path", "^.*/", ""), suffix, "")
    return a.select(base.alias("base"), F.col("path").alias("a")).join(b.select(base.alias("base"), F.col("path").alias("b")), "base")


def match_by_chromosome(chromosomes: DataFrame, files: DataFrame) -> DataFrame:
    """Files whose name holds a chromosome and a dot; the list of chromosomes (at most ten thousand) is broadcast."""
    if chromosomes.limit(10_001).count() > 10_000:
        raise ValueError("there are more than 10000 chromosomes")
    name = F.regexp_replace("path", "^.*/", "")
    return files.join(F.broadcast(chromosomes), F.contains(name, F.concat("chrom", F.lit("."))))


def parameter_grid(*lists: DataFrame) -> DataFrame:
    """Every combination of short lists of parameters (at most a thousand rows each)."""
    out = None
    for df in lists:
        if df.limit(1001).count() > 1000:
            raise ValueError("a list of parameters has more than 1000 rows")
        out = df if out is None else out.crossJoin(F.broadcast(df))
    return out


def consensus(ref: DataFrame, records: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """(sample, phase, seqname, seq): the reference (seqname, seq) with each haplotype's alleles put in.

    Records are (sample_id, chrom, pos, ref, alt, gt). Overlapping alleles after the first are left out;
    ``mask`` (sample_id, seqname, start, end) becomes n. A contig and its records are one group.
    """
    side = F.split("gt", r"[/|]")
    alleles = records.select("sample_id", F.col("chrom").alias("seqname"), "pos", "ref", F.split("alt", ",").alias("alts"), F.posexplode(side).alias("phase", "allele"))
    number = F.col("allele").try_cast("int")
    alleles = alleles.where(number > 0).select("sample_id", "seqname", "phase", "pos", "ref", F.get("alts", number - 1).alias("alt"))
    put = alleles.groupBy("sample_id", "seqname", "phase").agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "alt"))).alias("edits"))
    haplotypes = records.select("sample_id").distinct().crossJoin(F.broadcast(records.sparkSession.createDataFrame([(0,), (1,)], "phase int")))
    rows = ref.select("seqname", "seq").join(haplotypes)
    rows = rows.join(put, ["sample_id", "seqname", "phase"], "left")
    if mask is not None:
        hidden = mask.groupBy("sample_id", "seqname").agg(F.collect_list(F.struct("start", "end")).alias("hidden"))
        rows = rows.join(hidden, ["sample_id", "seqname"], "left")
    else:
        rows = rows.withColumn("hidden", F.lit(None).cast("array<struct<start:bigint,end:bigint>>"))

    @F.pandas_udf(rows.schema["seq"].dataType)
    def build(seq: pd.Series, edits: pd.Series, hidden: pd.Series) -> pd.Series:
        out = []
        for s, e, h in zip(seq, edits, hidden):
            parts, at = [], 0
            for a, b in sorted((span["start"], min(span["end"], len(s))) for span in h) if h is not None else ():
                a = max(a, at)
                if b > a:
                    parts += [s[at:a], "n" * (b - a)]
                    at = b
            bases = "".join(parts) + s[at:] if parts else s
            parts, at = [], 0
            for x in e if e is not None else ():
                start = x["pos"] - 1
                if start >= at:
                    parts += [bases[at:start], x["alt"]]
                    at = start + len(x["ref"])
            out.append("".join(parts) + bases[at:])
        return pd.Series(out, dtype=object)

    return rows.select(F.col("sample_id").alias("sample"), "phase", "seqname", build("seq", "edits", "hidden").alias("seq"))


def hom_ref_fill(called: DataFrame, variants: DataFrame, ref_base: Column | None = None) -> DataFrame:
    """gVCF rows: variants as they are, and hom-ref blocks (alt <NON_REF>, END) for called stretches without one."""
    from tesserae.operators.intervals import subtract

    start, end = bed_interval()
    spans = variants.select(F.col("chrom").alias("seqname"), start.alias("start"), end.alias("end"))
    rest = subtract(called, spans)
    blocks = rest.select(F.col("seqname").alias("chrom"), (F.col("start") + 1).alias("pos"), F.lit("<NON_REF>").alias("alt"), F.concat(F.lit("END="), F.col("end").cast("string")).alias("info"))
    return blocks.unionByName(variants.select("chrom", "pos", "alt", "info"))
