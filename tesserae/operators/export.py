"""Exports of variants by position, in a registry of formats.

Input is long: (seqname, position, sample, phase, ref, new), a row for each allele; ``new`` is "-" where the
tile has no coverage, and an allele equal to the reference has empty ref and new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.functions.hgvs import format_variant, genotype, genotype_cell, pad_left

FORMATS: dict[str, Callable[..., DataFrame]] = {}


def register(name: str):
    """Add a format: a function from alleles to a DataFrame."""

    def add(fn):
        FORMATS[name] = fn
        return fn

    return add


def export(alleles: DataFrame, name: str, **options) -> DataFrame:
    return FORMATS[name](alleles, **options)


def padded(alleles: DataFrame) -> DataFrame:
    """Alleles with the base before (left) added to bare insertions and deletions."""
    at, ref, new = pad_left(F.col("position"), F.col("ref"), F.col("new"), F.coalesce(F.col("left"), F.lit("")))
    real = (F.col("new") != "-") & ((F.col("ref") != "") | (F.col("new") != ""))
    return alleles.withColumn("_a", F.when(real, F.struct(at.alias("position"), ref.alias("ref"), new.alias("new"))).otherwise(F.struct(F.col("position").cast("long").alias("position"), F.col("ref"), F.col("new")))).select(*[c for c in alleles.columns if c not in ("position", "ref", "new", "left")], "_a.*")


def allele_counts(alleles: DataFrame) -> DataFrame:
    """(seqname, position, ref, alts, counts): alternatives in order, reference alleles and no-calls left out."""
    real = alleles.where((F.col("new") != "-") & ~((F.col("ref") == "") & (F.col("new") == "")))
    counts = real.groupBy("seqname", "position", "ref", "new").agg(F.count("*").alias("n"))
    packed = counts.groupBy("seqname", "position", "ref").agg(F.array_sort(F.collect_list(F.struct("new", "n"))).alias("a"))
    return packed.select("seqname", "position", "ref", F.transform("a", lambda x: x["new"]).alias("alts"), F.transform("a", lambda x: x["n"]).alias("counts"))


@register("vcf")
def vcf(alleles: DataFrame) -> DataFrame:
    """VCF records with allele counts."""
    rows = allele_counts(alleles)
    return rows.select("seqname", "position", "ref", F.array_join("alts", ",").alias("alt"), F.concat(F.lit("AC="), F.array_join(F.transform("counts", lambda n: n.cast("string")), ",")).alias("info"))


def _pairs(alleles: DataFrame) -> DataFrame:
    """(seqname, position, sample, a, b): both alleles of a sample; an absent one equals the reference."""
    same = F.struct(F.col("position").cast("long").alias("position"), F.lit("").alias("ref"), F.lit("").alias("new"))
    own = F.struct(F.col("position").cast("long").alias("position"), F.col("ref"), F.col("new"))
    rows = alleles.groupBy("seqname", "position", "sample").agg(F.max(F.when(F.col("phase") == 0, own)).alias("a"), F.max(F.when(F.col("phase") == 1, own)).alias("b"))
    return rows.select("seqname", "position", "sample", F.coalesce("a", same).alias("a"), F.coalesce("b", same).alias("b"))


@register("pvcf")
def pvcf(alleles: DataFrame) -> DataFrame:
    """(seqname, position, ref, alt, sample, gt) of every record and every sample seen at its position."""
    records = allele_counts(alleles).select("seqname", "position", "ref", "alts")
    both = records.join(_pairs(alleles), ["seqname", "position"])
    return both.select("seqname", "position", "ref", F.array_join("alts", ",").alias("alt"), "sample", genotype(F.col("ref"), F.col("alts"), F.col("a"), F.col("b")).alias("gt"))


@register("hgvs")
def hgvs(alleles: DataFrame) -> DataFrame:
    """(seqname, position, sample, cell)"""
    return _pairs(alleles).select("seqname", "position", "sample", genotype_cell(F.col("seqname"), F.col("a"), F.col("b")).alias("cell"))


def _distinct(alleles: DataFrame) -> DataFrame:
    real = alleles.where((F.col("new") != "-") & (F.col("ref") != F.col("new")))
    return real.select("seqname", "position", "ref", "new").distinct()


@register("hgvs-onehot")
def hgvs_onehot(alleles: DataFrame) -> DataFrame:
    """(hgvs, sample, value): 1 where the sample has the variant on either allele, 0 for others seen there."""
    here = _distinct(alleles)
    text = F.concat("seqname", F.lit("."), format_variant(F.col("position"), F.col("ref"), F.col("new")))
    seen = alleles.select("seqname", "position", "sample", F.col("ref").alias("r"), F.col("new").alias("n"))
    both = here.join(seen, ["seqname", "position"])
    has = ((F.col("ref") == F.col("r")) & (F.col("new") == F.col("n"))).cast("int")
    return both.groupBy(text.alias("hgvs"), "sample").agg(F.max(has).alias("value"))


@register("hgvs-numpy")
def hgvs_numpy(alleles: DataFrame) -> DataFrame:
    """(hgvs, sample, hom, het): -1 where an allele has no coverage."""
    here = _distinct(alleles)
    text = F.concat("seqname", F.lit(":g."), format_variant(F.col("position"), F.col("ref"), F.col("new")))
    both = here.join(_pairs(alleles), ["seqname", "position"])

    def flag(v):
        return F.when(v["new"] == "-", -1).when((v["ref"] == F.col("ref")) & (v["new"] == F.col("new")), 1).otherwise(0)

    a, b = flag(F.col("a")), flag(F.col("b"))
    none = (a < 0) | (b < 0)
    return both.select(text.alias("hgvs"), "sample", F.when(none, -1).when((a == 1) & (b == 1), 1).otherwise(0).alias("hom"), F.when(none, -1).when(a != b, 1).otherwise(0).alias("het"))


def vcf_lines(records: DataFrame, info: str = "info", identity: str | None = None) -> DataFrame:
    """Lines of VCF records, and seqname and position to partition and sort them by."""
    dot = F.lit(".")
    fields = ["seqname", F.col("position").cast("string"), F.col(identity) if identity else dot, "ref", "alt", dot, dot, F.col(info)]
    return records.select("seqname", "position", F.concat_ws("\t", *fields).alias("value"))


def alleles_of(calls: DataFrame, compared: DataFrame) -> DataFrame:
    """Alleles by position from calls (sample, tag, phase, hash, known) and compared variants (tag, hash, seqname,
    pos, changes): where any sample differs, every sample with a call of that tile has an allele."""
    change = compared.select("tag", "hash", "seqname", "pos", F.explode("changes").alias("c"))
    change = change.select("tag", "hash", "seqname", (F.col("pos") + F.col("c.position")).cast("long").alias("position"), F.col("c.ref").alias("ref"), F.col("c.new").alias("new"), F.col("c.left").alias("left"))
    sites = change.select("tag", "seqname", "position").distinct()
    here = calls.select("sample", "tag", "phase", "hash", "known").join(sites, "tag")
    own = here.join(change, ["tag", "hash", "seqname", "position"], "left")
    return own.select("seqname", "position", "sample", "phase", F.when(~F.col("known"), "").otherwise(F.coalesce("ref", F.lit(""))).alias("ref"), F.when(~F.col("known"), "-").otherwise(F.coalesce("new", F.lit(""))).alias("new"), F.coalesce("left", F.lit("")).alias("left"))
