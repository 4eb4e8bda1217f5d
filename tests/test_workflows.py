"""Workflows of several steps on a few records and contigs."""

import random

from pyspark.sql import functions as F

from tesserae.plans import workflows
from tesserae.sources.readers import parse_vcf
from test_study import K, dna, lib, world  # noqa: F401


def records(spark, *rows):
    """Records of (sample, chrom, pos, ref, alt, info, format, value)."""
    lines = [(s, "\t".join([c, str(p), ".", r, a, "30", "PASS", i, f, v])) for s, c, p, r, a, i, f, v in rows]
    return parse_vcf(spark.createDataFrame(lines, "sample_id string, value string"), "sample_id")


def test_haplotypes_of_kinds_of_gvcf(spark):
    ref = spark.createDataFrame([("chr1", "a" * 10), ("chr2", "c" * 10)], "seqname string, seq string")
    one = records(spark, ("s", "chr1", 3, "A", "G,<X>", ".", "GT", "1/2"), ("s", "chr1", 5, "A", "T", ".", "GT", "0|1"))
    two = records(spark, ("s", "chr2", 4, "C", "T", "IMP", "GT", "1|1"), ("s", "chr2", 8, "C", "T", "IMP", "GT", "1|1"))

    def made(**options):
        return {(r.seqname, r.phase): r.seq for r in workflows.gvcf_to_haplotypes(ref, [one, two], masked=False, **options).collect()}

    assert made(non_ref=True)["chr1", 1] == "aaaaTaaaaa"
    assert made(non_ref=True, chromosomes=["chr1"])["chr2", 0] == "c" * 10
    regions = spark.createDataFrame([("chr2", 0, 5)], "seqname string, start long, end long")
    both = made(non_ref=True, imputed_regions=regions)
    assert both["chr2", 0] == "cccTcccccc" and both["chr1", 1] == "aaaaTaaaaa"


def test_records_prepared(spark):
    rows = records(spark, ("s", "chr10", 4, "C", "T", "DP=1;X=2", "GT:GQ", "1|1:30"), ("s", "chr2", 9, "AC", "A", "END=12.", "GT:GQ", "0/1:9"), ("s", "chr2", 10, "C", "G", "X=1", "GT:GQ", "1:40"))
    excluded = spark.createDataFrame([("chr2", 9, 10)], "seqname string, start long, end long")
    assert [(r.chrom, r.pos) for r in workflows.prepare_imputation(rows, excluded).collect()] == [("chr10", 4)]
    out, counts = workflows.portable_records(rows, ("X",))
    assert [(r.chrom, r.pos, r.info) for r in out.collect()] == [("chr2", 9, "END=12."), ("chr10", 4, "DP=1")]
    assert {r.status: r.n for r in counts.collect()} == {"TP": 2, "FN": 1}
    good, regions = workflows.good_records(rows, 10, 20)
    assert sorted(r.pos for r in good.collect()) == [4, 10]
    assert sorted(r[:] for r in regions.collect()) == [("chr10", 3, 4), ("chr2", 9, 10)]
    inside, called = workflows.called_records(rows.where("pos <> 10"))
    assert sorted(r[:] for r in called.collect()) == [("chr10", 3, 4), ("chr2", 8, 12)] and sorted(r.pos for r in inside.collect()) == [4, 9]
    fixed = workflows.repaired_records([rows.where("chrom = 'chr2'"), rows.where("chrom = 'chr10'")], ["chr2", "chr10"])
    assert [(r.chrom, r.pos, r.sample) for r in fixed.collect()] == [("chr2", 9, "0/1:9"), ("chr2", 10, "1/1:40"), ("chr10", 4, "1|1:30")]


def test_studies(spark, lib, world):
    tags, ref, haplotypes, snp, _ = world
    t = spark.createDataFrame(list(enumerate(tags)), "tag int, tagseq string")
    r = spark.createDataFrame(list(ref.items()), "seqname string, seq string")
    batches = [spark.createDataFrame([(s, p, n, q) for (s, p), seqs in haplotypes.items() if s == own for n, q in seqs.items()], "sample string, phase int, seqname string, seq string") for own in "ab"]
    whole, points = workflows.study_by_batches(batches, r, t, spark.createDataFrame([("a", "1"), ("b", "0")], "pattern string, status string"), K, training=1.0)
    assert whole.calls.exceptAll(lib.calls).isEmpty() and whole.variants.exceptAll(lib.variants).isEmpty() and points.count() > 0
    everywhere = spark.createDataFrame([("1", 0, 10_000), ("2", 0, 10_000)], "seqname string, start long, end long")
    start = spark.createDataFrame([("1", 230, 240)], "seqname string, start long, end long")
    made = workflows.matrices(lib, ["a", ""], {"all": everywhere, "start": start})
    assert {k: v[0].select("sample", "tag").distinct().count() for k, v in made.items()} == {("a", "all"): 8, ("a", "start"): 2, ("", "all"): 16, ("", "start"): 4}
    base = ref["chr1"][snp].upper()
    known = spark.createDataFrame([("chr1", snp + 1, base, "A" if base != "A" else "C", "rs7", 0.1)], "chrom string, pos long, ref string, alt string, rsid string, af double")
    found, rates = workflows.annotated_variants(lib, known)
    assert [x.pos for x in found.where("rsid = 'rs7'").collect()] == [snp + 1]
    assert {x.chrom: x.n for x in rates.collect()}[None] == found.count() == 3


def test_imputation_to_matrix(spark):
    rng = random.Random(2)
    tags = [dna(rng, K) for _ in range(3)]
    seq = dna(rng, 50) + "".join(t + dna(rng, 60) for t in tags)
    ref = spark.createDataFrame([("chr1", seq)], "seqname string, seq string")
    at = 50 + K + 20
    rows = records(spark, ("s", "chr1", at + 1, seq[at].upper(), "ACGT".replace(seq[at].upper(), "")[0], "IMP", "GT", "1|1"), ("t", "chr1", 3, "N", "G", ".", "GT", "0|1"))
    regions = spark.createDataFrame([("chr1", 0, at + 50)], "seqname string, start long, end long")
    cells, notes = workflows.imputation_to_matrix(ref, rows, regions, spark.createDataFrame(list(enumerate(tags)), "tag int, tagseq string"))
    got = {(r.sample, r.tag, r.phase): r.value for r in cells.collect()}
    assert got["s", 0, 0] == got["s", 0, 1] != got["t", 0, 0] and got["s", 2, 0] == got["t", 2, 0] == 1
    assert notes.where(F.col("position") == at + 1).count() == 1
