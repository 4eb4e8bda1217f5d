"""Intervals and variant files against loops; every query against SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tesserae.operators import intervals, samples, variants
from tesserae.plans import queries, workflows
from tesserae.sources import readers

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sql, name):
    frame = queries.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    if name not in queries.ORACLE:
        assert name in ("chi2_pvalues", "onehot_descriptors", "glm_scan", "hgvs_filter", "pca", "pca_plot_points", "gvcf_regions", "gvcf_regions_unreported_called", "greedy_hits", "tile_contigs", "lis_filter", "tile_hash_blake2b", "hgvs_diff")
        return
    result = sql.sql(queries.ORACLE[name])
    assert sorted(result.columns) == columns
    places = [result.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[p]) for p in places) for r in result.fetchall()), key=repr)


def random_intervals(rng, n, span=200, most=20):
    out = []
    for _ in range(n):
        a = rng.randrange(span)
        out.append((rng.choice("xy"), a, a + rng.randint(1, most)))
    return out


def covered(rows):
    return {(s, p) for s, a, b in rows for p in range(a, b)}


@pytest.mark.parametrize("seed", range(4))
def test_intervals_against_sets(spark, seed):
    rng = random.Random(seed)
    a, b = random_intervals(rng, 25), random_intervals(rng, 12)
    ddl = "seqname string, start long, end long"
    x, y = spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl)

    def rows(df):
        return [r[:] for r in df.select("seqname", "start", "end").collect()]

    merged = sorted(rows(intervals.merge(x)))
    assert covered(merged) == covered(a) and all(p[0] != q[0] or p[2] < q[1] for p, q in zip(merged, merged[1:]))
    for closed in (True, False):
        expected = sorted(r for r in a if any(r[0] == q[0] and (r[1] <= q[2] and r[2] >= q[1] if closed else r[1] < q[2] and r[2] > q[1]) for q in b))
        assert sorted(rows(intervals.semi_join(x, y, closed))) == expected
        assert sorted(rows(intervals.binned_semi_join(x, y, closed, width=8))) == expected
        assert sorted(rows(intervals.semi_join(x, y, closed, broadcast_rows=1, width=8))) == expected
    assert sorted(rows(intervals.intersect(x, y, 8))) == sorted((s, max(p, c), min(q, d)) for s, p, q in a for t, c, d in b if s == t and p < d and q > c)
    assert sorted(rows(intervals.contained(x, y, 8))) == sorted(r for r in a if any(r[0] == q[0] and r[1] >= q[1] and r[2] <= q[2] for q in b))
    assert covered(rows(intervals.subtract(x, y, 8))) == covered(a) - covered(b)
    sizes = spark.createDataFrame([("x", 260), ("y", 260), ("z", 5)], "seqname string, size long")
    assert covered(rows(intervals.complement(x, sizes))) == {(s, p) for s, n in (("x", 260), ("y", 260), ("z", 5)) for p in range(n)} - covered(a)
    kept, reach = [], {}
    for s, p, q in sorted(a):
        if p >= reach.get(s, 0):
            kept.append((s, p, q))
            reach[s] = q
    assert sorted(rows(intervals.drop_overlapping(x))) == kept


def test_called_regions(spark):
    def run(blocks, unreported=False):
        frame = spark.createDataFrame([("c", *b) for b in blocks], "seqname string, start long, end long, called boolean")
        return sorted((r.start, r.end) for r in intervals.called_regions(frame, unreported).collect())

    adjacent = [(0, 5, True), (5, 9, True), (9, 12, False), (12, 15, True)]
    assert run(adjacent) == [(0, 9), (12, 15)] == run(adjacent, True)
    gaps = [(2, 4, False), (6, 8, True), (10, 12, True), (14, 16, False)]
    assert run(gaps) == [(6, 8), (10, 12)]
    assert run(gaps, True) == [(4, 14)]
    assert run([(0, 4, False), (6, 8, False)], True) == [(4, 6)]
    overlapping = [(0, 10, True), (5, 12, True), (6, 20, False), (12, 14, False)]
    assert run(overlapping) == [(0, 12)]
    assert run([]) == []


def test_variant_lines(spark):
    text = ["##contig=<ID=c,length=40>", "#CHROM\tPOS", "c\t5\t.\tA\tG\t30\tPASS\tDP=1\tGT:GQ\t0/1:9", "c\t9\t.\tAC\tA,T\t30\tPASS\tEND=12.;X\tGT\t1|2", "c\t10\t.\tC\tT\t.\tLOW\t.\tGT:GQ\t./.:.", "c\t20\t.\tG\t<NON_REF>\t9\t.\tEND=30\tGT:GQ\t0/0:3"]
    lines = spark.createDataFrame([(t,) for t in text], "value string")
    records = readers.parse_vcf(lines)
    assert readers.contig_sizes(lines).collect()[0][:] == ("c", 40)
    names = spark.createDataFrame([("c",), ("d",), ("e",)], "label string")
    sizes = readers.genome_sizes(names, readers.contig_sizes(lines), spark.createDataFrame([("c", 1), ("d", 7)], "label string, length long"))
    assert sorted((r.label, r.length) for r in sizes.collect()) == [("c", 40), ("d", 7), ("e", None)]
    blocks = sorted((r.start, r.end, r.called) for r in variants.gvcf_blocks(records).collect())
    assert blocks == [(4, 5, True), (8, 10, False), (9, 10, False), (19, 30, False)]
    assert [r.pos for r in variants.filter_gq(records, 5).orderBy("pos").collect()] == [5, 9]
    assert [r.pos for r in variants.filter_gq(records, 5, True).orderBy("pos").collect()] == [5, 9, 10]
    assert [r.pos for r in variants.filter_quality(records, 10, 5).collect()] == [5]
    assert records.select(variants.fix_end(F.col("info")).alias("i")).where("i = 'END=12;X'").count() == 1
    ref = spark.createDataFrame([("c", "a" * 40)], "seqname string, seq string")
    own = records.withColumn("sample_id", F.lit("s"))
    got = {r.phase: r.seq for r in workflows.haplotypes_from_gvcf(ref, own, masked=False).collect()}
    assert got == {0: "a" * 8 + "A" + "a" * 30, 1: "a" * 4 + "G" + "a" * 3 + "T" + "a" * 30}
    masked = {r.phase: r.seq for r in workflows.haplotypes_from_gvcf(ref, own).collect()}
    assert masked[1].replace("n", "") == "GT" and masked[0].replace("n", "") == "aA"
    counts = {r.status: r.n for r in workflows.compare_calls(records.where("pos < 10"), records.where("pos > 5"), None).collect()}
    assert counts == {"FN": 1, "TP": 1, "FP": 2}
    spans = spark.createDataFrame([("c", 0, 6)], "seqname string, start long, end long")
    assert workflows.compare_calls(records, records, spans).first().n == 3
    cleaned = workflows.clean_gvcf(records, 3, keep_missing=True).orderBy("pos").collect()
    assert [r.pos for r in cleaned] == [5, 9, 20]
    found, rates = workflows.annotate_records(records, spark.createDataFrame([("c", 5, "A", "G", "rs1", 0.5)], "chrom string, pos long, ref string, alt string, rsid string, af double"))
    assert {r.pos: r.id for r in found.collect()} == {5: "rs1", 9: ".", 10: ".", 20: "."} and {(r.chrom, r.rsid_rate) for r in rates.collect()} == {("c", 25.0), (None, 25.0)}
    called = spark.createDataFrame([("c", 0, 20)], "seqname string, start long, end long")
    assert [r.pos for r in workflows.vcf_and_bed_to_gvcf(records.where("pos < 6"), called).collect()] == [1, 5, 6]
    marked = records.withColumn("line", F.when(F.col("pos") == 9, F.concat("line", F.lit("IMP"))).otherwise(F.col("line")))
    assert sorted(r.pos for r in workflows.merge_phased_imputed(marked, called).collect()) == [5, 9, 10, 20]
    fill = variants.hom_ref_fill(spark.createDataFrame([("c", 0, 20)], "seqname string, start long, end long"), records.where("pos = 5"))
    assert sorted((r.pos, r.info) for r in fill.collect()) == [(1, "END=4"), (5, "DP=1"), (6, "END=20")]


def test_samples(spark):
    names = spark.createDataFrame([("aa1",), ("aa2",), ("b1",), ("c9",)], "name string")
    patterns = spark.createDataFrame([("aa", "1"), ("1", "0"), ("c", "x"), ("zz", "1")], "pattern string, status string")
    assert {r.name: r.case_control for r in samples.case_control(names, patterns).collect()} == {"aa1": None, "aa2": 1, "b1": 0, "c9": None}
    assert {r.case_control for r in samples.case_control(names, None).collect()} == {0}
    assert [r.pattern for r in samples.unused_patterns(names, patterns).collect()] == ["zz"]
    split = samples.training_split(samples.case_control(names, patterns), 0.5).collect()
    assert sorted(r.training for r in split if r.training is not None) == [0, 1]
    with pytest.raises(ValueError):
        samples.training_split(names.withColumn("case_control", F.lit(None).cast("int")))
    numbered = samples.numbered(names).select("idx", F.col("name").alias("sample_id"))
    assert samples.misplaced(numbered, numbered).count() == 0
    assert samples.misplaced(numbered, numbered.where("idx < 3")).count() == 1
    files = spark.createDataFrame([("d/x.chr1.vcf",), ("d/y.chr11.vcf",)], "path string")
    chromosomes = spark.createDataFrame([("chr1",)], "chrom string")
    assert [r.path for r in variants.match_by_chromosome(chromosomes, files).collect()] == ["d/x.chr1.vcf"]
    beds = spark.createDataFrame([("e/x.chr1.bed",)], "path string")
    assert variants.match_by_base(files, beds, r"\.(vcf|bed)$").collect()[0][:] == ("x.chr1", "d/x.chr1.vcf", "e/x.chr1.bed")
