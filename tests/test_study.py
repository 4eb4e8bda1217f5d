"""A small study from sequences to exports, on sequences of our own."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import annotate, export, filters, library, matrix, pca, reference, tiling
from tesserae.plans import workflows
from tesserae.sources import readers, writers
from tesserae.streaming import ingest

K = 24


def dna(rng, n):
    return "".join(rng.choice("acgt") for _ in range(n))


@pytest.fixture(scope="module")
def world():
    """Tags, a reference of two chromosomes, and two diploid samples with known changes."""
    rng = random.Random(7)
    tags = [dna(rng, K) for _ in range(8)]
    ref = {}
    for c in (0, 1):
        seq = "nnn" + dna(rng, 97) if c == 0 else dna(rng, 100)
        for t in tags[4 * c : 4 * c + 4]:
            seq += t + dna(rng, 100)
        ref[f"chr{c + 1}"] = seq
    haplotypes = {(s, p): dict(ref) for s in ("a", "b") for p in (0, 1)}
    first = ref["chr1"]
    snp = 100 + K + 100 + K + 40  # in tile 1; tile 0 has no-calls
    haplotypes["a", 0]["chr1"] = first[:snp] + ("a" if first[snp] != "a" else "c") + first[snp + 1 :]
    haplotypes["a", 1]["chr1"] = haplotypes["a", 0]["chr1"]
    second = ref["chr2"]
    at = second.index(tags[6])  # a change within a tag: tile 5 spans two reference tiles
    haplotypes["b", 0]["chr2"] = second[: at + 5] + ("g" if second[at + 5] != "g" else "t") + second[at + 6 :]
    gap = second.index(tags[4]) + K + 30
    haplotypes["b", 1]["chr2"] = second[:gap] + second[gap + 6 :]  # a deletion in tile 4
    no_call = second.index(tags[7]) + K + 10
    haplotypes["a", 0]["chr2"] = second[:no_call] + "nn" + second[no_call + 2 :]
    return tags, ref, haplotypes, snp, at


@pytest.fixture(scope="module")
def lib(spark, world):
    tags, ref, haplotypes, _, _ = world
    t = spark.createDataFrame(list(enumerate(tags)), "tag int, tagseq string")
    r = spark.createDataFrame(list(ref.items()), "seqname string, seq string")
    c = spark.createDataFrame([(s, p, n, q) for (s, p), seqs in haplotypes.items() for n, q in seqs.items()], "sample string, phase int, seqname string, seq string")
    return workflows.build_library(c, r, t, K)


def test_tiles_rebuild_their_contig(spark, world):
    tags, ref, haplotypes, _, _ = world
    t = spark.createDataFrame(list(enumerate(tags)), "tag int, tagseq string")
    contigs = [("a", 0, n, q) for n, q in haplotypes["b", 0].items()] + [("x", 0, "none", "acgtn"), ("y", 0, "empty", "")]
    tiles, stats = tiling.tile_contigs(spark.createDataFrame(contigs, "sample string, phase int, seqname string, seq string"), t, K)
    got = {}
    for r in tiles.orderBy("seqname", "step").collect():
        got[r.seqname] = got[r.seqname] + r.seq[K:] if r.seqname in got else r.seq
    assert got == haplotypes["b", 0]
    counts = {r.seqname: (r.length, r.bases, r.path_length) for r in tiling.import_statistics(tiles, stats).collect()}
    assert counts["chr2"] == (len(ref["chr2"]), len(ref["chr2"]), 3) and counts["none"] == (5, 4, 0) and counts["empty"] == (0, 0, 0)


def test_duplicates_and_order(spark):
    t = spark.createDataFrame([(0, "aaac"), (1, "ccca"), (2, "gggt")], "tag int, tagseq string")
    c = spark.createDataFrame([("s", 0, "c", "aaacttccca" + "tt" + "aaac" + "gggt"), ("s", 0, "d", "gggttaaacttccca")], "sample string, phase int, seqname string, seq string")

    def found(**options):
        tiles, stats = tiling.tile_contigs(c, t, 4, **options)
        return {n: [r.tag for r in tiles.where(F.col("seqname") == n).orderBy("step").collect()] for n in ("c", "d")}, {r.seqname: (r.dropped_dup, r.dropped_ooo) for r in stats.collect()}

    assert found(keep_duplicates=True) == ({"c": [0, 1, 0, 2], "d": [2, 0, 1]}, {"c": (0, 0), "d": (0, 0)})
    assert found() == ({"c": [1, 2], "d": [2, 0, 1]}, {"c": (2, 0), "d": (0, 0)})
    assert found(skip_out_of_order=True) == ({"c": [1, 2], "d": [0, 1]}, {"c": (2, 0), "d": (0, 1)})
    hits = tiling.greedy_hits(tiling.kmer_hits(c, t, 4), 4, ("sample", "phase", "seqname"))
    relational = {r.seqname: [h.tag for h in r.hits] for r in tiling.in_order(tiling.without_duplicates(hits)).collect()}
    assert relational == {"c": [1, 2], "d": [0, 1]}


def test_kmers_agree_with_a_loop(spark):
    rng = random.Random(3)
    seqs = [dna(rng, n) for n in (0, 3, 4, 5, 1023, 1024, 1027, 1028, 5000)]
    rows = tiling.kmers(spark.createDataFrame(list(enumerate(seqs)), "id int, seq string"), 4).collect()
    assert sorted((r.id, r.pos, r.kmer) for r in rows) == sorted((i, p, s[p : p + 4]) for i, s in enumerate(seqs) for p in range(len(s) - 3))


def test_reference_tiles(lib, world, spark):
    _, ref, _, _, _ = world
    tiles = lib.ref_tiles.orderBy("tag").collect()
    assert [(r.tag, r.pos, r.len) for r in tiles if r.seqname == "chr1"] == [(0, 0, 248), (1, 224, 148), (2, 348, 148), (3, 472, 124)]
    placed = reference.place_tiles(lib.ref_tiles.drop("pos"))
    assert placed.select("tag", "pos").exceptAll(lib.ref_tiles.select("tag", "pos")).count() == 0
    assert {r.seqname: r.seq for r in reference.reference_sequence(lib.ref_tiles).collect()} == ref
    assert [r.next_tag for r in reference.successors(lib.ref_tiles).orderBy("tag").collect()] == [1, 2, 3, -1, 5, 6, 7, -1]
    # a tag inside another tile goes
    inner = lib.ref_tiles.where("tag = 0").select("seqname", "step", "tag", "seq").withColumn("seq", F.lit("a" + "c" * 10 + "t" * 40))
    tags = spark.createDataFrame([(9, "c" * 10 + "t" * 14)], "tag int, tagseq string")
    other = spark.createDataFrame([("chr1", 9, 9, "t" * 60)], "seqname string, step int, tag int, seq string")
    assert [r.tag for r in reference.without_inner_tags(inner.unionByName(other), tags).collect()] == [0]


def test_matrix_and_annotations(lib, world):
    _, ref, _, snp, at = world
    cells, notes = workflows.tile_matrix(lib)
    got = {(r.sample, r.tag, r.phase): r.value for r in cells.collect()}
    assert got["a", 1, 0] == got["a", 1, 1] and got["b", 1, 0] == got["b", 1, 1] and got["a", 1, 0] != got["b", 1, 0]
    assert got["a", 7, 0] == got["a", 0, 0] == -1 and ("b", 6, 0) not in got and got["a", 2, 0] == 1
    rows = {r.hgvs: r for r in notes.where("hgvs not in ('', '=')").collect()}
    base = ref["chr1"][snp].upper()
    new = "A" if base != "A" else "C"
    assert f"chr1:g.{snp + 1}{base}>{new}" in rows
    base = ref["chr2"][at + 5].upper()
    new = "G" if base != "G" else "T"
    assert f"chr2:g.{at + 6}{base}>{new}" in rows and rows[f"chr2:g.{at + 6}{base}>{new}"].tag == 5
    assert sum("del" in h for h in rows) == 1 and len(rows) == 3
    # the reference's tile 0 isn't known, so it has no rank
    assert notes.where("hgvs = '='").count() == 7 and lib.ref_tiles.count() == 8
    region = lib.ref_tiles.sparkSession.createDataFrame([("1", 230, 240)], "seqname string, start long, end long")
    assert sorted({r.tag for r in workflows.tile_matrix(lib, region)[0].collect()}) == [0, 1]


def test_exports(lib, world):
    _, ref, _, snp, at = world
    base = ref["chr1"][snp].upper()
    new = "A" if base != "A" else "C"
    cells = {(r.position, r.sample): r.cell for r in workflows.export_variants(lib, "hgvs").where("seqname = 'chr1'").collect()}
    assert cells == {(snp + 1, "a"): f"chr1:g.{snp + 1}{base}>{new}", (snp + 1, "b"): "."}
    gt = {(r.position, r.sample): r.gt for r in workflows.export_variants(lib, "pvcf").where("seqname = 'chr1'").collect()}
    assert gt == {(snp + 1, "a"): "1/1", (snp + 1, "b"): "0/0"}
    vcf = workflows.export_variants(lib, "vcf").orderBy("seqname", "position").collect()
    assert vcf[0][:] == ("chr1", snp + 1, base, new, "AC=2") and len(vcf) == 3
    deletion = next(r for r in vcf if len(r.ref) == 7)
    assert len(deletion.alt) == 1 and deletion.ref[0] == deletion.alt and deletion.info == "AC=1"
    lines = [r.value for r in export.vcf_lines(workflows.export_variants(lib, "vcf")).orderBy("seqname", "position").collect()]
    assert lines[0].split("\t") == ["chr1", str(snp + 1), ".", base, new, ".", ".", "AC=2"]
    hot = {(r.hgvs, r.sample): r.value for r in workflows.export_variants(lib, "hgvs-onehot").where("hgvs like 'chr1%'").collect()}
    assert hot == {(f"chr1.{snp + 1}{base}>{new}", "a"): 1, (f"chr1.{snp + 1}{base}>{new}", "b"): 0}
    numpy = {(r.sample): (r.hom, r.het) for r in workflows.export_variants(lib, "hgvs-numpy").where("hgvs like 'chr1%'").collect()}
    assert numpy == {"a": (1, 0), "b": (0, 0)}


def test_association(spark, lib):
    patterns = spark.createDataFrame([("a", "1"), ("b", "0")], "pattern string, status string")
    points = workflows.association_study(lib, patterns, training=1.0).collect()
    assert points and all(0 <= r.pvalue <= 1 for r in points)
    assert [r.pos for r in points] == sorted(r.pos for r in points if r.seqname == "chr1") + sorted(r.pos for r in points if r.seqname == "chr2")
    scored = workflows.association_study(lib, patterns, training=1.0, components=1)
    assert scored.columns.count("pvalue") == 1 and scored.count() > 0


def test_pca_is_that_of_the_dense_matrix(spark):
    rng = np.random.default_rng(2)
    x = (rng.random((20, 60)) < 0.3).astype(float)
    training = np.arange(20) % 4 != 0
    ones = spark.createDataFrame([(int(r), int(c)) for r, c in zip(*np.nonzero(x))], "row long, col long")
    gram = pca.gram_matrix(ones, 20)
    assert (gram == x @ x.T).all()
    got = pca.principal_components(gram, training, 3)
    centred = x - x[training].mean(axis=0)
    _, _, v = np.linalg.svd(centred[training], full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ v[:3].T), atol=1e-8)
    pairs = {(r.a, r.b): r.n for r in pca.gram_counts(ones).collect()}
    assert all(pairs.get((i, j), 0) == (x @ x.T)[i, j] for i in range(20) for j in range(i, 20))


def test_onehot_recode(spark):
    values = [[0, 1, 3], [2, 0, 1], [-1, 1, 1]]
    cells = spark.createDataFrame([(s, c, 0, v) for s, row in enumerate(values) for c, v in enumerate(row)], "sample long, tag int, phase int, value long")
    columns = matrix.onehot_recode(cells)
    got = np.zeros((3, columns.count()), int)
    for r in matrix.onehot_cells(cells, columns).collect():
        got[r.sample, r.outcol] = 1
    assert got.tolist() == [[0, 0, 1, 0, 0, 1], [0, 1, 0, 1, 0, 0], [0, 0, 1, 1, 0, 0]]
    assert [(r.tag, r.value) for r in columns.orderBy("outcol").collect()] == [(0, 1), (0, 2), (1, 1), (2, 1), (2, 2), (2, 3)]


def test_files(spark, lib, world, tmp_path):
    tags, ref, haplotypes, _, _ = world
    for phase in (0, 1):
        (tmp_path / f"a.{phase + 1}.fa").write_text("".join(f">{n}\n" + "\r\n".join(q[i : i + 60].upper() for i in range(0, len(q), 60)) + "\n" for n, q in haplotypes["a", phase].items()))
    (tmp_path / "ref.fasta").write_text("".join(f">{n}\n{q}\n" for n, q in ref.items()))
    (tmp_path / "tags.txt").write_text(">tags\n" + "\n".join(tags) + "\n")
    read = readers.haplotypes(readers.read_fasta(spark, str(tmp_path / "a.*.fa"))).collect()
    assert {(r.sample, r.phase, r.seqname): r.seq for r in read} == {("a", p, n): haplotypes["a", p][n] for p in (0, 1) for n in ref}
    assert [r[:] for r in readers.read_tags(spark, str(tmp_path / "tags.txt")).orderBy("tag").collect()] == list(enumerate(tags))
    kinds = {r.path.rsplit("/", 1)[1]: r.kind for r in readers.list_inputs(spark, str(tmp_path)).where("path not like '%.txt'").collect()}
    assert kinds == {"a.1.fa": "pair", "ref.fasta": "reference"}
    with pytest.raises(Exception, match="unknown kind"):
        readers.list_inputs(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="unexpected character in x at 3"):
        readers.check_fasta(spark.createDataFrame([("x", "ac gt")], "seqname string, seq string")).collect()
    assert readers.check_tags(spark.createDataFrame([(0, "aac"), (1, "aag"), (2, "aa")], "tag int, tagseq string")).first().tags == [0, 1, 2]
    bed = spark.createDataFrame([("chr1\t10\t20\tx",), ("2\tsrc\tgene\t5\t9",), ("#c",), ("3\t1",)], "value string")
    assert sorted(r[:] for r in readers.parse_regions(bed, 2).collect()) == [("1", 8, 22), ("2", 3, 12)]
    writers.write_library(str(tmp_path / "lib"), 3, calls=lib.calls, ref=lib.ref_seqs)
    assert readers.read_library(spark, str(tmp_path / "lib"), "calls").where("chunk = 1").select("tag").distinct().count() == 3
    (tmp_path / "samples.csv").write_text("Index,SampleID,CaseControl,TrainingValidation,PCA0\n0,a,1,1,0.5\n1,b,,,-1\n")
    samples = readers.read_samples(spark, str(tmp_path / "samples.csv"))
    assert [r[:] for r in samples.orderBy("idx").collect()] == [(0, "a", 1, 1, [0.5]), (1, "b", None, None, [-1.0])]
    assert readers.check_samples(samples).count() == 0 and readers.check_samples(samples.where("idx = 1")).count() == 1
    assert [r.value for r in writers.sample_lines(samples, 1).orderBy("idx").collect()] == ["0,a,1,1,0.500000", "1,b,,,-1.000000"]
    rows = matrix.dense_rows(matrix.matrix_cells(lib.calls, workflows.ranked_variants(lib)), matrix.output_columns(lib.ref_tiles))
    array = writers.matrix_of(rows)
    assert array.shape == (2, 16) and np.load(__import__("io").BytesIO(writers.npy_bytes(array))).tolist() == array.tolist()
    flat = {r.sample: r.variants for r in tiling.flatten_haplotypes(library.renumber(lib.calls, workflows.ranked_variants(lib))).collect()}
    assert len(flat["a"]) == 16


def test_filters_on_the_study(lib):
    assert filters.hide_no_calls(lib.variants.select("tag", F.coalesce("seq", F.lit("nn")).alias("seq"))).where("seq is null").count() == lib.variants.where("seq is null").count()
    pairs = lib.variants.where("seq is not null").select("seq", F.lit("acgt").alias("other"))
    assert filters.size_guard(pairs, "seq", "other", most_apart=10).count() == 0
    notes = workflows.tile_matrix(lib)[1]
    hashed = annotate.hashed_annotations(notes, workflows.ranked_variants(lib)).collect()
    assert len(hashed) == 3 and all(len(r.hash) == 13 for r in hashed)


def test_streaming_ingest(spark, world, tmp_path):
    tags, _, haplotypes, _, _ = world
    t = spark.createDataFrame(list(enumerate(tags)), "tag int, tagseq string")
    schema = "sample string, phase int, seqname string, seq string"
    source = str(tmp_path / "in")
    for s in ("a", "b"):
        spark.createDataFrame([(s, p, n, q) for p in (0, 1) for n, q in haplotypes[s, p].items()], schema).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest(ingest.stream_contigs(spark, source, schema), t, str(tmp_path / "lib"), str(tmp_path / "check"), K).awaitTermination()
    whole = spark.createDataFrame([(s, p, n, q) for (s, p), seqs in haplotypes.items() for n, q in seqs.items()], schema)
    tiles, _ = tiling.tile_contigs(whole, t, K)
    a, b = tiling.calls_of(tiles), ingest.calls(spark, str(tmp_path / "lib"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert ingest.variants(spark, str(tmp_path / "lib")).count() == tiling.variants_of(tiles).count()
