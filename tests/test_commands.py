"""Every command end to end on files of our own."""

import random

import pytest
from pyspark.sql import functions as F

from tesserae.commands import COMMANDS, load
from test_study import dna


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    rng = random.Random(11)
    tags = [dna(rng, 24) for _ in range(6)]
    ref = {f"chr{c + 1}": dna(rng, 80) + "".join(t + dna(rng, 90) for t in tags[3 * c : 3 * c + 3]) for c in (0, 1)}
    (root / "in").mkdir()
    for k, sample in enumerate("abcd"):
        for phase in (1, 2):
            seqs = dict(ref)
            if k % 2 or phase == 1:
                at = 80 + 24 + 30 + 114 * (k % 2)
                seqs["chr1"] = seqs["chr1"][:at] + {"a": "c", "c": "g", "g": "t", "t": "a"}[seqs["chr1"][at]] + seqs["chr1"][at + 1 :]
            (root / "in" / f"{sample}.{phase}.fa").write_text("".join(f">{n}\n{q}\n" for n, q in seqs.items()))
    (root / "ref.fa").write_text("".join(f">{n}\n{q}\n" for n, q in ref.items()))
    (root / "tags.txt").write_text("\n".join(tags))
    (root / "cc.tsv").write_text("SampleID\tCC\na\t1\nb\t0\nc\t1\nd\t0\n")
    (root / "x.vcf").write_text(f"##x\nchr1\t40\t.\t{ref['chr1'][39].upper()}\tT\t50\tPASS\t.\tGT:GQ\t1/1:30\n")
    return root, ref


def run(spark, name, **options):
    return COMMANDS[name](spark, **{k: str(v) if hasattr(v, "joinpath") else v for k, v in options.items()})


def test_commands(spark, files):
    root, ref = files
    lib = root / "lib"
    run(spark, "import", inputs=f"{root}/in/*.fa", tag_library=root / "tags.txt", ref=root / "ref.fa", output=lib)
    own = load(spark, str(lib))
    assert own.calls.select("sample").distinct().count() == 4 and own.ref_tiles.count() == 6

    run(spark, "slice", inputs=lib, output=root / "sliced", tags_per_file=2)
    assert load(spark, str(root / "sliced")).calls.exceptAll(own.calls).count() == 0
    run(spark, "merge", inputs=f"{lib},{lib}", output=root / "merged")
    assert load(spark, str(root / "merged")).variants.count() == own.variants.count()
    run(spark, "filter", inputs=lib, output=root / "filtered", max_tag=3, match_genome="[ab]")
    assert load(spark, str(root / "filtered")).calls.agg(F.max("tag"), F.countDistinct("sample")).first()[:] == (2, 2)
    run(spark, "flake", inputs=lib, output=root / "flaked", match_genome="a")
    assert load(spark, str(root / "flaked")).variants.count() == 7

    run(spark, "stats", inputs=lib, output=root / "stats")
    assert spark.read.json(str(root / "stats" / "totals")).first()[:] == (4, 6, own.variants.count())
    assert {r.entity: r.n for r in run(spark, "dumpgob", inputs=lib).collect()}["tags"] == 6
    run(spark, "dump", inputs=lib, output=root / "dump", tags="0,1")
    assert len(spark.read.csv(str(root / "dump")).collect()) == 4
    run(spark, "tiling-stats", inputs=lib, output=root / "bed")
    lines = sorted(r.value for r in spark.read.text(str(root / "bed")).collect())
    assert len(lines) == 6 and lines[0].startswith("chr1 0 ")
    run(spark, "annotate", inputs=lib, output=root / "annotated")
    assert len(spark.read.csv(str(root / "annotated")).collect()) == 2
    for fmt in ("hgvs", "vcf", "pvcf", "hgvs-onehot", "hgvs-numpy"):
        run(spark, "export", inputs=lib, output=root / f"export-{fmt}", output_format=fmt, output_bed=f"{root}/bed-{fmt}", output_labels=f"{root}/labels-{fmt}")
        assert spark.read.csv(str(root / f"export-{fmt}"), sep="\t").count() in (2, 8)
    run(spark, "export-numpy", inputs=lib, output=root / "numpy", one_hot=True, output_annotations=f"{root}/notes")
    assert spark.read.parquet(str(root / "numpy" / "cells")).count() == 48
    run(spark, "anno2vcf", inputs=root / "notes", output=root / "annovcf")
    assert len(spark.read.text(str(root / "annovcf")).collect()) == 2
    run(spark, "numpy-comvar", inputs=lib, output=root / "common", min_frequency=0.1, max_frequency=0.6)
    assert len(spark.read.csv(str(root / "common")).collect()) == 3

    run(spark, "choose-samples", inputs=lib, output=root / "samples", case_control_file=root / "cc.tsv", case_control_column="CC", training_set_size=1.0)
    rows = spark.read.csv(str(root / "samples"), header=True).orderBy("Index").collect()
    assert [(r.SampleID, r.CaseControl, r.TrainingValidation) for r in rows] == [("a", "1", "1"), ("b", "0", "1"), ("c", "1", "1"), ("d", "0", "1")]
    run(spark, "slice-numpy", inputs=lib, output=root / "study", samples=root / "samples", single_onehot=True, pca_components=2, single_hgvs_matrix=True, chunked_hgvs_matrix=True)
    columns = spark.read.parquet(str(root / "study" / "onehot-columns")).collect()
    assert {(r.tag, r.hom) for r in columns} == {(0, 0), (1, 1)} and {r.p for r in columns} == {157299}
    assert spark.read.parquet(str(root / "study" / "matrix")).count() == 48
    with pytest.raises(ValueError):
        run(spark, "slice-numpy", inputs=lib, output=root / "none", case_control_only=True)
    points = run(spark, "plot", inputs=root / "study" / "pca", phenotype=root / "cc.tsv").collect()
    assert {(r.sample, r.category) for r in points} == {("a", "1"), ("b", "0"), ("c", "1"), ("d", "0")}
    assert run(spark, "manhattan-plot", inputs=root / "study" / "onehot-columns", library_path=lib).count() == 2

    run(spark, "ref2genome", ref=root / "ref.fa", output=root / "sizes")
    assert sorted(r.value for r in spark.read.text(str(root / "sizes")).collect()) == [f"chr1\t{len(ref['chr1'])}", f"chr2\t{len(ref['chr2'])}"]
    run(spark, "vcf2fasta", ref=root / "ref.fa", genome=root / "x.vcf", sample="s", output=root / "fasta")
    assert len(spark.read.text(str(root / "fasta")).collect()) == 8
    run(spark, "gvcf-regions", gvcf=root / "x.vcf", output=root / "called")
    assert [r.value for r in spark.read.text(str(root / "called")).collect()] == ["chr1\t39\t40"]
    (root / "a.fa").write_text(">x\nCCCCCCCC\n")
    (root / "b.fa").write_text(">x\nCCCCTCCC\n")
    assert [r.hgvs for r in run(spark, "diff-fasta", a=root / "a.fa", b=root / "b.fa", offset=1000, sequence="chr2").collect()] == ["chr2:g.1005C>T"]
    assert len(COMMANDS) == 23
