"""What commands make of filters, several libraries and VCF files, and their .npy files read back."""

import glob
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.commands import load
from test_commands import files, run  # noqa: F401


@pytest.fixture(scope="module")
def lib(spark, files):
    root, _ = files
    run(spark, "import", inputs=f"{root}/in/*.fa", tag_library=root / "tags.txt", ref=root / "ref.fa", output=root / "lib2")
    return root / "lib2"


def tags_of(spark, path):
    return {r.tag for r in load(spark, str(path)).calls.select("tag").distinct().collect()}


def test_the_two_filters(spark, files, lib):
    """``filter`` goes by variant numbers and int(2 * share * genomes) calls, the others by alleles and one call more."""
    root, _ = files
    own = load(spark, str(lib))
    kinds = {r.tag: r.n for r in own.calls.groupBy("tag").agg(F.countDistinct("hash").alias("n")).collect()}
    assert sorted(kinds.values())[-1] == 2
    run(spark, "filter", inputs=lib, output=root / "f1", max_variants=1)
    run(spark, "flake", inputs=lib, output=root / "f2", max_variants=1)
    assert tags_of(spark, root / "f1") == tags_of(spark, root / "f2") == {t for t, n in kinds.items() if n == 1}
    # all 8 calls are there: int(1.0 * 4 * 2) of them do for one, int(2 * 1.0 * 4 + 1) are too many for the other
    run(spark, "filter", inputs=lib, output=root / "f3", min_coverage=1.0)
    run(spark, "flake", inputs=lib, output=root / "f4", min_coverage=1.0)
    assert tags_of(spark, root / "f3") == set(kinds) and tags_of(spark, root / "f4") == set()
    # a variant that one genome has alone is number 2 of the tag for the whole library
    one = root / "one"
    run(spark, "filter", inputs=lib, output=one, match_genome="^a$")
    assert {r.sample for r in load(spark, str(one)).calls.collect()} == {"a"}


def test_several_libraries(spark, files, lib):
    root, _ = files
    for name in "ab":
        run(spark, "filter", inputs=lib, output=root / f"part-{name}", match_genome=f"^{name}$")
    run(spark, "slice", inputs=f"{root}/part-a,{root}/part-b", output=root / "both", tags_per_file=2)
    both = load(spark, str(root / "both"))
    assert {r.sample for r in both.calls.select("sample").distinct().collect()} == {"a", "b"}
    assert sorted(glob.glob(f"{root}/both/calls/chunk=*")) == [f"{root}/both/calls/chunk={k}" for k in range(3)]
    broken = load(spark, str(root / "part-b"))
    broken.variants = broken.variants.where("tag <> 1")
    from tesserae.commands import save

    save(broken, str(root / "broken"))
    with pytest.raises(ValueError, match="calls without a variant"):
        run(spark, "merge", inputs=f"{root}/broken,{root}/broken", output=root / "never")


def test_vcf_import(spark, files):
    """A VCF beside FASTA pairs: its variant is put into the reference, and both kinds meet in one library."""
    root, ref = files
    (root / "vcf").mkdir()
    (root / "vcf" / "v.vcf").write_text((root / "x.vcf").read_text())
    (root / "vcf" / "v.vcf.tbi").write_text("")
    (root / "vcf" / "a.1.fa").write_text((root / "in" / "a.1.fa").read_text())
    (root / "vcf" / "a.2.fa").write_text((root / "in" / "a.2.fa").read_text())
    run(spark, "import", inputs=root / "vcf", tag_library=root / "tags.txt", ref=root / "ref.fa", output=root / "mixed")
    own = load(spark, str(root / "mixed"))
    assert {(r.sample, r.phase) for r in own.calls.select("sample", "phase").distinct().collect()} == {(s, p) for s in "av" for p in (0, 1)}
    changed = own.calls.where("sample = 'v' and tag = 0").join(own.variants, ["tag", "hash"]).first().seq
    start = ref["chr1"][:39] + "t" + ref["chr1"][40:]
    assert start.startswith(changed) and changed != ref["chr1"][: len(changed)]
    (root / "twice.txt").write_text("acgtacgtacgtacgtacgtacgt\nacgtacgtacgtacgtacgtacgt\n")
    with pytest.raises(ValueError, match="begin alike"):
        run(spark, "import", inputs=root / "vcf", tag_library=root / "twice.txt", ref=root / "ref.fa", output=root / "never")


def test_npy_files(spark, files, lib):
    root, _ = files
    out = root / "npy"
    (root / "samples.csv").write_text("Index,SampleID,CaseControl,TrainingValidation\n0,a,1,1\n1,b,0,1\n2,c,1,1\n3,d,0,1\n")
    run(spark, "slice-numpy", inputs=lib, output=out, samples=root / "samples.csv", single_onehot=True, pca_components=2, single_hgvs_matrix=True, chunked_hgvs_matrix=True, tags_per_file=4)
    (root / "wrong.csv").write_text("Index,SampleID,CaseControl,TrainingValidation\n0,b,1,1\n1,a,0,1\n2,c,1,1\n3,d,0,1\n")
    with pytest.raises(ValueError, match="sample 0 is a in the library and b in the samples file"):
        run(spark, "slice-numpy", inputs=lib, output=root / "never", samples=root / "wrong.csv")
    cells = {(r.sample, r.tag, r.phase): r.value for r in spark.read.parquet(f"{out}/matrix").collect()}
    first, second = np.load(out / "matrix.0000.npy"), np.load(out / "matrix.0001.npy")
    assert first.dtype == np.int16 and first.shape == (4, 8) and second.shape == (4, 4)
    whole = np.hstack([first, second])
    for row, sample in enumerate("abcd"):
        assert whole[row].tolist() == [cells.get((sample, t, p), 0) for t in range(6) for p in (0, 1)]
    ones = {(r.row, r.col) for r in spark.read.parquet(f"{out}/onehot").collect()}
    hot = np.load(out / "onehot.npy")
    assert hot.dtype == np.uint32 and hot.shape == (2, len(ones)) and set(zip(*hot.tolist())) == ones and hot[1].tolist() == sorted(hot[1])
    described = np.load(out / "onehot-columns.npy")
    rows = spark.read.parquet(f"{out}/onehot-columns").collect()
    assert described.dtype == np.int32 and sorted(zip(*described.tolist())) == sorted(r[:] for r in rows)
    stats = glob.glob(f"{out}/stats/part-*")
    assert json.loads("".join(open(p).read() for p in stats))["pvalueCallCount"] == len(rows)
    assert np.load(out / "pca.npy").shape == (4, 2)
    single, labels = np.load(out / "hgvs.npy"), (out / "hgvs.annotations.csv").read_text().splitlines()
    assert [x.split(",")[0] for x in labels] == [str(k) for k in range(len(labels))] and single.shape == (4, 2 * len(labels)) and single.dtype == np.int16
    long = {(r.hgvs, r.sample, r.phase): r.value for r in spark.read.parquet(f"{out}/hgvs-single").collect()}
    for k, label in enumerate(labels):
        for row, sample in enumerate("abcd"):
            assert single[row, 2 * k : 2 * k + 2].tolist() == [long.get((label.split(",")[1], sample, p), -1) for p in (0, 1)]
    pairs = {(r.hgvs, r.sample): (r.hom, r.het) for r in spark.read.parquet(f"{out}/hgvs-chunked").collect()}
    chunk, names = np.load(out / "hgvs.chr1.npy"), (out / "hgvs.chr1.annotations.csv").read_text().splitlines()
    assert chunk.dtype == np.int8 and len(names) == 2
    for k, label in enumerate(names):
        for row, sample in enumerate("abcd"):
            assert tuple(chunk[row, 2 * k : 2 * k + 2].tolist()) == pairs[label.split(",")[1], sample]

    run(spark, "export-numpy", inputs=lib, output=root / "exported", hgvs=True, output_labels=root / "labels")
    assert np.load(root / "exported" / "matrix.0000.npy").tolist() == whole.tolist()
    present = np.load(root / "exported" / "hgvs.npy")
    assert present.shape == single.shape and ((present == 1) == (single == 1)).all() and set(present.ravel()) <= {0, 1}
    assert sorted(r.value for r in spark.read.text(str(root / "labels")).collect()) == [f'{k},"{s}",""' for k, s in enumerate("abcd")]
    run(spark, "export-numpy", inputs=lib, output=root / "exported-hot", one_hot=True)
    columns = spark.read.parquet(str(root / "exported-hot" / "columns")).collect()
    dense = np.zeros((4, len(columns)), int)
    dense[tuple(np.load(root / "exported-hot" / "onehot.npy"))] = 1
    for c in columns:
        assert dense[:, c.outcol].tolist() == [int(cells.get((s, c.tag, c.phase)) == c.value) for s in "abcd"]


def test_options(spark, files, lib):
    root, ref = files
    (root / "cases.txt").write_text("a\nc\n")
    run(spark, "export", inputs=lib, output=root / "all", output_format="hgvs-numpy")
    run(spark, "export", inputs=lib, output=root / "some", output_format="hgvs-numpy", cases=root / "cases.txt", p_value=0.2)
    everything, kept = (spark.read.csv(str(root / n), sep="\t").select("_c0").distinct().count() for n in ("all", "some"))
    assert 0 < kept <= everything
    with pytest.raises(ValueError):
        run(spark, "export", inputs=lib, output=root / "never", p_value=0.5)
    run(spark, "stats", inputs=lib, output=root / "stats2", debug_unplaced=True)
    assert not "".join(r.value for r in spark.read.text(str(root / "stats2" / "unplaced")).collect())
    (root / "p.fa").write_text(">one\nCCCC\nCCCC\n>two\nGGGGTTTT\n")
    (root / "q.fa").write_text(">one\nCCCCTCCC\n>two\nGGGG\nTATT\n")
    found = run(spark, "diff-fasta", a=root / "p.fa", b=root / "q.fa", sequence="chr2").orderBy("position").collect()
    assert [r.hgvs for r in found] == ["chr2:g.5C>T", "chr2:g.14T>A"]
