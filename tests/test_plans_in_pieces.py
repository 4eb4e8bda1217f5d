"""Operators that work by bins, chunks and squares against plain loops over the whole."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import annotate, intervals, pca, tiling, variants
from tesserae.plans import workflows
from test_study import dna

SPANS = "seqname string, start long, end long"


def called_one_by_one(blocks, unreported):
    """Called regions of sorted blocks of one sequence, read in order; regions that touch are one."""
    out, end, opened = [], None, None
    for a, b, now in blocks:
        if end is None:
            end, opened = b, a if now else None
            continue
        if a < end:
            if opened is not None and now:
                end = max(end, b)
            continue
        if a > end and unreported and opened is None:
            opened = end
        elif a > end and not unreported and opened is not None:
            out.append((opened, end))
            opened = None
        if now:
            opened = a if opened is None else opened
        elif opened is not None:
            out.append((opened, a))
            opened = None
        end = b
    if opened is not None:
        out.append((opened, end))
    joined = []
    for a, b in out:
        if joined and joined[-1][1] == a:
            joined[-1] = (joined[-1][0], b)
        else:
            joined.append((a, b))
    return joined


def test_regions_by_bins(spark):
    rng = random.Random(1)
    rows = []
    for name in "xy":
        at = 0
        for _ in range(60):
            at += rng.choice([0, 1, 2, 5, 30])
            rows.append((name, at, at + rng.choice([1, 2, 6, 40]), rng.random() < 0.5))
    rows = list(dict.fromkeys(rows))
    frame = spark.createDataFrame(rows, SPANS + ", called boolean").repartition(3)
    for unreported in (False, True):
        expected = []
        for name in "xy":
            own = sorted(((a, b, c) for s, a, b, c in rows if s == name), key=lambda r: (r[0], r[1], not r[2]))
            expected += [(name, a, b) for a, b in called_one_by_one(own, unreported)]
        for width in (7, 1 << 14):
            assert sorted(r[:] for r in intervals.called_regions(frame, unreported, width).collect()) == sorted(expected)
    plain = frame.select("seqname", "start", "end")
    whole = sorted(r[:] for r in intervals.merge(plain).collect())
    assert sorted(r[:] for r in intervals.merge(plain, 5).collect()) == whole
    sizes = spark.createDataFrame([("x", 3000), ("y", 3000)], "seqname string, size long")
    assert sorted(r[:] for r in intervals.complement(plain, sizes, 5).collect()) == sorted(r[:] for r in intervals.complement(plain, sizes).collect())
    kept, reach = [], {}
    for s, a, b, c in sorted(rows):
        if a >= reach.get(s, 0):
            kept.append((s, a, b))
            reach[s] = b
    named = plain.dropDuplicates().withColumnRenamed("seqname", "chrom")
    assert sorted(r[:] for r in intervals.drop_overlapping(named, "chrom").select("chrom", "start", "end").collect()) == sorted(set(kept))


def scanned(seq, tags, k):
    out, at = [], 0
    while at + k <= len(seq):
        tag = tags.get(seq[at : at + k])
        if tag is None:
            at += 1
        else:
            out.append((tag, at))
            at += k
    return out


def test_scan_by_numbers():
    rng = random.Random(4)
    for k in (1, 3, 6, 31):
        tags = {dna(rng, k): n for n in range(4 ** min(k, 3))}
        index = tiling.tag_index([*((t.upper(), n) for t, n in tags.items()), ("n" * k, 99), ("a" * (k + 1), 98)], k)
        for n in (0, k - 1, k, 500):
            seq = "".join(rng.choice("acgtacgtacgtn") for _ in range(n))
            for t in rng.sample(sorted(tags), 2):
                at = rng.randrange(n + 1)
                seq = seq[:at] + t + seq[at:]
            for piece in (1, 7, 1 << 20):
                assert tiling.scan(seq, index, k, piece) == scanned(seq, tags, k)
    assert tiling.scan("acgt", tiling.tag_index([], 2), 2) == []


def test_tags_by_a_join(spark):
    """More tags than a task may hold: the same tiles and counts."""
    rng = random.Random(5)
    tags = spark.createDataFrame([(n, t) for n, t in enumerate({dna(rng, 4) for _ in range(40)})], "tag int, tagseq string")
    contigs = [("s", p, f"c{c}", "".join(rng.choice("acgtACGTn") for _ in range(400))) for p in (0, 1) for c in range(3)] + [("s", 0, "short", "ac"), ("s", 0, "none", None)]
    frame = spark.createDataFrame(contigs, "sample string, phase int, seqname string, seq string").repartition(3)
    for options in ({}, {"keep_duplicates": True}, {"skip_out_of_order": True}):
        direct, joined = tiling.tile_contigs(frame, tags, 4, **options), tiling.tile_contigs(frame, tags, 4, **options, most_tags=10)
        for a, b in zip(direct, joined):
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
        assert direct[0].count() > 0


def test_stretches_of_the_reference(spark):
    rng = random.Random(6)
    seqs = {"x": dna(rng, 1000), "y": dna(rng, 37), "empty": ""}
    ref = spark.createDataFrame(list(seqs.items()), "seqname string, seq string")
    wanted = {(n, a := rng.randrange(len(seqs[n])), rng.randint(a + 1, len(seqs[n]))) for n in "xy" for _ in range(30)}
    for chunk in (10, 1 << 16):
        got = annotate.reference_stretches(spark.createDataFrame(sorted(wanted), SPANS), ref, chunk).collect()
        assert {(r.seqname, r.start, r.end): r.seq for r in got} == {(n, a, b): seqs[n][a:b] for n, a, b in wanted}


def test_gram_by_squares(spark):
    x = (np.random.default_rng(3).random((23, 70)) < 0.3).astype(float)
    ones = spark.createDataFrame([(int(r), int(c)) for r, c in zip(*np.nonzero(x))], "row long, col long").repartition(4)
    for side, block in ((5, 3), (23, 4096), (100, 10)):
        assert (pca.gram_matrix(ones, 23, block, side) == x @ x.T).all()


def test_masks_of_many_samples(spark):
    """Each of three samples is masked by its own calls."""
    ref = spark.createDataFrame([("c", "a" * 12), ("d", "g" * 4)], "seqname string, seq string")
    line = "c\t%d\t.\tA\tG\t30\tPASS\t.\tGT:GQ\t1/1:9"
    lines = spark.createDataFrame([(f"s{k}", line % (2 * k + 1)) for k in range(3)], "sample_id string, value string")
    from tesserae.sources.readers import parse_vcf

    got = {(r.sample, r.seqname, r.phase): r.seq for r in workflows.haplotypes_from_gvcf(ref, parse_vcf(lines, "sample_id")).collect()}
    for k in range(3):
        for phase in (0, 1):
            assert got[f"s{k}", "c", phase] == "n" * (2 * k) + "G" + "n" * (11 - 2 * k) and got[f"s{k}", "d", phase] == "nnnn"
    hidden = spark.createDataFrame([("s", "c", 1, 4), ("s", "c", 3, 6), ("s", "c", 10, 99)], "sample_id string, seqname string, start long, end long")
    records = spark.createDataFrame([("s", "c", 3, "A", "T", "0/1")], "sample_id string, chrom string, pos long, ref string, alt string, gt string")
    masked = {r.phase: r.seq for r in variants.consensus(ref.where("seqname = 'c'"), records, hidden).collect()}
    assert masked == {0: "annnnnaaaann", 1: "anTnnnaaaann"}


def test_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tesserae.session import shared_root

    conf = SimpleNamespace(get=lambda name, default=None: default)
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        session = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, applicationId="none", master=master), conf=conf)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session)
