"""Functions without tables: diffs, subsequences, statistics, notation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.functions import hgvs, sequences
from tesserae.functions.diff import align, variants
from tesserae.functions.statistics import chi2_pvalue, likelihood_ratio_pvalue, log_likelihood
from tesserae.operators.tiling import longest_increasing, scan


def notation(position, ref, new):
    end = position + len(ref) - 1
    if not new:
        return f"{position}del" if len(ref) == 1 else f"{position}_{end}del"
    if len(ref) == 1 == len(new):
        return f"{position}{ref}>{new}"
    if not ref:
        return f"{position - 1}_{position}ins{new}"
    return f"{position}delins{new}" if len(ref) == 1 else f"{position}_{end}delins{new}"


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("CCCCCCCC", "CCCCTCCC", "5C>T"),
        ("TTTTGACACTTT", "TTTTGCACTTT", "6del"),
        ("GGTTA", "GGTT", "5del"),
        ("CC", "CCGTT", "2_3insGTT"),
        ("CCGGAATT", "CCTTAATT", "3G>T 4G>T"),
        ("ACCCCCCA", "ATTTCCCA", "2_4delinsTTT"),
        ("GATTTTTTACG", "GACCTTTTTACG", "3delinsCC"),
        ("GATTTTTACG", "GACTTTACG", "3_4delinsC"),
        ("GCACACTT", "GCACTT", "2_3del"),
        ("GCACTT", "GCACACTT", "1_2insCA"),
        ("CTAGGACTTC", "CTAAGCCTTC", "4G>A 6A>C"),
        ("CTAGGACTTC", "CTAAGCGCTTC", "4G>A 6delinsCG"),
        ("ACGT", "ACGT", ""),
        ("", "", ""),
        ("", "AC", "0_1insAC"),
    ],
)
def test_diff(a, b, expected):
    assert " ".join(notation(p, r, n) for p, r, n, _ in variants(a, b)) == expected


def test_diff_rebuilds_the_sequence():
    rng = random.Random(1)
    for _ in range(1500):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k = rng.randint(0, len(b))
            what = rng.random()
            if what < 0.4:
                b[k:k] = rng.choice("ACGT") * rng.randint(1, 3)
            elif what < 0.7:
                del b[k : k + rng.randint(1, 3)]
            elif k < len(b):
                b[k] = rng.choice("ACGT")
        b, out = "".join(b), a
        for p, ref, new, left in reversed(variants(a, b)):
            assert out[p - 1 : p - 1 + len(ref)] == ref and left == a[p - 2 : p - 1] * (p > 1)
            out = out[: p - 1] + new + out[p - 1 + len(ref) :]
        assert out == b


def test_alignment_costs_least():
    rng = random.Random(2)

    def slow(a, b):
        inf = 10**9
        m = [[[inf] * 3 for _ in range(len(b) + 1)] for _ in range(len(a) + 1)]
        m[0][0][0] = 0
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                if j:
                    m[i][j][1] = min(m[i][j - 1][0] + 4, m[i][j - 1][1] + 1)
                if i:
                    m[i][j][2] = min(m[i - 1][j][0] + 4, m[i - 1][j][2] + 1)
                if i and j:
                    m[i][j][0] = m[i - 1][j - 1][0] + 2 * (a[i - 1] != b[j - 1])
                m[i][j][0] = min(m[i][j])
        return m[-1][-1][0]

    for _ in range(400):
        a, b = ("".join(rng.choice("AC") for _ in range(rng.randint(1, 9))) for _ in range(2))
        cost = sum({"=": 0, "X": 2 * k, "I": 3 + k, "D": 3 + k}[op] for op, k in align(a, b))
        assert cost == slow(a, b)


@pytest.mark.parametrize("values, kept", [([], []), ([5], [0]), ([1, 2, 2, 4], [0, 2, 3]), ([1, 3, 2, 4], [0, 2, 3]), ([4, 3, 2, 1], [3]), ([0, 1, 9, 2, 3], [0, 1, 3, 4])])
def test_longest_increasing(values, kept):
    assert longest_increasing(values) == kept


def test_scan_clears_its_window():
    tags = {"acg": 0, "cgt": 1, "ttt": 2}
    assert scan("acgt", tags, 3) == [(0, 0)]
    assert scan("anacgncgt", tags, 3) == [(0, 2), (1, 6)]
    assert scan("tttttt", tags, 3) == [(2, 0), (2, 3)]
    assert scan("ttnttt", tags, 3) == [(2, 3)]
    assert scan("", tags, 3) == []


def test_chi2():
    def p(a, b, cases, controls):
        m, n = a + b, cases + controls
        e1, e2 = m * cases / n, m * controls / n
        return chi2_pvalue((a - e1) ** 2 / e1 + (b - e2) ** 2 / e2)

    assert p(25, 6, 34, 20) == pytest.approx(0.04147853, abs=1e-7)
    assert p(2, 0, 2, 2) == pytest.approx(0.157299, abs=1e-6)
    assert chi2_pvalue(None) == 1.0


def test_glm():
    rng = np.random.default_rng(1)
    y = (rng.random(200) < 0.5).astype(float)
    x = np.column_stack([np.ones(200), rng.normal(size=200)])
    best = log_likelihood(x, y)
    # no small step improves it
    fits = [np.sum(y * (x @ b) - np.logaddexp(0, x @ b)) for b in rng.normal(scale=0.3, size=(300, 2))]
    assert best >= max(fits)
    assert math.isnan(log_likelihood(np.column_stack([x, x[:, 1]]), y))
    strong = likelihood_ratio_pvalue((y + (rng.random(200) < 0.05)) % 2, x[:, 1:], y)
    weak = likelihood_ratio_pvalue((rng.random(200) < 0.5).astype(float), x[:, 1:], y)
    assert strong < 1e-20 < weak
    assert math.isnan(likelihood_ratio_pvalue(np.ones(200), x[:, 1:], y))


def test_notation_columns(spark):
    rows = [(5, "", "", "5="), (5, "A", "A", "5="), (5, "AC", "AC", "5_6="), (5, "A", "", "5del"), (5, "AC", "", "5_6del"), (5, "A", "C", "5A>C"), (5, "", "GG", "4_5insGG"), (5, "A", "GG", "5delinsGG"), (5, "AC", "G", "5_6delinsG")]
    frame = spark.createDataFrame(rows, "position long, ref string, new string, expected string")
    assert frame.where(hgvs.format_variant(F.col("position"), F.col("ref"), F.col("new")) != F.col("expected")).count() == 0


def test_sequence_columns(spark):
    frame = spark.createDataFrame([("acgt",), ("tttt",), ("ACGN",), (None,)], "s string")
    got = frame.select(sequences.two_bit(F.col("s"), 4).alias("n"), sequences.is_known(F.col("s")).alias("k"), sequences.count_bases(F.col("s")).alias("b"), sequences.blake2b_hex("s").alias("h")).collect()
    assert [(r.n, r.k, r.b) for r in got] == [(27, True, 4), (255, True, 4), (None, False, 3), (None, None, None)]
    import hashlib

    assert got[0].h == hashlib.blake2b(b"acgt", digest_size=32).hexdigest() and got[3].h is None
    names = spark.createDataFrame([("a/b/x,y.1.fa.gz", "x-y"), ("z.fasta", "z"), ("q.vcf.gz", "q"), ("r.2.fasta", "r")], "p string, e string")
    assert names.where(sequences.trim_label(F.col("p")) != F.col("e")).count() == 0
    order = spark.createDataFrame([("chrX",), ("chr10",), ("chr2",)], "c string").orderBy(*sequences.chromosome_order(F.col("c")))
    assert [r.c for r in order.collect()] == ["chr2", "chr10", "chrX"]
