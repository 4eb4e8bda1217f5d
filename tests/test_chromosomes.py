import pytest

from tesserae.operators import variants


def test_match_by_chromosome_refuses_what_it_would_cut(spark):
    files = spark.createDataFrame([("d/chr7.vcf",), ("d/chr10000.vcf",)], "path string")
    chromosomes = spark.range(10_001).selectExpr("concat('chr', id) AS chrom")
    assert variants.match_by_chromosome(chromosomes.where("chrom <> 'chr0'"), files).count() == 2
    with pytest.raises(ValueError):
        variants.match_by_chromosome(chromosomes, files)
