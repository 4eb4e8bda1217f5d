"""Association of tile variants with a case/control status."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions.statistics import chi2_pvalue_udf, chi2_statistic, likelihood_ratio_pvalue, log_likelihood, standardized

#: Samples that are broadcast; a model of more than these isn't fitted.
MOST_SAMPLES = 1_000_000


def frequencies(carriers: DataFrame, n: int, counted: Column | None = None) -> DataFrame:
    """(tag, variant, maf): (2 hom + het) / 2n over the counted samples."""
    rows = carriers if counted is None else carriers.where(counted)
    return rows.groupBy("tag", "variant").agg((F.sum(F.when(F.col("hom"), 2).otherwise(1)) / (2 * n)).alias("maf"))


def frequency_band(columns: DataFrame, low: float = 0.01, high: float = 1.0) -> DataFrame:
    """Columns with maf in [low, high]; hom and het share their variant's."""
    return columns.where(F.col("maf").between(low, high))


def chi2_scan(carriers: DataFrame, samples: DataFrame, low: float = 0.01, high: float = 1.0, include_first: bool = False) -> DataFrame:
    """(tag, variant, hom, maf, a, b, statistic) of every hom and het column in the frequency band.

    ``samples`` (sample, is_case, is_training) is small beside the carriers; training samples count.
    Columns are filtered by frequency before anything is tested.
    """
    training = samples.where("is_training")
    n, cases = training.agg(F.count("*"), F.count_if("is_case")).first()
    rows = carriers.join(F.broadcast(training.select("sample", "is_case")) if n <= MOST_SAMPLES else training.select("sample", "is_case"), "sample")
    several = carriers.groupBy("tag").agg(F.max("variant").alias("m")).where("m >= 2").select("tag")
    rows = rows.join(several, "tag", "left_semi")
    if not include_first:
        rows = rows.where("variant > 1")
    counts = rows.groupBy("tag", "variant", "hom").agg(F.count_if("is_case").alias("a"), F.count_if(~F.col("is_case")).alias("b"))
    banded = counts.join(frequency_band(frequencies(rows, n), low, high), ["tag", "variant"])
    return banded.withColumn("statistic", chi2_statistic(F.col("a"), F.col("b"), F.lit(cases), F.lit(n - cases)))


def with_pvalue(scan: DataFrame, below: float = 1.0) -> DataFrame:
    """Columns with p under ``below``; all of them if that is 1 or more."""
    out = scan.withColumn("pvalue", chi2_pvalue_udf("statistic"))
    return out if below >= 1 else out.where((F.col("pvalue") < below) & ~F.isnan("pvalue"))


def with_pvalue_at_most(scan: DataFrame, most: float = 1.0) -> DataFrame:
    """As exports filter: columns with p over ``most`` go."""
    out = scan.withColumn("pvalue", chi2_pvalue_udf("statistic"))
    return out if most >= 1 else out.where(F.col("pvalue") <= most)


def hgvs_filter(cells: DataFrame, samples: DataFrame, alpha: float, least_called: int) -> DataFrame:
    """HGVS ids with enough called training samples, and with p of hom or het at most ``alpha``."""
    training = samples.where("is_training").select("sample", "is_case")
    n, cases = training.agg(F.count("*"), F.count_if("is_case")).first()
    rows = cells.join(F.broadcast(training) if n <= MOST_SAMPLES else training, "sample")

    def both(name):
        return [F.count_if((F.col(name) == 1) & F.col("is_case")).alias(f"{name}_a"), F.count_if((F.col(name) == 1) & ~F.col("is_case")).alias(f"{name}_b")]

    counts = rows.groupBy("hgvs").agg(F.count_if(F.col("hom") >= 0).alias("called"), *both("hom"), *both("het")).where(F.col("called") >= least_called)
    for name in ("hom", "het"):
        counts = counts.withColumn(f"p_{name}", chi2_pvalue_udf(chi2_statistic(F.col(f"{name}_a"), F.col(f"{name}_b"), F.lit(cases), F.lit(n - cases))))
    return counts.where((F.col("p_hom") <= alpha) | (F.col("p_het") <= alpha))


def glm_scan(carriers: DataFrame, samples: DataFrame, low: float = 0.01, high: float = 1.0) -> DataFrame:
    """(tag, variant, hom, pvalue): likelihood ratio of a logistic model of cases with the column and without.

    ``samples`` (sample, is_case, is_training, pca) is collected: it has a row for each genome, which is small
    beside the carriers (more than MOST_SAMPLES are refused). The model without a column is fitted once. A column is
    the array of its carriers.
    """
    if samples.limit(MOST_SAMPLES + 1).count() > MOST_SAMPLES:
        raise ValueError(f"there are more than {MOST_SAMPLES} samples")
    own = samples.where("is_training").orderBy("sample").toPandas()
    y = own["is_case"].to_numpy(float)
    covariates = np.array(own["pca"].tolist(), float).reshape(len(own), -1)
    base = np.column_stack([np.ones(len(y)), standardized(covariates)]) if covariates.size else np.ones((len(y), 1))
    null = log_likelihood(base, y)
    place = {s: k for k, s in enumerate(own["sample"].tolist())}
    rows = carriers.join(F.broadcast(samples.where("is_training").select("sample")), "sample", "left_semi")
    banded = frequency_band(frequencies(rows, len(own)), low, high)
    columns = rows.join(banded, ["tag", "variant"], "left_semi").groupBy("tag", "variant", "hom").agg(F.collect_list("sample").alias("carried"))

    @F.pandas_udf("double")
    def test(carried: pd.Series) -> pd.Series:
        out = []
        for names in carried:
            x = np.zeros(len(y))
            x[[place[s] for s in names]] = 1
            out.append(likelihood_ratio_pvalue(x, covariates, y, null))
        return pd.Series(out, dtype=float)

    return columns.select("tag", "variant", "hom", test("carried").alias("pvalue"))


def descriptors(columns: DataFrame) -> DataFrame:
    """Whole millionths of p, -log10 p and maf beside tag, variant and hom (1) or het (0)."""
    million = F.lit(1_000_000)
    return columns.select("tag", "variant", F.col("hom").cast("int").alias("hom"), (F.col("pvalue") * million).cast("int").alias("p"), (-F.log10("pvalue") * million).cast("int").alias("log_p"), (F.col("maf") * million).cast("int").alias("maf"))


def manhattan_points(columns: DataFrame, places: DataFrame, threshold: float = 0.0) -> DataFrame:
    """(seqname, pos, tag, variant, hom, statistic...) in the order of a Manhattan plot.

    Chromosomes with numbers come first, by number; then those with letters.
    """
    name = F.regexp_replace("seqname", "^chr", "")
    letters = name.rlike("[A-Za-z]")
    both = columns.join(places.select("tag", "seqname", "pos"), "tag").withColumn("_letters", letters).withColumn("_key", F.lpad(name, 2, "0"))
    if threshold:
        both = both.where(-F.log10("pvalue") >= threshold)
    return both.orderBy("_letters", "_key", "pos", "tag", "variant", "hom").drop("_letters", "_key")
