"""Principal components of genomes from sparse one-hot columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram_counts(ones: DataFrame) -> DataFrame:
    """(a, b, n): columns that samples a <= b share, from (row, col). The pairs are those of one column's carriers."""
    x = ones.select(F.col("row").alias("a"), "col")
    y = ones.select(F.col("row").alias("b"), "col")
    return x.join(y, "col").where("a <= b").groupBy("a", "b").agg(F.count("*").alias("n"))


def gram_matrix(ones: DataFrame, n_samples: int, block: int = 4096, side: int = 1024) -> np.ndarray:
    """Counts of shared columns, samples by samples, on the driver (n_samples squared numbers).

    Each task turns its columns into dense matrices and adds up their products, so carriers of a column are
    never paired as rows. The sums are cut into squares of ``side`` samples, half of them by symmetry, which Spark adds up
    over tasks; the driver gets each square once.
    """
    cuts = range(0, n_samples, side)

    def run(batches):
        total = {(a, b): np.zeros((min(side, n_samples - a), min(side, n_samples - b))) for a in cuts for b in cuts if a <= b}
        touched = set()
        for pdf in batches:
            carried = pdf["rows"].tolist()
            for at in range(0, len(carried), block):
                rows = carried[at : at + block]
                x = np.zeros((n_samples, len(rows)), np.float32)
                for k, r in enumerate(rows):
                    x[r, k] = 1
                for a, b in total:
                    total[a, b] += x[a : a + side] @ x[b : b + side].T
                touched.update(total)
        for a, b in sorted(touched):
            yield pd.DataFrame({"a": [a], "b": [b], "part": [total.pop((a, b)).tobytes()]})

    def add(batches):
        key, total = None, None
        for pdf in batches:
            for a, b, part in zip(pdf["a"], pdf["b"], pdf["part"]):
                if (a, b) != key:
                    if key:
                        yield pd.DataFrame({"a": [key[0]], "b": [key[1]], "part": [total.tobytes()]})
                    key, total = (a, b), np.frombuffer(part, np.float64).copy()
                else:
                    total += np.frombuffer(part, np.float64)
        if key:
            yield pd.DataFrame({"a": [key[0]], "b": [key[1]], "part": [total.tobytes()]})

    columns = ones.groupBy("col").agg(F.collect_list("row").alias("rows"))
    kind = "a int, b int, part binary"
    parts = columns.mapInPandas(run, kind).repartition("a", "b").sortWithinPartitions("a", "b").mapInPandas(add, kind)
    total = np.zeros((n_samples, n_samples))
    for row in parts.toLocalIterator():
        square = np.frombuffer(row.part, np.float64).reshape(min(side, n_samples - row.a), -1)
        total[row.a : row.a + side, row.b : row.b + side] = square
        total[row.b : row.b + side, row.a : row.a + side] = square.T
    return total


def principal_components(gram: np.ndarray, training: np.ndarray, k: int) -> np.ndarray:
    """Scores of all samples on the first ``k`` components of the training samples.

    ``gram`` are inner products; columns are centred at the training mean. A component's sign makes its
    largest score positive.
    """
    t = np.flatnonzero(training)
    mean = gram[:, t].mean(axis=1)
    centred = gram - mean[:, None] - mean[None, :] + gram[np.ix_(t, t)].mean()
    values, vectors = np.linalg.eigh(centred[np.ix_(t, t)])
    order = np.argsort(-values)[:k]
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    scale = np.where(values > 1e-9, 1 / np.sqrt(np.maximum(values, 1e-300)), 0)
    scores = centred[:, t] @ (vectors * scale)
    largest = np.abs(scores).argmax(axis=0)
    return scores * np.where(scores[largest, np.arange(scores.shape[1])] < 0, -1, 1)


def pca(ones: DataFrame, samples: DataFrame, k: int = 4) -> DataFrame:
    """``samples`` (idx, is_training, ...) with pca: scores on ``k`` components of the one-hot matrix (row, col)."""
    own = samples.select("idx", "is_training").orderBy("idx").toPandas()  # a row for each genome
    scores = principal_components(gram_matrix(ones, len(own)), own["is_training"].to_numpy(bool), k)
    rows = [(int(i), [float(v) for v in s]) for i, s in zip(own["idx"], scores)]
    made = samples.sparkSession.createDataFrame(rows, "idx long, pca array<double>")
    return samples.join(F.broadcast(made), "idx")


def plot_points(samples: DataFrame, x: int = 1, y: int = 2, category: str | None = None) -> DataFrame:
    """(sample, x, y, category) of a scatter of two components, counted from 1."""
    return samples.select("sample", F.element_at("pca", x).alias("x"), F.element_at("pca", y).alias("y"), (F.col(category) if category else F.lit(None).cast("string")).alias("category"))
