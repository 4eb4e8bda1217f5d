"""Adding samples to a library as their contigs arrive.

Safe in small steps because a tile variant is known by (tag, hash): numbers are ranks, made when a matrix is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesserae.operators import tiling


def stream_contigs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Contigs (file, sample, phase, seqname, seq) from Parquet files that appear below ``path``."""
    return spark.readStream.schema(schema).parquet(path)


def ingest(contigs: DataFrame, tags: DataFrame, library: str, checkpoint: str, k: int = tiling.TAG_LENGTH):
    """Tile a stream of contigs and append calls and new variants to ``library``; returns the query.

    A batch that is done again writes the same rows under its own number, so readers see it once.
    """

    def step(batch: DataFrame, number: int) -> None:
        tiles, _ = tiling.tile_contigs(batch, tags, k)
        tiles.persist()
        tiling.calls_of(tiles).write.mode("overwrite").parquet(f"{library}/calls/batch={number}")
        tiling.variants_of(tiles).write.mode("overwrite").parquet(f"{library}/tile_variants/batch={number}")
        tiles.unpersist()

    return contigs.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def variants(spark: SparkSession, library: str) -> DataFrame:
    """Distinct variants of all batches."""
    return spark.read.parquet(f"{library}/tile_variants").drop("batch").distinct()


def calls(spark: SparkSession, library: str) -> DataFrame:
    return spark.read.parquet(f"{library}/calls").drop("batch")
