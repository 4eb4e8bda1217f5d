"""Writers: Parquet for libraries, text formats through Spark's writers, and .npy files."""

from __future__ import annotations

import io
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.session import materialize


def write_library(path: str, tags_per_file: int = 50_000, **entities: DataFrame) -> None:
    """Each entity as Parquet; those with a tag in directories by range of tags, sorted within."""
    for name, df in entities.items():
        if "tag" in df.columns:
            chunked = df.withColumn("chunk", F.floor(F.col("tag") / tags_per_file).cast("long"))
            if chunked.isEmpty():  # no directory would be left to read
                chunked.write.parquet(f"{path}/{name}")
                continue
            chunked.repartition("chunk").sortWithinPartitions("chunk", "tag").write.partitionBy("chunk").parquet(f"{path}/{name}")
        else:
            df.write.parquet(f"{path}/{name}")


def write_lines(lines: DataFrame, path: str, by: str | None = None, gzip: bool = False) -> None:
    """Text lines (value), in order within each file; one directory for each value of ``by``."""
    writer = lines.write.option("compression", "gzip" if gzip else "none")
    (writer.partitionBy(by) if by else writer).text(path)


def csv_lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows as comma-separated lines; nulls are empty."""
    return df.select(*[c for c in df.columns if c not in columns], F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)).alias("value"))


def labels(samples: DataFrame) -> DataFrame:
    """Lines of labels.csv: place, label and file in quotes; samples have idx, label and file."""
    return samples.select(F.format_string('%d,"%s","%s"', F.col("idx").cast("int"), "label", "file").alias("value"))


def sample_lines(samples: DataFrame, components: int = 0) -> DataFrame:
    """Lines of samples.csv, components with six decimals."""
    scores = [F.format_string("%f", F.element_at("pca", k + 1)) for k in range(components)]
    fields = [F.col("idx").cast("string"), F.col("sample_id"), F.col("case_control").cast("string"), F.col("training").cast("string"), *scores]
    return samples.select("idx", F.concat_ws(",", *(F.coalesce(f, F.lit("")) for f in fields)).alias("value"))


def fasta_lines(contigs: DataFrame) -> DataFrame:
    return contigs.select("sample", "phase", F.concat(F.lit(">"), "seqname", F.lit("\n"), "seq").alias("value"))


def to_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def npy_bytes(array: np.ndarray) -> bytes:
    """An .npy file; matrices of one slice fit the driver, which is where they are put together."""
    out = io.BytesIO()
    np.save(out, array)
    return out.getvalue()


def matrix_of(rows: DataFrame, order: str = "sample", column: str = "row", dtype: str = "int16") -> np.ndarray:
    """Dense rows (arrays) of one slice as a numpy matrix, in order of ``order``."""
    return np.array([r[column] for r in rows.orderBy(order).select(column).collect()], dtype)


def write_bytes(spark: SparkSession, path: str, parts: Iterable[bytes], step: int = 1 << 20) -> None:
    """A file of ``parts``, one after the other, in whatever store the path names."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    try:
        for part in parts:
            for at in range(0, len(part), step):
                out.write(bytearray(part[at : at + step]))
    finally:
        out.close()


def npy_header(shape: tuple[int, ...], dtype: str) -> bytes:
    """What stands before the numbers in an .npy file."""
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(np.dtype(dtype)), "fortran_order": False, "shape": shape})
    return out.getvalue()


def write_npy(spark: SparkSession, path: str, array: np.ndarray) -> None:
    write_bytes(spark, path, [npy_bytes(array)])


def dense_matrices(cells: DataFrame, by: str, n_rows: int, dtype: str) -> DataFrame:
    """(``by``, cols, content): for each value of ``by`` a matrix, rows by columns, as bytes.

    ``cells`` have ``by``, cols (the matrix's width), row, col and value; cells without a row are 0. One matrix is filled
    in one task, which holds it and one batch of cells.
    """
    kind = cells.schema[by].dataType.simpleString()

    def run(batches):
        name, wide, out = None, 0, None
        for batch in batches:
            names, widths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            row, col, value = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
            edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(edges, edges[1:]):
                if names[a] != name or out is None:
                    if out is not None:
                        yield pa.RecordBatch.from_pydict({by: pa.array([name], batch.schema.field(0).type), "cols": pa.array([wide], pa.int64()), "content": pa.array([out.tobytes()], pa.binary())})
                    name, wide = names[a], widths[a]
                    out = np.zeros((n_rows, wide), dtype)
                    last = batch.schema.field(0).type
                out[row[a:b], col[a:b]] = value[a:b]
        if out is not None:
            yield pa.RecordBatch.from_pydict({by: pa.array([name], last), "cols": pa.array([wide], pa.int64()), "content": pa.array([out.tobytes()], pa.binary())})

    ordered = cells.select(by, F.col("cols").cast("long").alias("cols"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("long").alias("value")).repartition(by).sortWithinPartitions(by)
    return ordered.mapInArrow(run, f"{by} {kind}, cols long, content binary")


def write_matrices(cells: DataFrame, by: str, n_rows: int, dtype: str, path) -> None:
    """An .npy file for each matrix of ``dense_matrices``, at ``path(value of by)``; the driver holds one at a time."""
    for r in dense_matrices(cells, by, n_rows, dtype).toLocalIterator():
        write_bytes(cells.sparkSession, path(r[by]), [npy_header((n_rows, r.cols), dtype), bytes(r.content)])


def tile_cells(cells: DataFrame, columns: DataFrame, names: DataFrame, tags_per_file: int = 50_000) -> DataFrame:
    """Cells of ``dense_matrices`` for ranges of tags: two columns for each output column (tag, outcol) of the range, in
    order; ``names`` (sample, idx) number the rows."""
    own = columns.select("tag", F.floor(F.col("tag") / tags_per_file).cast("int").alias("chunk"))
    place = own.withColumn("_at", F.row_number().over(Window.partitionBy("chunk").orderBy("tag")) - 1)
    wide = own.groupBy("chunk").agg((2 * F.count("*")).alias("cols"))
    rows = cells.join(place.join(wide, "chunk"), "tag").join(names.select("sample", "idx"), "sample")
    return rows.select("chunk", "cols", F.col("idx").alias("row"), (2 * F.col("_at") + F.col("phase")).alias("col"), "value")


def hgvs_columns(cells: DataFrame, by: str | None = None) -> DataFrame:
    """(seqname, hgvs, place): ids numbered from 0 in their order, or on each sequence by position, then text."""
    ids = cells.select("hgvs").distinct().withColumn("seqname", F.substring_index("hgvs", ":", 1) if by else F.lit(""))
    order = [F.regexp_extract("hgvs", r":g\.([0-9]+)", 1).try_cast("long"), "hgvs"] if by else ["hgvs"]
    return ids.withColumn("place", F.row_number().over(Window.partitionBy("seqname").orderBy(*order)) - 1)


def write_hgvs(cells: DataFrame, names: DataFrame, output: str, dtype: str, by: str | None = None) -> None:
    """hgvs.npy (or hgvs.NAME.npy by sequence) from (hgvs, sample, first, second): two columns for each id, and their labels."""
    columns = materialize(hgvs_columns(cells, by), "hgvs-columns")
    wide = columns.groupBy("seqname").agg((2 * F.count("*")).alias("cols"))
    rows = cells.join(columns.join(wide, "seqname"), "hgvs").join(names.select("sample", "idx"), "sample")
    both = rows.select("seqname", "cols", F.col("idx").alias("row"), "place", F.posexplode(F.array("first", "second")).alias("k", "value"))
    cells_ = both.select("seqname", "cols", "row", (2 * F.col("place") + F.col("k")).alias("col"), "value")
    stem = (lambda name: f"{output}/hgvs.{name}") if by else (lambda name: f"{output}/hgvs")
    write_matrices(cells_, "seqname", names.count(), dtype, lambda name: stem(name) + ".npy")
    for r in columns.select("seqname").distinct().toLocalIterator():
        lines = columns.where(F.col("seqname") == r.seqname).orderBy("place")
        write_bytes(cells.sparkSession, stem(r.seqname) + ".annotations.csv", (f"{x.place},{x.hgvs}\n".encode() for x in lines.toLocalIterator()))


def write_coordinates(ones: DataFrame, path: str) -> None:
    """onehot.npy: the rows, then the columns, of all ones (row, col), in order of columns; the driver holds a batch at a time."""
    spark = ones.sparkSession
    ordered = materialize(ones.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).orderBy("col", "row"), "coordinates")
    n = ordered.count()

    def packed(column):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"first": batch.column(0).slice(0, 1), "part": pa.array([batch.column(1).to_numpy().astype("<u4").tobytes()], pa.binary())})

        rows = ordered.orderBy("col", "row").select("col", F.col(column).alias("x")).mapInArrow(run, "first long, part binary")
        for r in rows.toLocalIterator():
            yield bytes(r.part)

    def parts():
        yield npy_header((2, n), "<u4")
        yield from packed("row")
        yield from packed("col")

    write_bytes(spark, path, parts())


def array_of(rows: DataFrame, columns: Sequence[str], dtype: str) -> np.ndarray:
    """Columns of ``rows`` as a matrix, one row for each of ``columns``; for tables that fit the driver."""
    got = rows.select(*columns).toPandas()
    return np.ascontiguousarray(got[list(columns)].to_numpy(dtype).T) if len(got) else np.zeros((len(columns), 0), dtype)
