"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.session import ensure_importable, materialize, scratch_dir, shared_root

__all__ = ["ensure_importable", "materialize", "scratch_dir", "shared_root", "table", "slices", "batches", "small"]

#: ASCII white space; words are the runs between.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, names: Sequence[str], step: int = 256) -> Iterator[tuple]:
    """Rows of ``names`` in ``batch`` as tuples; few rows are Python objects at once."""
    cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(0, batch.num_rows, step):
        yield from zip(*(c.slice(i, step).to_pylist() for c in cols))


def batches(rows: Iterator[tuple], schema: pa.Schema, step: int = 1024, weight: int | None = None) -> Iterator[pa.RecordBatch]:
    """Record batches of up to ``step`` rows; ``weight`` names a column whose summed lengths stay below 16 MB."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        if weight is not None:
            size += len(row[weight] or b"")
        if len(held) >= step or size >= 1 << 24:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


_KEPT: list[dict] = []


def keep(*caches: dict) -> None:
    """Say that this Python worker now fills ``caches``.

    Workers outlive stages. Those of the operator that this one worked for before are emptied, and what it
    has freed goes back to the system, so that the operators of a pipeline don't add up.
    """
    if len(caches) == len(_KEPT) and all(a is b for a, b in zip(caches, _KEPT)):
        return
    for c in _KEPT:
        if not any(c is x for x in caches):
            c.clear()
    _KEPT[:] = caches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Characters and array entries, as ``weight`` counts them, that may be broadcast.
BROADCAST_WEIGHT = 1 << 27


def small(df: DataFrame, limit: int, weight: Column | None = None) -> bool:
    """Whether ``df`` has at most ``limit`` rows, whose ``weight`` (what varies in their size) is bounded too; reads no more
    than are needed to know."""
    n, total = df.limit(limit + 1).agg(F.count("*"), F.sum(F.lit(0) if weight is None else weight)).first()
    return n <= limit and (total or 0) <= BROADCAST_WEIGHT


def broadcast_if_small(df: DataFrame, limit: int, weight: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is proven to be ``small``, else as it is (a shuffled join)."""
    return F.broadcast(df) if small(df, limit, weight) else df


def carried(carry: Sequence[str], made: Sequence[str]) -> list[str]:
    """Names under which the columns in ``carry`` come back: _carry_ before those that the operator makes itself."""
    return [f"_carry_{c}" if c in made else c for c in carry]


def named(column: str) -> Column:
    """The column of that name, even if it has dots or quotes."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` doesn't have."""
    while name in df.columns:
        name = "_" + name
    return name


def map_rows(df: DataFrame, fn, inputs: Sequence[str], schema: pa.Schema, ddl: str, carry: Sequence[str] = (), step: int = 512) -> DataFrame:
    """``fn(*inputs)`` of each row, which gives a tuple for ``schema`` (``ddl``), beside the columns in ``carry``.

    Columns in ``carry`` pass through as they are, whatever their types; ``carried`` tells their names.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for c in carry}
    bare = df.select(*(named(c).alias(f"in_{k}") for k, c in enumerate(inputs)), *(named(c).alias(f"carry_{k}") for k, c in enumerate(carry) if c not in inputs))
    held = [f"in_{list(inputs).index(c)}" if c in inputs else f"carry_{k}" for k, c in enumerate(carry)]
    names = [f"in_{k}" for k in range(len(inputs))]

    def run(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in part:
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                made = [fn(*row) for row in slices(piece, names)]
                new = [pa.array(c, t) for c, t in zip(zip(*made), schema.types)]
                old = [piece.column(piece.schema.get_field_index(h)) for h in held]
                yield pa.RecordBatch.from_arrays([*new, *old], [*(f"new_{k}" for k in range(len(new))), *(f"carry_{k}" for k in range(len(old)))])

    fields = [f.strip().split(" ", 1) for f in ddl.split(",")]
    out = bare.mapInArrow(run, ", ".join([f"new_{k} {kind}" for k, (_, kind) in enumerate(fields)] + [f"carry_{k} {kinds[c]}" for k, c in enumerate(carry)]))
    made = [name for name, _ in fields]
    return out.toDF(*made, *carried(carry, made))
