"""Session helpers shared by every subpackage."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Paths below the shared folder that are still held, in the order they were made.
_HELD: list[str] = []


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started from."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one where that is unset and the master is local (tests)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if sc.applicationId not in _OWN:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            _OWN[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="tesserae-")
            sc.setCheckpointDir(_OWN[sc.applicationId])
        root = _OWN[sc.applicationId]
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the driver ends."""
    path = f"{shared_root(spark)}/tesserae-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    _HELD.append(path)
    return path


def held_paths() -> list[str]:
    """The paths made by ``scratch_dir`` that haven't been released."""
    return list(_HELD)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove ``paths`` before the driver ends; no DataFrame that is still to be read may stand on them."""
    for path in paths:
        _remove(spark, path)
        if path in _HELD:
            _HELD.remove(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before the interpreter
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage.

    Unlike a local checkpoint the copy survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
