"""Intermediate results written once to the shared folder of the cluster.

A stored intermediate result has three uses: executors may be lost without
redoing the work before it, a second reader does not recompute it, and its
file size tells the planner the truth about how big it is.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}
# Folders of the scopes that are open, the innermost last, by application.
_scopes: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application's own below ``spark.checkpoint.dir``."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        context = spark.sparkContext
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError(
                    "set spark.checkpoint.dir to a folder that all executors share"
                )
            shared = tempfile.mkdtemp(prefix="skyledger-")
        _roots[app] = f"{shared.rstrip('/')}/skyledger-{app}-{uuid.uuid4().hex[:8]}"
    return _roots[app]


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` below the scratch folder and read it back.

    ``compression`` names a codec other than the session's, such as zstd for texts.
    """
    spark = df.sparkSession
    scopes = _scopes.get(spark.sparkContext.applicationId)
    folder = scopes[-1] if scopes else scratch_root(spark)
    path = f"{folder}/{label}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is stored inside, also if the work fails.

    For jobs whose results are tables of their own. Frames that read what was stored
    inside stop working.
    """
    folder = f"{scratch_root(spark)}/scope-{uuid.uuid4().hex[:8]}"
    scopes = _scopes.setdefault(spark.sparkContext.applicationId, [])
    scopes.append(folder)
    try:
        yield
    finally:
        scopes.remove(folder)
        _delete(spark, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application stored; frames that read it stop working."""
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root is not None:
        _delete(spark, root)
