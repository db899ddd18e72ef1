"""Where durable intermediate results live.

Lineage is cut only through reliable storage. The cluster names the shared folder in
``spark.checkpoint.dir``; a temporary folder is used only in local mode when that is unset.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="ledgerlake-")
    return _local_root


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and cut its lineage."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(spark))
    # Fresh column identities, so that the result can be joined with frames it came from.
    return df.checkpoint(eager=True).toDF(*df.columns)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/ledgerlake/{name}-{uuid.uuid4().hex}"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of an action go when it has ended, not when the driver next collects its garbage."""
    conf, name = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        yield
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def emptied(spark: SparkSession, path: str) -> None:
    """Give back the room of a written intermediate that no later step reads."""
    spark.range(0).write.mode("overwrite").parquet(path)
