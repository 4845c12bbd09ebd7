"""Where intermediate tables, checkpoints and staged files go.

The session names a shared folder in ``spark.checkpoint.dir``; tests, the benchmark and
``local_session`` set it. Only a session in one single process (``local[...]``) that leaves it
unset gets a folder of its own; every other one fails early.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _local_root[app], ignore_errors=True)
    return _local_root[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path; nothing has been written there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """Cut lineage with a written table that survives the loss of executors.

    ``tasks`` spreads the rows evenly, for readers that make many passes over them.
    """
    path = scratch_path(df.sparkSession, label)
    (df if tasks is None else df.repartition(tasks)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, and not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
