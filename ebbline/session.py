"""Session settings and the shared work area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    # Short Python jobs lose some 40 ms each to TCP's delayed acknowledgements otherwise.
    "spark.python.unix.domain.socket.enabled": "true",
}


_CREATED: list[str] = []  # paths given out by this driver, for ``scratch``


def get_session(name: str = "ebbline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Where that is unset, a machine-local folder is chosen, but only for a local
    master; a cluster without a shared folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if not current:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ebbline-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never one that holds data."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _CREATED.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> Iterator[None]:
    """Remove the paths that ``new_path`` gave out inside, but those named in ``keep`` (as prefixes of their names).

    For steps whose results are written elsewhere when they end: frames that read a removed path can't be used any more.
    """
    first = len(_CREATED)
    try:
        yield
    finally:
        for path in _CREATED[first:]:
            if not path.rpartition("/")[2].startswith(keep):
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _CREATED[first:] = [p for p in _CREATED[first:] if p.rpartition("/")[2].startswith(keep)]
