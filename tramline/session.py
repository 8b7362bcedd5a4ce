"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime settings the plans in this package rely on. Dimension joins carry no
# broadcast hints: adaptive execution broadcasts a side once its measured size
# is under the threshold and splits skewed partitions of a sort-merge join
# otherwise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(
    app: str = "tramline", master: str | None = None, **extra: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None
_passing: contextvars.ContextVar[str | None] = contextvars.ContextVar("passing scratch", default=None)


@contextlib.contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders asked for within the block are deleted at its end.

    Frames that read them must not be used behind it: what stays is to be written
    to a path from before the block.
    """
    root = scratch_dir(spark, "passing")
    token = _passing.set(root)
    try:
        yield
    finally:
        _passing.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, readable by every executor.

    Only a local-mode session may fall back to a folder of this machine.
    """
    global _local_root
    if _passing.get():
        return f"{_passing.get()}/{label}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; set it to a folder all executors share"
            )
        _local_root = _local_root or tempfile.mkdtemp(prefix="tramline-")
        shared = _local_root
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
