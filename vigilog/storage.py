"""Shared-folder helpers: where jobs cut lineage and keep intermediate tables."""

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)
_waiting: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    session without it is an error, since executors cannot share local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_root()


@lru_cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="vigilog-")


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/vigilog/{label}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cache this survives the loss of executors, and later jobs read
    columns instead of recomputing the plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark knows."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns every folder that ``materialize`` and ``scratch_path`` make inside, and removes them at the end.

    Write or collect results inside; a DataFrame that still reads such a folder is of no
    use afterwards. Scopes nest: a folder belongs to the innermost one.
    """
    token = _owned.set([])
    try:
        yield
    finally:
        mine = _owned.get()
        _owned.reset(token)
        for path in mine or []:
            remove(spark, path)


@contextlib.contextmanager
def until_release() -> Iterator[None]:
    """Leaves every folder made inside for a later ``release``: for a step that returns a DataFrame over them."""
    token = _owned.set([])
    try:
        yield
    finally:
        _waiting.extend(_owned.get() or [])
        _owned.reset(token)


def release(spark: SparkSession, read: DataFrame) -> None:
    """Removes the folders that ``until_release`` left, but for those that ``read`` still reads."""
    files = read.inputFiles()
    used = [path for path in _waiting if any(path in f for f in files)]
    for path in _waiting:
        if path not in used:
            remove(spark, path)
    _waiting[:] = used
