"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_SPACE: ContextVar[str | None] = ContextVar("scratch space", default=None)


def build_session(name: str = "pricetide", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the library expects.

    Times are zone-less; the session zone is pinned to UTC so that streaming,
    which needs zoned timestamps, converts without loss.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, which goes when
    the program ends.  Within a
    :func:`scratch_space` the folder belongs to that space.
    """
    root = _SPACE.get() or spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pricetide-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    target, files = _file_system(spark, path)
    return files.exists(target)


def path_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a path."""
    target, files = _file_system(spark, path)
    return files.getContentSummary(target).getLength()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already."""
    target, files = _file_system(spark, path)
    return files.createNewFile(target)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file, without a Spark job."""
    target, files = _file_system(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with this content, in place of one that is there."""
    target, files = _file_system(spark, path)
    stream = files.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with its contents; nothing happens if there is none."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[str]:
    """Scratch folders made within are removed at the end."""
    space = scratch_dir(spark, "space")
    token = _SPACE.set(space)
    try:
        yield space
    finally:
        _SPACE.reset(token)
        remove_path(spark, space)


def materialise(frame, purpose: str):
    """Write a frame to the shared folder and read it back, cutting its lineage.

    Unlike cached blocks, written files survive the loss of executors.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
