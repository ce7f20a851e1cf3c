"""Where intermediate tables lie: the folder that the driver and the executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []
#: Paths that a thread notes, by its number; a plain table, since this module is pickled by value.
_NOTED: dict[int, list[str]] = {}
_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Where both are unset a temporary folder is made and set, but only on a local
    master: on a cluster, executors would write where nobody else can read, so
    that raises.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = context._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ascenta-")
        context.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    _NOTED.get(threading.get_ident(), []).append(path)
    return path


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that this thread makes within, for :func:`release`; one such block holds no other."""
    paths = _NOTED[threading.get_ident()] = []
    try:
        yield paths
    finally:
        del _NOTED[threading.get_ident()]


def delete(spark: SparkSession, path: str) -> None:
    """Delete what lies at *path*, through the file system of its scheme."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def publish_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Bytes at *path* on any store Hadoop knows: written beside it, then moved over it in one step, so readers see the old or the new."""
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs
    target = files.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    store = target.getFileSystem(conf)
    target = store.makeQualified(target)
    beside = target.suffix(f".{uuid.uuid4().hex}.new")
    out = store.create(beside, True)  # makes the folders as well
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    over[0] = files.Options.Rename.OVERWRITE
    files.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, over)


def bytes_at(spark: SparkSession, path: str) -> bytes | None:
    """What *path* holds; None if there is no such file."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(target) or store.getFileStatus(target).isDirectory():
        return None
    stream = store.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete all that this process has written to the shared folder, or *paths* of it; results that read it can't be read afterwards."""
    for path in list(_MADE) if paths is None else paths:
        delete(spark, path)
        _MADE.remove(path)


@contextmanager
def _swept(spark: SparkSession) -> Iterator[None]:
    """Writes within delete the shuffles they have made when they end."""
    held = spark.conf.get(_SWEEP, None)
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(_SWEEP)
        else:
            spark.conf.set(_SWEEP, held)


def materialize(df: DataFrame, name: str, sweep: bool = False) -> DataFrame:
    """Write *df* as Parquet into the shared folder and read it back.

    Cuts the lineage at files that survive lost executors. Unlike a checkpoint,
    it also resets the plan's size estimate to the files' size; estimates of plans
    that join a checkpoint with itself multiply from round to round. With *sweep*,
    the shuffles of the write go with it; else they lie on disk until the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _swept(spark) if sweep else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
