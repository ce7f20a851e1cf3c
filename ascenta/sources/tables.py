"""Stage tables: Parquet written whole or not at all, and read with plain long ids."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import bytes_at, delete, publish_bytes


#: Rows of a row group.
GROUP_ROWS = 50_000
_POINTER = "_current"


def write_table(df: DataFrame, path: str) -> str:
    """*df* as zstd Parquet in a folder of its own under *path*, to which a pointer file is then moved; the version's name.

    The pointer changes in one step, so a reader sees the old table or the new
    one, and a write that fails changes nothing. Older versions stay until :func:`forget_old`.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.row.count.limit", GROUP_ROWS).parquet(f"{path.rstrip('/')}/{version}")
    publish_bytes(spark, f"{path.rstrip('/')}/{_POINTER}", version.encode())
    return version


def write_geo(df: DataFrame, path: str, geometry: str = "geometry") -> str:
    """As :func:`write_table`, with GeoParquet metadata: *geometry* holds WKB LineStrings in WGS 84 degrees, longitude first.

    Spark can't put metadata into a footer, so tasks write their files with Arrow,
    each under a name of its own, and report it; the version's list of files holds
    only what tasks that succeeded have reported, whatever others left behind.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/{version}"
    geo = json.dumps({"version": "1.0.0", "primary_column": geometry, "columns": {geometry: {"encoding": "WKB", "geometry_types": ["LineString"]}}})

    def kernel(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        writer, name = None, f"part-{uuid.uuid4().hex}.parquet"
        for batch in batches:
            if writer is None:
                store, inner = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                store.create_dir(inner)
                kind = batch.schema.with_metadata({"geo": geo})
                writer = pq.ParquetWriter(f"{inner}/{name}", kind, filesystem=store, compression="zstd", version="2.6")
            writer.write_table(pa.Table.from_batches([batch]).replace_schema_metadata({"geo": geo}), row_group_size=GROUP_ROWS)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    files = sorted(r.file for r in df.mapInArrow(kernel, "file string").collect())  # one row a task
    publish_bytes(spark, f"{path.rstrip('/')}/{_POINTER}", "\n".join([version, *files]).encode())
    return version


def _current(spark: SparkSession, path: str) -> list[str]:
    """The paths that the table at *path* is read from now."""
    held = bytes_at(spark, f"{path.rstrip('/')}/{_POINTER}")
    if held is None:
        return [path]
    version, *files = held.decode().split("\n")
    folder = f"{path.rstrip('/')}/{version}"
    return [f"{folder}/{f}" for f in files] or [folder]


def forget_old(spark: SparkSession, path: str) -> None:
    """Delete all versions of a table but the one that readers see."""
    held = bytes_at(spark, f"{path.rstrip('/')}/{_POINTER}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    for found in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at) if held else []:
        name = found.getPath().getName()
        if name.startswith("v-") and name != held.decode().split("\n")[0]:
            delete(spark, found.getPath().toString())


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """The columns of a table, from a footer alone."""
    return spark.read.parquet(*_current(spark, path)).columns


def rows_in(spark: SparkSession, path: str) -> int:
    """The rows of a table, which Spark adds up from the row counts in the footers: no column is read."""
    return spark.read.parquet(*_current(spark, path)).count()


def _plain(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType) and (kind.precision, kind.scale) == (20, 0):
        return T.LongType()
    return T.ArrayType(_plain(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table with unsigned ids, which Parquet gives as decimals, as long integers, in arrays as well."""
    df = spark.read.parquet(*_current(spark, path))
    return df.select(*(F.col(f.name).cast(_plain(f.dataType)).alias(f.name) for f in df.schema))
