"""What every derivation needs of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .storage import shared_dir


def prepared(spark: SparkSession) -> SparkSession:
    """The session with a checkpoint folder: the one it is configured with, else, on a local master, a temporary one."""
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return spark
