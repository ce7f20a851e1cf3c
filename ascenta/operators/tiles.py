"""Terrain tiles: what to fetch, what was not planned, and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profiles import NODATA


def unplanned(held: DataFrame, planned: DataFrame) -> DataFrame:
    """Tiles on disk that the plan does not want."""
    return held.select("tx", "ty").distinct().join(planned, ["tx", "ty"], "left_anti")


def to_fetch(planned: DataFrame, files: DataFrame) -> DataFrame:
    """Planned tiles without a file whose digest (sha256) is the recorded one."""
    return planned.join(files.where(F.col("sha256") == F.col("recorded")), ["tx", "ty"], "left_anti").select("tx", "ty")


def first_to_fetch(planned: DataFrame, files: DataFrame, n: int) -> DataFrame:
    """The first *n* tiles, in order, that need fetching."""
    return to_fetch(planned, files).orderBy("tx", "ty").limit(n)


def stats(pixels: DataFrame) -> DataFrame:
    """One row over tiles (tx, ty, z): pixels, those without terrain, wholly empty tiles, and the range of heights."""
    real = (F.col("z") != NODATA) & (F.col("z") != 0)
    tile = pixels.groupBy("tx", "ty").agg(
        F.count("*").alias("px"),
        F.count_if(F.col("z") == NODATA).alias("nodata_px"),
        F.count_if(F.col("z") == 0).alias("zero_px"),
        F.min(F.when(real, F.col("z"))).alias("min_m"),
        F.max(F.when(real, F.col("z"))).alias("max_m"),
    )
    return tile.agg(
        F.count("*").alias("tiles"),
        *(F.sum(c).alias(c) for c in ("px", "nodata_px", "zero_px")),
        F.count_if(F.col("nodata_px") == F.col("px")).alias("nodata_tiles"),
        F.min("min_m").alias("min_m"),
        F.max("max_m").alias("max_m"),
    )
