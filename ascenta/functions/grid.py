"""The terrain grid: tiles, their boxes and names, and covers of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Metres of a pixel.
RESOLUTION = 2


def span(tile_px: int) -> int:
    """Metres along one side of a tile."""
    return tile_px * RESOLUTION


def tile_index(v: Column, tile_px: int) -> Column:
    """The tile of a coordinate: floored, so negative coordinates go down as well."""
    return F.floor(v / span(tile_px)).cast("long")


def tile_box(tx: Column, ty: Column, tile_px: int) -> Column:
    """Whole metres of a tile's half-open box: min_x, min_y, max_x, max_y."""
    s = span(tile_px)
    return F.struct((tx * s).alias("min_x"), (ty * s).alias("min_y"), ((tx + 1) * s).alias("max_x"), ((ty + 1) * s).alias("max_y"))


def tile_name(tx: Column, ty: Column) -> Column:
    return F.concat(F.lit("x"), tx.cast("string"), F.lit("_y"), ty.cast("string"), F.lit(".tif"))


def mosaic_offsets(tiles: DataFrame, tile_px: int) -> DataFrame:
    """Pixel offset of each tile in the mosaic of all: from its left and top edges."""
    edge = tiles.agg(F.min("tx").alias("left"), F.max("ty").alias("top"))  # one row
    return tiles.join(F.broadcast(edge)).select("tx", "ty", ((F.col("tx") - F.col("left")) * tile_px).alias("x_off"), ((F.col("top") - F.col("ty")) * tile_px).alias("y_off"))


def segments_of(lines: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """One row for each pair of neighbouring vertices: *keys*, i, x0, y0, x1, y1; lines without two vertices give none."""
    n = F.size(x)
    pairs = F.transform(
        F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("i"), F.get(x, i).alias("x0"), F.get(y, i).alias("y0"), F.get(x, i + 1).alias("x1"), F.get(y, i + 1).alias("y1")),
    )
    return lines.select(*keys, F.inline(pairs))


def subdivide(segments: DataFrame, tile_px: int) -> DataFrame:
    """Segments longer than half a tile in equal pieces, none longer; others as they are. Adds piece."""
    keys = [c for c in segments.columns if c not in ("x0", "y0", "x1", "y1")]
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    cut = segments.withColumn("__n", F.greatest(F.lit(1), F.ceil(length / (span(tile_px) / 2)).cast("int")))
    cut = cut.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("__n")
    k = F.col("piece")
    return cut.select(*keys, "piece", at("x0", "x1", k).alias("x0"), at("y0", "y1", k).alias("y0"), at("x0", "x1", k + 1).alias("x1"), at("y0", "y1", k + 1).alias("y1"))


def tile_cover(segments: DataFrame, tile_px: int, halo: float) -> DataFrame:
    """The distinct tiles that the segments' boxes touch, each box grown by *halo* metres."""
    s = span(tile_px)

    def tiles(a: str, b: str) -> Column:
        low = F.floor((F.least(a, b) - halo) / s).cast("long")
        high = F.greatest(F.ceil((F.greatest(a, b) + halo) / s).cast("long") - 1, low)
        return F.explode(F.sequence(low, high))

    return segments.select("y0", "y1", tiles("x0", "x1").alias("tx")).select("tx", tiles("y0", "y1").alias("ty")).distinct()
