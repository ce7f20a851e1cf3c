"""Geometry: distances on the ellipsoid, points in polygons, and the pinned map projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Mean radius of the earth, metres.
EARTH = 6371008.8
# WGS 84 and Bessel 1841 (semi-major axis, inverse flattening).
WGS84 = (6378137.0, 298.257223563)
BESSEL = (6377397.155, 299.1528128)
# The pinned datum shift, Bessel to WGS 84 (metres, arc seconds, parts per million; position vector).
SHIFT = (572.213, 85.334, 461.94, 4.9732, 1.529, 5.2484, 3.5378)
# The Krovak projection (degrees; scale).
KROVAK = {"lat0": 49.5, "lon0": 24 + 50 / 60, "axis": 30 + 17 / 60 + 17.30311 / 3600, "parallel": 78.5, "scale": 0.9999}


def haversine(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Great-circle metres between two points in degrees; within half a per cent of the ellipsoid."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat0, lat1) + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * half(lon0, lon1)
    return F.lit(2 * EARTH) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def spheroid_distance(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Metres on WGS 84 by the mid-latitude formula: exact to millimetres over the kilometres that climbs span."""
    a, inverse = WGS84
    e2 = (2 - 1 / inverse) / inverse
    mid = F.radians((lat0 + lat1) / 2)
    w = F.sqrt(1 - F.lit(e2) * F.pow(F.sin(mid), 2))
    north = F.radians(lat1 - lat0) * F.lit(a * (1 - e2)) / F.pow(w, 3)
    east = F.radians(lon1 - lon0) * F.lit(a) * F.cos(mid) / w
    return F.hypot(north, east)


def line_length(lon: Column, lat: Column) -> Column:
    """Metres along a line of degrees; 0 with fewer than two points."""
    from ..operators.arrays import indices

    step = lambda i: spheroid_distance(F.get(lon, i), F.get(lat, i), F.get(lon, i + 1), F.get(lat, i + 1))
    return F.aggregate(F.transform(indices(F.size(lon) - 1), step), F.lit(0.0), lambda s, d: s + d)


def within(points: DataFrame, queries: DataFrame, metres: float, cell_degrees: float | None = None) -> DataFrame:
    """Pairs of *queries* and *points* (each lon, lat) no farther apart than *metres*.

    Points are put in a grid of cells at least *metres* wide, queries in the nine
    cells around them, so the join has an equality and its output is bounded by
    what lies near; the distance on the spheroid decides. Adds q_lon, q_lat and distance.
    """
    # A degree of latitude is at least 110,574 m; up to 60 degrees a degree of longitude is half that at least.
    cell = cell_degrees or metres / 55_000
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    near = F.explode(F.expr("transform(sequence(0, 8), k -> struct(k div 3 - 1 AS dx, k % 3 - 1 AS dy))"))
    asked = queries.withColumnsRenamed({"lon": "q_lon", "lat": "q_lat"}).withColumn("__d", near)
    asked = asked.withColumns({"__cx": at("q_lon") + F.col("__d.dx"), "__cy": at("q_lat") + F.col("__d.dy")}).drop("__d")
    held = points.withColumns({"__cx": at("lon"), "__cy": at("lat")})
    pairs = asked.join(held, ["__cx", "__cy"]).withColumn("distance", spheroid_distance(F.col("q_lon"), F.col("q_lat"), F.col("lon"), F.col("lat")))
    return pairs.where(F.col("distance") <= metres).drop("__cx", "__cy")


def covers(ring: Column, lon: Column, lat: Column) -> Column:
    """Whether a closed ring (array of lon, lat) holds a point; its border counts as inside."""
    from ..operators.arrays import indices

    def edge(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, i + 1)
        ax, ay, bx, by = a["lon"], a["lat"], b["lon"], b["lat"]
        cross = (bx - ax) * (lat - ay) - (by - ay) * (lon - ax)
        on = (cross == 0) & lon.between(F.least(ax, bx), F.greatest(ax, bx)) & lat.between(F.least(ay, by), F.greatest(ay, by))
        # A ray to the east crosses edges that reach over the point's latitude to its right.
        hits = ((ay > lat) != (by > lat)) & (F.when(by > ay, cross).otherwise(-cross) > 0)
        return F.struct(on.alias("on"), hits.cast("int").alias("hits"))

    edges = F.transform(indices(F.size(ring) - 1), edge)
    return F.exists(edges, lambda e: e["on"]) | (F.aggregate(edges, F.lit(0), lambda s, e: s + e["hits"]) % 2 == 1)


def touches(ring: Column, x: Column, y: Column, metres: float) -> Column:
    """Whether a line (arrays of metres) comes within *metres* of a closed ring (array of x, y) or lies in it.

    A box test comes first; then any vertex inside or any distance between a
    vertex of one and an edge of the other within reach. *metres* must be over 0: lines
    that cross an edge are then near a vertex or inside, unless both cross far
    from all vertices, for which the crossing itself is tested.
    """
    from ..operators.arrays import indices

    def bounds(values: Column) -> tuple[Column, Column]:
        return F.array_min(values), F.array_max(values)

    (rx0, rx1), (ry0, ry1) = bounds(F.transform(ring, lambda p: p["x"])), bounds(F.transform(ring, lambda p: p["y"]))
    (x0, x1), (y0, y1) = bounds(x), bounds(y)
    box = (x0 <= rx1 + metres) & (x1 >= rx0 - metres) & (y0 <= ry1 + metres) & (y1 >= ry0 - metres)

    def gap(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
        """Metres from a point to a stretch."""
        dx, dy = bx - ax, by - ay
        length = dx * dx + dy * dy
        t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / length))).otherwise(F.lit(0.0))
        return F.hypot(px - ax - t * dx, py - ay - t * dy)

    side = lambda ax, ay, bx, by, px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)

    def near(i: Column, j: Column) -> Column:
        ax, ay, bx, by = F.get(x, i), F.get(y, i), F.get(x, i + 1), F.get(y, i + 1)
        c, d = F.get(ring, j), F.get(ring, j + 1)
        cx, cy, dx, dy = c["x"], c["y"], d["x"], d["y"]
        crossing = (side(ax, ay, bx, by, cx, cy) * side(ax, ay, bx, by, dx, dy) < 0) & (side(cx, cy, dx, dy, ax, ay) * side(cx, cy, dx, dy, bx, by) < 0)
        reach = F.least(gap(ax, ay, cx, cy, dx, dy), gap(bx, by, cx, cy, dx, dy), gap(cx, cy, ax, ay, bx, by), gap(dx, dy, ax, ay, bx, by))
        return crossing | (reach <= metres)

    inside = F.exists(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: covers(F.transform(ring, lambda q: F.struct(q["x"].alias("lon"), q["y"].alias("lat"))), p["x"], p["y"]))
    close = F.exists(indices(F.size(x) - 1), lambda i: F.exists(indices(F.size(ring) - 1), lambda j: near(i, j)))
    return F.coalesce(box & (inside | close), F.lit(False))


def _cartesian(lat, lon, ellipsoid):
    import numpy as np

    a, inverse = ellipsoid
    e2 = (2 - 1 / inverse) / inverse
    v = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return v * np.cos(lat) * np.cos(lon), v * np.cos(lat) * np.sin(lon), v * (1 - e2) * np.sin(lat)


def _geographic(x, y, z, ellipsoid):
    import numpy as np

    a, inverse = ellipsoid
    e2 = (2 - 1 / inverse) / inverse
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        v = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2 * v * np.sin(lat), p)
    return lat, np.arctan2(y, x)


def _shifted(x, y, z, back: bool):
    """The datum shift as one affine map, and its exact inverse."""
    import numpy as np

    tx, ty, tz, rx, ry, rz, ppm = SHIFT
    rx, ry, rz = (math.radians(r / 3600) for r in (rx, ry, rz))
    turn = (1 + ppm * 1e-6) * np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])
    xyz, move = np.stack([x, y, z]), np.array([[tx], [ty], [tz]])
    return np.linalg.solve(turn, xyz - move) if back else turn @ xyz + move


def _constants():
    a, inverse = BESSEL
    e = math.sqrt((2 - 1 / inverse) / inverse)
    lat0, axis, parallel = (math.radians(KROVAK[k]) for k in ("lat0", "axis", "parallel"))
    scale_radius = a * math.sqrt(1 - e * e) / (1 - e * e * math.sin(lat0) ** 2)
    b = math.sqrt(1 + e * e * math.cos(lat0) ** 4 / (1 - e * e))
    g0 = math.asin(math.sin(lat0) / b)
    t0 = math.tan(math.pi / 4 + g0 / 2) * ((1 + e * math.sin(lat0)) / (1 - e * math.sin(lat0))) ** (e * b / 2) / math.tan(math.pi / 4 + lat0 / 2) ** b
    n = math.sin(parallel)
    r0 = KROVAK["scale"] * scale_radius / math.tan(parallel)
    return e, b, t0, n, r0, axis, parallel, math.radians(KROVAK["lon0"])


def to_metres(lon, lat):
    """Easting and northing (Krovak, both negative) of WGS 84 degrees; numpy arrays, one pinned operation for all points."""
    import numpy as np

    e, b, t0, n, r0, axis, parallel, lon0 = _constants()
    x, y, z = _cartesian(np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float)), WGS84)
    phi, lam = _geographic(*_shifted(x, y, z, back=True), BESSEL)
    u = 2 * (np.arctan(t0 * np.tan(phi / 2 + np.pi / 4) ** b / ((1 + e * np.sin(phi)) / (1 - e * np.sin(phi))) ** (e * b / 2)) - np.pi / 4)
    v = b * (lon0 - lam)
    t = np.arcsin(np.cos(axis) * np.sin(u) + np.sin(axis) * np.cos(u) * np.cos(v))
    d = np.arcsin(np.cos(u) * np.sin(v) / np.cos(t))
    theta = n * d
    r = r0 * (np.tan(np.pi / 4 + parallel / 2) / np.tan(t / 2 + np.pi / 4)) ** n
    return -r * np.sin(theta), -r * np.cos(theta)


def to_degrees(easting, northing):
    """WGS 84 degrees (lon, lat) of Krovak metres: the inverse of :func:`to_metres`."""
    import numpy as np

    e, b, t0, n, r0, axis, parallel, lon0 = _constants()
    west, south = -np.asarray(easting, float), -np.asarray(northing, float)
    r, theta = np.hypot(west, south), np.arctan2(west, south)
    d = theta / n
    t = 2 * (np.arctan((r0 / r) ** (1 / n) * np.tan(np.pi / 4 + parallel / 2)) - np.pi / 4)
    u = np.arcsin(np.cos(axis) * np.sin(t) - np.sin(axis) * np.cos(t) * np.cos(d))
    v = np.arcsin(np.cos(t) * np.sin(d) / np.cos(u))
    phi = u
    for _ in range(8):
        s = ((1 + e * np.sin(phi)) / (1 - e * np.sin(phi))) ** (e / 2)
        phi = 2 * (np.arctan(t0 ** (-1 / b) * np.tan(u / 2 + np.pi / 4) ** (1 / b) * s) - np.pi / 4)
    lat, lon = _geographic(*_shifted(*_cartesian(phi, lon0 - v / b, BESSEL), back=False), WGS84)
    return np.degrees(lon), np.degrees(lat)


def project_lines(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """*df* with x and y, the metres of each line's vertices (arrays); one vectorised call a batch."""
    kept = [c for c in df.columns if c not in ("x", "y")]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    i, j = kept.index(lon), kept.index(lat)

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(i), batch.column(j)
            x, y = to_metres(np.asarray(a.flatten(), float), np.asarray(b.flatten(), float))
            counts = [0 if v is None else len(v) for v in a]
            offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(x)), pa.ListArray.from_arrays(offsets, pa.array(y))], [*batch.schema.names, "x", "y"])

    return df.select(*kept).mapInArrow(kernel, f"{schema}, x array<double>, y array<double>")


def with_wkb(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """*df* with geometry, each line (arrays of degrees) as a little-endian WKB LineString; null for null arrays."""
    kept = [c for c in df.columns if c != "geometry"]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    i, j = kept.index(lon), kept.index(lat)

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lines = []
            for x, y in zip(batch.column(i).to_pylist(), batch.column(j).to_pylist(), strict=True):
                known = x is not None and y is not None
                lines.append(b"\x01\x02\x00\x00\x00" + np.uint32(len(x)).tobytes() + np.column_stack([x, y]).astype("<f8").tobytes() if known else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.binary())], [*batch.schema.names, "geometry"])

    return df.select(*kept).mapInArrow(kernel, f"{schema}, geometry binary")


def from_wkb(geometry: bytes) -> list[tuple[float, float]]:
    """The points of a little-endian WKB LineString."""
    import struct

    if geometry[:5] != b"\x01\x02\x00\x00\x00":
        raise ValueError("no LineString")
    values = struct.unpack_from(f"<{2 * struct.unpack_from('<I', geometry, 5)[0]}d", geometry, 9)
    return list(zip(values[::2], values[1::2], strict=True))
