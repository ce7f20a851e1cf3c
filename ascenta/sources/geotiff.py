"""Float32 terrain tiles in GeoTIFF: header checks and pixels, stripped or tiled, plain or deflated."""

from __future__ import annotations

import re
import struct
import zlib

from pyspark.sql import DataFrame

from .terrain import window_faults

# TIFF field types (size, format) and the tags that are read.
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
_TAGS = {
    256: "width", 257: "height", 258: "bits", 259: "compression", 273: "strip_offsets", 278: "rows_per_strip", 279: "strip_bytes", 317: "predictor", 322: "tile_width", 323: "tile_height",
    324: "tile_offsets", 325: "tile_bytes", 339: "sample_format", 33550: "pixel_scale", 33922: "tie_point", 34735: "geo_keys", 34737: "geo_text", 42113: "nodata",
}


def fields(data: bytes) -> dict:
    """The tags of the first image, by name."""
    order = {b"II*\x00": "<", b"MM\x00*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("no TIFF")
    at = struct.unpack_from(order + "I", data, 4)[0]
    out: dict = {"order": order}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if tag in _TAGS and kind in _TYPES:
            letter = _TYPES[kind]
            size = struct.calcsize(letter) * count
            place = at + 2 + 12 * k + 8
            if size > 4:
                place = struct.unpack_from(order + "I", data, place)[0]
            if letter == "s":
                out[_TAGS[tag]] = data[place : place + count].split(b"\0")[0].decode("latin-1")
            else:
                out[_TAGS[tag]] = struct.unpack_from(f"{order}{count}{letter}", data, place)
    return out


def header(data: bytes) -> dict:
    """What a window is checked for: size, pixel, origin, crs, type, nodata, whether pixels are areas, and tile size."""
    f = fields(data)
    keys = f.get("geo_keys", ())
    geo = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    scale, tie = f.get("pixel_scale", (None, None)), f.get("tie_point", (0, 0, 0, None, None))
    epsg = geo.get(3072)
    if epsg in (None, 32767):  # user-defined: the last authority in the text, if any
        found = re.findall(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]', f.get("geo_text", ""))
        epsg = int(found[-1]) if found else None
    one = lambda name: f[name][0] if name in f else None
    return {
        "size": (one("width"), one("height")),
        "pixel": (scale[0], scale[1]),
        "origin": (tie[3], tie[4]),
        "epsg": epsg,
        "type": {(32, 3): "float32", (64, 3): "float64"}.get((one("bits"), one("sample_format")), "other"),
        "nodata": float(f["nodata"]) if f.get("nodata") else None,
        "area": geo.get(1025, 1) == 1,
        "block": (one("tile_width"), one("tile_height")),
    }


def pixels(data: bytes):
    """The heights, a row of the image each."""
    import numpy as np

    f = fields(data)
    width, height = f["width"][0], f["height"][0]
    tiled = "tile_offsets" in f
    w, h = (f["tile_width"][0], f["tile_height"][0]) if tiled else (width, f.get("rows_per_strip", (height,))[0])
    offsets, sizes = (f["tile_offsets"], f["tile_bytes"]) if tiled else (f["strip_offsets"], f["strip_bytes"])
    if f.get("predictor", (1,))[0] != 1 or f.get("compression", (1,))[0] not in (1, 8, 32946):
        raise ValueError("predictors and other compressions are not read")
    out = np.empty((-(-height // h) * h, -(-width // w) * w), np.float32)
    across = out.shape[1] // w
    for k, (at, size) in enumerate(zip(offsets, sizes, strict=True)):
        raw = data[at : at + size]
        if f.get("compression", (1,))[0] != 1:
            raw = zlib.decompress(raw)
        part = np.frombuffer(raw, f["order"] + "f4")
        y, x = k // across * h, k % across * w
        out[y : y + len(part) // w, x : x + w] = part.reshape(-1, w)
    return out[:height, :width]


def dem_tiles(files: DataFrame, tile_px: int, wanted: dict | None = None) -> DataFrame:
    """Tiles (tx, ty, data) of files (data: their bytes), numbered from the map's origin upwards; see ``profiles.bilinear`` for data.

    All of a file's faults against *wanted* raise at once. A file must be on the pixel
    grid, its origin a whole number of square pixels; where it covers a tile in
    part, the rest is nan and other files may fill it.
    """

    def kernel(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            for data in pdf["data"]:
                found = header(data)
                faults = window_faults(found, wanted or {})
                (sx, sy), (x0, y1) = found["pixel"], found["origin"]
                if sx != sy or x0 % sx or y1 % sy:
                    faults.append("the tile is off the pixel grid")
                if faults:
                    raise ValueError(f"dem: {'; '.join(faults)}")
                z = pixels(data)[::-1]  # from the south
                west, south = int(x0 // sx), int(y1 // sy) - len(z)
                rows = []
                for ty in range(south // tile_px, (south + len(z) - 1) // tile_px + 1):
                    for tx in range(west // tile_px, (west + z.shape[1] - 1) // tile_px + 1):
                        out = np.full((tile_px, tile_px), np.nan, "<f4")
                        top, left = max(south, ty * tile_px), max(west, tx * tile_px)
                        part = z[top - south : (ty + 1) * tile_px - south, left - west : (tx + 1) * tile_px - west]
                        y, x = top - ty * tile_px, left - tx * tile_px
                        out[y : y + part.shape[0], x : x + part.shape[1]] = part
                        rows.append((tx, ty, out.tobytes()))
                yield pd.DataFrame(rows, columns=["tx", "ty", "data"])

    return files.select("data").mapInPandas(kernel, "tx long, ty long, data binary")
