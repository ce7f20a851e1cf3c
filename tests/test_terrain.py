import struct
import zlib

import numpy as np
import pytest

from ascenta.functions import geo
from ascenta.operators import profiles
from ascenta.sources import geotiff


def write(z, x0, y1, tile=None, nodata="-9999", deflate=True, epsg=5514, pixel=2.0):
    """A GeoTIFF of the rows of *z*, for tests."""
    height, width = z.shape
    z = z.astype("<f4")
    if tile:
        parts = [z[y : y + tile, x : x + tile].tobytes() for y in range(0, height, tile) for x in range(0, width, tile)]
    else:
        parts = [z.tobytes()]
    parts = [zlib.compress(p) for p in parts] if deflate else parts
    entries, extra = [], b""

    def add(tag, kind, values):
        nonlocal extra
        raw = values if kind == "s" else struct.pack(f"<{len(values)}{kind}", *values)
        code = {"s": 2, "H": 3, "I": 4, "d": 12}[kind]
        entries.append((tag, code, len(values), raw))

    add(256, "I", [width]), add(257, "I", [height]), add(258, "H", [32]), add(259, "H", [8 if deflate else 1]), add(339, "H", [3])
    names = (324, 325) if tile else (273, 279)
    if tile:
        add(322, "I", [tile]), add(323, "I", [tile])
    add(names[0], "I", [0] * len(parts)), add(names[1], "I", [len(p) for p in parts])
    add(33550, "d", [pixel, pixel, 0.0]), add(33922, "d", [0, 0, 0, x0, y1, 0]), add(34735, "H", [1, 1, 0, 2, 1025, 0, 1, 1, 3072, 0, 1, epsg])
    if nodata:
        add(42113, "s", nodata.encode() + b"\0")
    entries.sort()
    start = 8 + 2 + 12 * len(entries) + 4
    sizes = sum(len(r) for _, _, _, r in entries if len(r) > 4)
    at, offsets = start + sizes, []
    for p in parts:
        offsets.append(at)
        at += len(p)
    out = b""
    for tag, code, count, raw in entries:
        if tag == names[0]:
            raw = struct.pack(f"<{count}I", *offsets)
        if len(raw) > 4:
            out += struct.pack("<HHII", tag, code, count, start + len(extra))
            extra += raw
        else:
            out += struct.pack("<HHI", tag, code, count) + raw.ljust(4, b"\0")
    return b"II*\x00" + struct.pack("<IH", 8, len(entries)) + out + b"\0" * 4 + extra + b"".join(parts)


Z = np.arange(64 * 48, dtype=float).reshape(48, 64) / 7


@pytest.mark.parametrize(("tile", "deflate"), [(16, True), (16, False), (None, True), (None, False)])
def test_pixels(tile, deflate):
    data = write(Z, -470016.0, -1103872.0, tile, deflate=deflate)
    assert np.array_equal(geotiff.pixels(data), Z.astype(np.float32))
    h = geotiff.header(data)
    assert h == {"size": (64, 48), "pixel": (2.0, 2.0), "origin": (-470016.0, -1103872.0), "epsg": 5514, "type": "float32", "nodata": -9999.0, "area": True, "block": (tile, tile)}


def test_faults(spark):
    good, bad = write(Z, -470016.0, -1103872.0, 16), write(Z, -470015.0, -1103872.0, 16, nodata=None, epsg=4326)
    wanted = {"epsg": 5514, "nodata": -9999.0}
    files = lambda *d: spark.createDataFrame([(bytearray(x),) for x in d], "data binary")
    found = {(r.tx, r.ty): np.frombuffer(bytes(r.data), "<f4").reshape(16, 16) for r in geotiff.dem_tiles(files(good), 16, wanted).collect()}
    west, south = -470016 // 2, -1103872 // 2 - 48
    for (tx, ty), z in found.items():
        for j, i in ((0, 0), (15, 3), (7, 15)):
            px, py = tx * 16 + i - west, ty * 16 + j - south
            assert np.isnan(z[j, i]) if not (0 <= px < 64 and 0 <= py < 48) else z[j, i] == np.float32(Z[47 - py, px])
    assert sum(int((~np.isnan(z)).sum()) for z in found.values()) == Z.size
    with pytest.raises(Exception, match="epsg is 4326.*nodata is None.*off the pixel grid"):
        geotiff.dem_tiles(files(bad), 16, wanted).collect()
    with pytest.raises(ValueError, match="no TIFF"):
        geotiff.header(b"{}")


def test_heights_from_tiles(spark):
    x, y = np.meshgrid(-470016 + 2 * np.arange(64) + 1, -1103872 - 2 * np.arange(48) - 1)
    plane = 400 + 0.1 * (x + 470000) + 0.05 * (y + 1104000)
    tiles = geotiff.dem_tiles(spark.createDataFrame([(bytearray(write(plane, -470016.0, -1103872.0, 16)),)], "data binary"), 16)
    lines = spark.createDataFrame([(1, [-470000.0, -469920.0], [-1103900.0, -1103950.0]), (2, [0.0, 5.0], [0.0, 0.0])], "id int, x array<double>, y array<double>")
    pieces = profiles.sampled(lines, ["id"], 10.0, 16)
    for r in profiles.whole_lines(profiles.bilinear(pieces, ["id"], tiles, 16), ["id"]).collect():
        at = np.arange(r.parts + 1) / r.parts
        assert r.z == [None, None] if r.id == 2 else r.z == pytest.approx((400 + 0.1 * (80 * at) + 0.05 * (100 - 50 * at)).tolist(), abs=1e-3)


def test_wkb(spark):
    df = spark.createDataFrame([(1, [18.0, 18.5], [49.0, 49.5]), (2, None, None)], "id int, lon array<double>, lat array<double>")
    rows = {r.id: r.geometry for r in geo.with_wkb(df).collect()}
    assert geo.from_wkb(bytes(rows[1])) == [(18.0, 49.0), (18.5, 49.5)] and rows[2] is None
    with pytest.raises(ValueError):
        geo.from_wkb(b"\x01\x01\x00\x00\x00")
