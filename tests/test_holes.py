"""The sampling queries against brute force in numpy, over a raster that must have holes."""

import math

import numpy as np
import pytest

from ascenta.plans import queries

DATA = "/root/testdata/sf0.001"


def pixel(px, py):
    """Height of pixels, nan where there is none, and whether they are nodata and zero."""
    nodata = np.mod(px * 7 + py * 3, 97) == 5
    zero = ~nodata & (np.mod(px + py, 89) == 1)
    z = 400 + 0.125 * ((px + 0.5) * 2 + 470000) + 0.0625 * ((py + 0.5) * 2 + 1104000)
    return np.where(nodata | zero, np.nan, z), nodata, zero


def sampled(x, y, step):
    """Distances, heights (nan without terrain), and counts of nodata and zero pixels read along one line."""
    x, y = np.array(x), np.array(y)
    cum = np.concatenate([[0.0], np.cumsum(np.hypot(np.diff(x), np.diff(y)))])
    parts = max(1, math.ceil(cum[-1] / step))
    d = np.arange(parts + 1) * cum[-1] / parts
    gx, gy = np.interp(d, cum, x) / 2 - 0.5, np.interp(d, cum, y) / 2 - 0.5
    fx, fy = np.floor(gx).astype(int), np.floor(gy).astype(int)
    z, kinds = np.zeros(len(d)), np.zeros(2, int)
    for dx, dy in ((0, 0), (1, 0), (0, 1), (1, 1)):
        v, nodata, zero = pixel(fx + dx, fy + dy)
        z += v * np.abs(1 - dx - (gx - fx)) * np.abs(1 - dy - (gy - fy))
        kinds += nodata.sum(), zero.sum()
    return d, z, kinds


@pytest.fixture(scope="module")
def lines(spark):
    return [(r, *sampled(r.x, r.y, queries.STEP_M)) for r in queries._lines(spark, DATA).collect()]


def test_holes_are_counted(spark, lines):
    want = dict.fromkeys(("kept", "degenerate", "nodata_whole", "nodata_partial", "nodata_samples", "structures"), 0)
    kinds = np.zeros(2, int)
    for r, d, z, k in lines:
        bad = np.isnan(z if r.structure is None else z[[0, -1]])
        what = "degenerate" if d[-1] <= 0 else "kept" if not bad.any() else "nodata_whole" if bad.all() else "nodata_partial"
        want[what] += 1
        want["nodata_samples"] += int(bad.sum())
        want["structures"] += what == "kept" and r.structure is not None
        kinds += k
    assert kinds.min() > 0
    got = queries.QUERIES["nodata_drop_counts"](spark, DATA).first().asDict()
    assert got == {"candidates": len(lines), **want}
    assert min(got[k] for k in ("kept", "nodata_whole", "nodata_partial", "structures")) > 0


def test_holes_are_read_as_null(spark, lines):
    got = {(r.id, r.seq): r for r in queries._read(spark, DATA).collect()}
    assert got.keys() == {(r.id, r.seq) for r, *_ in lines}
    holes = 0
    for r, d, z, _ in lines:
        found = got[r.id, r.seq]
        assert len(found.z) == len(z) == found.parts + 1 and abs(found.length - d[-1]) < 1e-6
        assert [v is None for v in found.z] == np.isnan(z).tolist()
        holes += int(np.isnan(z).sum())
        assert all(abs(a - b) < 1e-6 for a, b in zip(found.z, z, strict=True) if a is not None)
    assert holes


def test_samples_are_at_most_ten_metres_apart(spark, lines):
    got = {(r.id, r.seq): (r.parts, r.length) for r in queries.QUERIES["resample"](spark, DATA).collect()}
    assert got == {(r.id, r.seq): (len(d) - 1, round(float(d[-1]), 4)) for r, d, *_ in lines}
    assert all(m / n <= 10 for n, m in got.values())
