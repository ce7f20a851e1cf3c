"""Heights read along whole lines: the same as by tile, without samples on the wire or on disk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ascenta.operators import profiles
from ascenta.plans import queries

TILE, STEP = 8, 3.0
DATA = "/root/testdata/sf0.001"
KEYS = ["id", "structure"]


def raster(spark, reach):
    """A plane with holes over tiles from -reach to reach, some missing and some cut in two rows that share the tile."""
    rows = []
    for tx in range(-reach, reach + 1):
        for ty in range(-reach, reach + 1):
            py, px = np.indices((TILE, TILE)) + np.array([ty, tx]).reshape(2, 1, 1) * TILE
            z = (500 + px + py / 2).astype("<f4")
            z[(px + 3 * py) % 41 == 0], z[(px + py) % 37 == 0], z[(px - py) % 43 == 0] = profiles.NODATA, 0, np.nan
            if (tx + ty) % 11 == 0:
                continue
            if (tx - ty) % 7 == 0:
                a, b = z.copy(), z.copy()
                a[: TILE // 2], b[TILE // 2 :] = np.nan, np.nan
                rows += [(tx, ty, bytearray(a.tobytes())), (tx, ty, bytearray(b.tobytes()))]
            else:
                rows.append((tx, ty, bytearray(z.tobytes())))
    return spark.createDataFrame(rows, "tx long, ty long, data binary")


def lines_of(spark, reach):
    """Short lines, lines longer than a block's reach, and lines without length, vertex or terrain."""
    r = np.random.default_rng(5)
    edge = reach * TILE * 2
    lines = [(f"{k}", "bridge" if k % 3 == 0 else None, *(r.uniform(-w, w, (2, 1 + k % 5)) + o[:, None]).tolist()) for k in range(150) for w in (edge, 40) for o in [r.uniform(-edge, edge, 2) * (w == 40)]]
    lines = [(f"{i}-{a}", b, x, y) for i, (a, b, x, y) in enumerate(lines)]
    lines += [("dot", None, [5.0, 5.0], [5.0, 5.0]), ("none", None, [], []), ("null", None, None, None), ("beyond", None, [9e5, 9e5 + 20], [0.0, 0.0])]
    return spark.createDataFrame(lines, "id string, structure string, x array<double>, y array<double>")


@pytest.mark.parametrize(("least", "made"), [(1 << 20, False), (50, True)])
def test_heights_equal_those_by_tile(spark, monkeypatch, least, made):
    monkeypatch.setattr(profiles, "LEAST_SAMPLES", least)  # 50: many groups read one block
    reach = 30
    assert 2 * reach > profiles.REACH_TILES
    tiles, lines = raster(spark, reach).cache(), lines_of(spark, reach)
    want = {r.id: r for r in profiles.whole_lines(profiles.bilinear(profiles.sampled(lines, KEYS, STEP, TILE), KEYS, tiles, TILE), KEYS).collect()}
    given = (lambda wanted: tiles.join(wanted, ["tx", "ty"])) if made else tiles
    got = profiles.heights(lines, KEYS, given, STEP, TILE).collect()
    assert len(got) == len(want) == 302
    for r in got:
        assert r == want[r.id]
    assert any(None in r.z and r.z.count(None) < len(r.z) for r in got) and any(None not in r.z for r in got)
    assert want["beyond"].z == [None] * 8 and "none" not in want
    tiles.unpersist()


def test_no_lines(spark):
    lines = lines_of(spark, 2).where("id = 'none'")
    assert profiles.heights(lines, KEYS, raster(spark, 2), STEP, TILE).collect() == []


def test_whole_samples_equal_pieces(spark):
    lines = lines_of(spark, 30)
    want = {}
    for r in profiles.sampled(lines, KEYS, STEP, TILE).orderBy("id", "first").collect():
        held = want.setdefault(r.id, [r.structure, r.parts, r.length, [], []])
        held[3] += r.x
        held[4] += r.y
    got = profiles.resampled(lines, KEYS, STEP).collect()
    assert len(got) == len(want) and {r.id: list(r[1:]) for r in got} == want


def exchanged(spark):
    """Bytes that all stages so far have sent and written."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() + stages.apply(i).outputBytes() for i in range(stages.size()))


def test_samples_are_neither_sent_nor_written(spark):
    r = np.random.default_rng(6)
    lines = spark.createDataFrame([(f"{k}", None, *r.uniform(-120, 120, (2, 60)).tolist()) for k in range(300)], "id string, structure string, x array<double>, y array<double>")
    tiles = raster(spark, 9)
    before = exchanged(spark)
    samples = profiles.heights(lines, KEYS, tiles, 0.25, TILE).agg(F.sum(F.size("z"))).first()[0]
    assert samples > 5_000_000
    assert 0 < exchanged(spark) - before < samples  # of 8 bytes for a height and 16 for a place


def test_resampling_sends_no_samples(spark):
    r = np.random.default_rng(7)
    lines = spark.createDataFrame([(k, *r.uniform(-500, 500, (2, 30)).tolist()) for k in range(200)], "id int, x array<double>, y array<double>").repartition(4)
    before = exchanged(spark)
    samples = profiles.resampled(lines, ["id"], 1.0).agg(F.sum(F.size("x"))).first()[0]
    assert samples > 2_000_000 and 0 < exchanged(spark) - before < samples


@pytest.mark.parametrize("name", ["bilinear_plane", "resample", "without_profile", "nodata_drop_counts", "deck_interpolation"])
def test_queries_read_whole_lines(spark, monkeypatch, name):
    def wrong(*_):
        raise AssertionError("samples are exchanged")

    for used in ("sampled", "bilinear", "whole_lines"):
        monkeypatch.setattr(profiles, used, wrong)
    assert queries.QUERIES[name](spark, DATA).count()
