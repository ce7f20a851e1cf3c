import numpy as np
import pytest
from pyspark.sql import functions as F

from ascenta.functions import geo, grid
from ascenta.operators import profiles


def array(*v):
    return F.array(*(F.lit(float(x)) for x in v))


TILE = 8
LINE = "id string, structure string, x array<double>, y array<double>"


def tiles_of(spark, height, wanted):
    """Tiles whose pixel (px, py) is height(px, py)."""
    rows = []
    for tx, ty in wanted:
        z = [[height(tx * TILE + i, ty * TILE + j) for i in range(TILE)] for j in range(TILE)]
        rows.append((tx, ty, bytearray(np.array(z, "<f4").tobytes())))
    return spark.createDataFrame(rows, "tx long, ty long, data binary")


def read(spark, lines, tiles, step=3.0):
    keys = ["id", "structure"]
    df = spark.createDataFrame(lines, LINE)
    pieces = profiles.sampled(df, keys, step, TILE)
    return profiles.whole_lines(profiles.bilinear(pieces, keys, tiles, TILE), keys)


def test_samples(spark):
    lines = [("bend", None, [0.0, 3.0, 10.0], [0.0, 4.0, 4.0]), ("dot", None, [1.0, 1.0], [2.0, 2.0]), ("none", None, [], []), ("far", None, [-40.0, 40.0], [5.0, 5.0])]
    found = {}
    for r in profiles.sampled(spark.createDataFrame(lines, LINE), ["id", "structure"], 6.0, TILE).orderBy("id", "first").collect():
        held = found.setdefault(r.id, [r.parts, r.length, []])
        assert r.first == len(held[2]) and all((np.floor(x / 2 - 0.5) // TILE, np.floor(y / 2 - 0.5) // TILE) == (r.tx, r.ty) for x, y in zip(r.x, r.y, strict=True))
        held[2] += zip(r.x, r.y, strict=True)
    assert set(found) == {"bend", "dot", "far"}
    assert found["bend"] == [2, 12.0, [(0.0, 0.0), (4.0, 4.0), (10.0, 4.0)]] and found["dot"] == [1, 0.0, [(1.0, 2.0), (1.0, 2.0)]]
    assert found["far"][:2] == [14, 80.0] and [x for x, _ in found["far"][2]] == pytest.approx([-40 + 80 * k / 14 for k in range(15)])


def test_heights_are_exact_on_a_plane_across_tiles(spark):
    every = [(a, b) for a in range(-4, 5) for b in range(-4, 5)]
    tiles = tiles_of(spark, lambda px, py: 500 + px + py / 2, every)
    r = np.random.default_rng(1)
    lines = [(str(k), None, r.uniform(-55, 55, 5).tolist(), r.uniform(-55, 55, 5).tolist()) for k in range(20)]
    pieces = {}
    for p in profiles.sampled(spark.createDataFrame(lines, LINE), ["id", "structure"], 3.0, TILE).orderBy("id", "first").collect():
        pieces.setdefault(p.id, []).extend(zip(p.x, p.y, strict=True))
    for line in read(spark, lines, tiles).collect():
        assert line.z == pytest.approx([500 + x / 2 - 0.5 + (y / 2 - 0.5) / 2 for x, y in pieces[line.id]], abs=1e-3) and len(line.z) == line.parts + 1


def test_holes_at_the_edges_of_tiles(spark):
    """Each of the four neighbours may lie in another tile; a hole there, of any kind, or no tile at all, leaves no height."""
    at = 2 * TILE  # the corner between four tiles
    line = [("x", None, [at - 0.2, at + 0.2], [at - 0.2, at + 0.2])]
    four = [(0, 0), (1, 0), (0, 1), (1, 1)]
    good = read(spark, line, tiles_of(spark, lambda px, py: 7.0, four)).first()
    assert good.z == pytest.approx([7.0, 7.0])
    for tx, ty in four:
        for hole in (0.0, -9999.0, float("nan")):
            corner = (TILE - 1 + tx, TILE - 1 + ty)
            assert read(spark, line, tiles_of(spark, lambda px, py, c=corner, h=hole: h if (px, py) == c else 7.0, four)).first().z == [None, None]
        assert read(spark, line, tiles_of(spark, lambda px, py: 7.0, [t for t in four if t != (tx, ty)])).first().z == [None, None]
    assert read(spark, line, tiles_of(spark, lambda px, py: 7.0, four).limit(0)).first().z == [None, None]
    halves = tiles_of(spark, lambda px, py: 7.0 if px % 2 else float("nan"), four).unionByName(tiles_of(spark, lambda px, py: float("nan") if px % 2 else 7.0, four))
    assert read(spark, line, halves).first().z == pytest.approx([7.0, 7.0])


def test_outcomes(spark):
    rows = [("kept", None, [1.0, 2.0]), ("whole", None, [None, None]), ("part", None, [1.0, None]), ("deck", "bridge", [10.0, None, 20.0]), ("tunnel", "tunnel", [None, 2.0, 3.0])]
    lines = [(i, s, len(z) - 1, 10.0, z) for i, s, z in rows] + [("same", None, 1, 0.0, [1.0, 1.0])]
    judged = profiles.judged(spark.createDataFrame(lines, "id string, structure string, parts int, length double, z array<double>"))
    assert {r.id: r.outcome for r in judged.collect()} == {"kept": "kept", "whole": "nodata_whole", "part": "nodata_partial", "deck": "kept", "tunnel": "nodata_partial", "same": "degenerate"}
    c = profiles.outcome_counts(judged).first()
    assert (c.candidates, c.kept, c.structures, c.nodata_samples, c.degenerate) == (6, 2, 1, 4, 1)
    final = {r.id: (r.distance_m, r.elevation_m) for r in profiles.finished(judged).collect()}
    assert final == {"kept": ([0, 10], [1, 2]), "deck": ([0, 5, 10], [10, 15, 20])}


def test_profiles_and_candidates_meet_in_full(spark):
    own = spark.createDataFrame([(1, 5, 6), (2, 6, 7), (3, 7, 8)], "candidate_id long, start_node_id long, end_node_id long")
    held = spark.createDataFrame([(1, [0.0, 9.0], [1.0, 2.0]), (3, [0.0, 9.0], [4.0, 0.1])], "candidate_id long, distance_m array<double>, elevation_m array<double>")
    assert [r.candidate_id for r in profiles.without_profile(own, held).collect()] == [2]
    found = {r.candidate_id: (r.start_node_id, r.end_node_id, r.foot, r.top, r.length) for r in profiles.with_ends(held, own).collect()}
    assert found == {1: (5, 6, 1.0, 2.0, 9.0), 3: (7, 8, 4.0, float(np.float32(0.1)), 9.0)}
    with pytest.raises(Exception, match="no candidate 3 of a profile"):
        profiles.with_ends(held, own.where("candidate_id < 3")).collect()


def test_sampled_profiles_feed_the_walk(spark):
    from ascenta.plans import derive

    tiles = tiles_of(spark, lambda px, py: 400.0 + 0.2 * px, [(a, 0) for a in range(60)])
    rows = [(0, None, [10.0, 400.0], [8.0, 8.0], 1, 2, 50), (1, "bridge", [400.0, 900.0], [8.0, 8.0], 2, 3, 51), (2, None, [900.0, 10.0], [8.0, 8.0], 3, 1, 52), (3, None, [0.0, 2000.0], [8.0, 8.0], 1, 9, 53)]
    own = spark.createDataFrame(rows, "candidate_id long, structure string, x array<double>, y array<double>, start_node_id long, end_node_id long, id long")
    judged = derive.profiles_of(own, tiles, TILE)
    assert {r.candidate_id: r.outcome for r in judged.collect()} == {0: "kept", 1: "kept", 2: "kept", 3: "nodata_partial"}
    profiled = profiles.finished(judged).select("candidate_id", "distance_m", "elevation_m")
    climbs = derive.climbs_of(own, profiled)
    climb = climbs.first()
    assert climbs.count() == 1 and climb.candidate_ids == [0, 1] and climb.gain == pytest.approx(89, abs=3)
    anchor = derive.anchors_of(climbs, own, profiled).first()
    assert (anchor.way_refs, anchor.start_node_id, anchor.end_node_id) == ([50, 51], 1, 3)


def test_join_and_clip(spark):
    own = spark.createDataFrame([(0, [5.0, 15.0, 25.0], [300.0, 301.0, 302.0], 1, 2), (1, [0.0, 10.0, 20.0], [302.0, 303.0, 304.0], 2, 3), (2, [0.0, 9.0], [1.0, 2.0], 7, 8)], "candidate_id long, distance_m array<double>, elevation_m array<float>, start_node_id long, end_node_id long")
    runs = spark.createDataFrame([(9, [0, 1])], "run_id long, candidate_ids array<long>")
    ends = own.select("candidate_id", "start_node_id", "end_node_id")
    own = own.drop("start_node_id", "end_node_id")
    joined = profiles.join_profiles(runs, own, ends)
    assert [(r.distance_m, r.elevation_m) for r in joined.orderBy("distance_m").collect()] == [(0, 300), (10, 301), (20, 302), (30, 303), (40, 304)]
    windows = lambda a, b: spark.createDataFrame([(9, a, b)], "run_id long, start_m double, end_m double")
    assert profiles.clip(joined, windows(10.0, 30.0)).count() == 3 and profiles.clip(joined, windows(12.0, 18.0)).count() == 0
    for bad in ([0, 2], [0, 5]):
        with pytest.raises(Exception, match="run breaks|no profile"):
            profiles.join_profiles(spark.createDataFrame([(1, bad)], runs.schema), own, ends).collect()


def test_grid(spark):
    one = spark.createDataFrame([(-470000.0, -1104000.0, 4096.0)], "a double, b double, c double")
    assert tuple(one.select(grid.tile_index(F.col("a"), 1024), grid.tile_index(F.col("b"), 1024), grid.tile_index(F.col("c"), 1024)).first()) == (-230, -540, 2)
    lines = spark.createDataFrame([(0, [-469900.0, -469700.0], [-1104000.0, -1104000.0]), (1, [-469900.0, -469900.0], [-1104000.0, -1103800.0]), (2, [1.0], [1.0])], "id int, x array<double>, y array<double>")
    pieces = grid.subdivide(grid.segments_of(lines, ["id"]), 128)
    assert pieces.where("id = 0").count() == 2
    assert {tuple(r) for r in grid.tile_cover(pieces, 128, 8.0).collect()} == {(-1836, -4313), (-1835, -4313), (-1836, -4312)}
    box = one.select(grid.tile_box(F.lit(-1836), F.lit(-4313), 128).alias("b"), grid.tile_name(F.lit(-1836), F.lit(-4313)).alias("n")).first()
    assert tuple(box.b) == (-470016, -1104128, -469760, -1103872) and box.n == "x-1836_y-4313.tif"


def test_projection(spark):
    lon, lat = np.array([18.0, 12.5, 15.2, 18.8]), np.array([49.8, 50.1, 48.9, 49.5])
    x, y = geo.to_metres(lon, lat)
    back = geo.to_degrees(x, y)
    assert np.abs(back[0] - lon).max() < 1e-7 and np.abs(back[1] - lat).max() < 1e-7
    df = spark.createDataFrame([(1, lon.tolist(), lat.tolist()), (2, [], [])], "id int, lon array<double>, lat array<double>")
    rows = {r.id: r for r in geo.project_lines(df).collect()}
    assert rows[1].x == pytest.approx(x.tolist()) and rows[2].y == []


def test_distances(spark):
    one = spark.range(1)
    d = one.select(geo.line_length(array(18.29, 18.30), array(49.83, 49.84)).alias("d"), geo.haversine(F.lit(18.29), F.lit(49.83), F.lit(18.30), F.lit(49.84)).alias("h")).first()
    assert 1000 < d.d < 1500 and abs(d.d - d.h) < 0.005 * d.d
    tops = spark.createDataFrame([(1, 18.30, 49.84), (2, 18.40, 49.90)], "climb_id int, lon double, lat double")
    asked = spark.createDataFrame([(7, 18.3005, 49.8401)], "ask int, lon double, lat double")
    assert [r.climb_id for r in geo.within(tops, asked, 150.0).collect()] == [1]
