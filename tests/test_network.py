"""From an extract to candidates, on a random street grid of our own."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ascenta.operators import network
from ascenta.operators.arrays import numbered
from ascenta.plans.derive import candidates_of
from ascenta.sources import osm_pbf

from . import pbf

SIDE = 6
STREET = {"highway": "tertiary"}


def grid():
    """Nodes on a grid, and ways that walk along it at random, cross, close and touch themselves."""
    r = random.Random(11)
    nodes = {7_000 + y * SIDE + x: (14.2 + x / 500, 50.05 + y / 700) for y in range(SIDE) for x in range(SIDE)}
    ways = {}
    for k in range(14):
        x, y = r.randrange(SIDE), r.randrange(SIDE)
        line = [(x, y)]
        for _ in range(r.randint(1, 7)):
            dx, dy = r.choice([(1, 0), (-1, 0), (0, 1), (0, -1)])
            line.append((min(max(line[-1][0] + dx, 0), SIDE - 1), min(max(line[-1][1] + dy, 0), SIDE - 1)))
        kept = [p for i, p in enumerate(line) if i == 0 or p != line[i - 1]]
        ways[900 + 7 * k] = ([7_000 + b * SIDE + a for a, b in kept], STREET | ({"bridge": "movable"} if k % 5 == 1 else {}) | ({"covered": "yes"} if k % 5 == 2 else {}))
    ways[850] = ([7_000, 7_001], {"highway": "bridleway"})  # not ridden: its ends make no junction
    ways[851] = ([7_002], STREET)
    ways[852] = ([7_003, 7_004, 7_003], STREET)
    return nodes, ways


NODES, WAYS = grid()


def pieces():
    """Cuts of ridden ways by counting node occurrences, said plainly."""
    ridden = {i: n for i, (n, t) in WAYS.items() if t["highway"] == "tertiary" and len(n) > 1}
    seen = Counter(n for line in ridden.values() for n in line)
    out = {}
    for i, line in ridden.items():
        at = [k for k, n in enumerate(line) if k in (0, len(line) - 1) or seen[n] > 1]
        out[i] = [line[a : b + 1] for a, b in zip(at, at[1:], strict=False)]
    return out


RING = [(14.19, 50.04), (14.25, 50.04), (14.25, 50.10), (14.19, 50.10)]
HOLE = [(14.2035, 50.0505), (14.2065, 50.0505), (14.2065, 50.0535), (14.2035, 50.0535)]


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("osm") / "grid.osm.pbf"
    corners = {1 + k: p for k, p in enumerate(RING + HOLE)}
    lines = {10: ([1, 2, 3], {}), 11: ([1, 4, 3], {}), 12: ([5, 6, 7, 8, 5], {})}
    area = (3, [("way", 10, "outer"), ("way", 11, "outer"), ("way", 12, "inner"), ("node", 1, "label")], {"type": "boundary"})
    pbf.write(path, NODES | corners, WAYS | lines, {77: area}, {16: "grid writer", 32: 86_400, 33: 12})
    return str(path)


def test_source(spark, extract):
    assert osm_pbf.read_header(extract) == {"replication_ts": "1970-01-02T00:00:00Z", "replication_seq": 12, "replication_base_url": None, "writing_program": "grid writer"}
    nodes = {r.id: (r.lon, r.lat) for r in osm_pbf.read_osm(spark, extract, "nodes").collect()}
    assert all(nodes[i] == pytest.approx(p) for i, p in NODES.items())
    ways = {r.id: (r.nodes, r.tags) for r in osm_pbf.read_osm(spark, extract, "ways").collect()}
    assert {i: ways[i] for i in WAYS} == WAYS
    relation = osm_pbf.read_osm(spark, extract, "relations").first()
    assert (relation.id, relation.version, len(relation.members), tuple(relation.members[2])) == (77, 3, 4, ("way", 12, "inner"))


def test_boundary_with_a_hole(spark, extract):
    nodes, ways, relations = (osm_pbf.read_osm(spark, extract, k) for k in ("nodes", "ways", "relations"))
    area = osm_pbf.boundaries(relations, ways, nodes, [77])
    found = area.collect()
    assert len(found) == 1 and len(found[0].ring) == 5 and [len(h) for h in found[0].holes] == [5]
    points = spark.createDataFrame([(1, 14.22, 50.06), (2, 14.205, 50.052), (3, 15.0, 50.06)], "p int, lon double, lat double")
    inside = points.crossJoin(area).select("p", osm_pbf.inside(F.col("ring"), F.col("holes"), F.col("lon"), F.col("lat")).alias("in"))
    assert {r.p: r["in"] for r in inside.collect()} == {1: True, 2: False, 3: False}
    with pytest.raises(ValueError, match="78"):
        osm_pbf.boundaries(relations, ways, nodes, [77, 78])
    assert sorted(map(len, osm_pbf.stitch([["a", "b"], ["c", "b"], ["c", "a"], ["x", "y", "x"]]))) == [3, 4]
    with pytest.raises(ValueError, match="close"):
        osm_pbf.stitch([["a", "b"], ["b", "c"]])


def test_cuts(spark, extract):
    ways = osm_pbf.read_osm(spark, extract, "ways").where("id >= 800")
    found = {}
    for r in network.junction_segments(network.ridden(ways)).orderBy("id", "seq").collect():
        found.setdefault(r.id, []).append(r.nodes)
    assert found == pieces()


def test_candidates(spark, extract):
    ways = osm_pbf.read_osm(spark, extract, "ways").where("id >= 800")
    rows = candidates_of(ways).orderBy("candidate_id").collect()
    kept = [(i, s, line) for i, cut in sorted(pieces().items()) for s, line in enumerate(cut) if len(set(line)) > 1]
    both = [(i, s, d, line[::step]) for i, s, line in kept for d, step in (("forward", 1), ("reverse", -1))]
    assert [(r.id, r.seq, r.direction, r.nodes) for r in rows] == both and [r.candidate_id for r in rows] == list(range(len(both)))
    for r in rows:
        assert (r.start_node_id, r.end_node_id, r.n_points) == (r.nodes[0], r.nodes[-1], len(r.nodes))
        tags = WAYS[r.id][1]
        assert r.structure == ("bridge" if "bridge" in tags else "covered" if "covered" in tags else None)


def test_counts_and_places(spark, extract):
    from ascenta.functions.geo import covers

    ways, nodes = (osm_pbf.read_osm(spark, extract, k) for k in ("ways", "nodes"))
    ways = ways.where("id >= 800")
    gone = max(n for cut in pieces().values() for line in cut for n in line)
    lines = network.located(network.junction_segments(network.ridden(ways)), nodes.where(F.col("id") != gone))
    west, north = 14.2045, 50.0545
    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((14.0, 50.0), (west, 50.0), (west, north), (14.0, north), (14.0, 50.0))))
    outside = ~F.exists(F.arrays_zip("lon", "lat"), lambda p: covers(ring, p["lon"], p["lat"]))
    c = network.extract_counts(ways, network.reasons(lines, outside)).first()
    want = Counter()
    for i, cut in pieces().items():
        for line in cut:
            reason = "degenerate" if len(set(line)) < 2 else "missing" if gone in line else None if any(NODES[n][0] <= west and NODES[n][1] <= north for n in line) else "outside"
            want[reason] += 1
            want["bridge"] += reason is None and "bridge" in WAYS[i][1]
            want["covered"] += reason is None and "covered" in WAYS[i][1]
    assert (c.segments, c.segments_degenerate, c.segments_missing, c.segments_outside) == tuple(want[k] for k in (None, "degenerate", "missing", "outside"))
    assert (c.segments_bridge, c.segments_covered, c.segments_tunnel) == (want["bridge"], want["covered"], 0) and min(want[None], want["missing"], want["outside"]) > 0
    assert (c.ways_seen, c.ways_cyclable, c.candidates) == (len(WAYS), len(WAYS) - 1, 2 * want[None])


def test_numbers(spark):
    df = spark.createDataFrame([(k * 37 % 5000, k) for k in range(900)], "a long, b long").repartition(7)
    for width in (1, 10, 1024):
        rows = sorted(numbered(df, "n", "a", "b", width=width).collect(), key=lambda r: (r.a, r.b))
        assert [r.n for r in rows] == list(range(900))
