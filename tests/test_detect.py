"""Detection, scores and anchors: pinned ramps, and plain loops over random climbs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ascenta.operators import anchors, detect

# The ramps (length m, grade %) between a flat kilometre on either side, and what they must give.
RAMPS = [
    ((2000, 6), {"gain": (120, 5), "dist": (2000, 50), "avg": (6, 0.2), "steepest": (6, 0.2), "start": (1000, 50), "end": (3000, 50)}, "4"),
    ((400, 4), {}, None),
]
SAMPLE = "run_id long, distance_m double, elevation_m double"


def ramp(length, grade):
    d = np.arange(0, length + 2001, 10.0)
    return d, 300 + np.clip(d - 1000, 0, length) * grade / 100


def test_ramps(spark):
    rows = [(k, float(d), float(e)) for k, (shape, _, _) in enumerate(RAMPS) for d, e in zip(*ramp(*shape), strict=True)]
    rows += [(9, float(d), float(e)) for d, e in zip(ramp(2000, 6)[0], ramp(2000, 6)[1][::-1], strict=True)]  # the same, downwards
    found = {r.run_id: r for r in detect.scored(detect.detect_climbs(spark.createDataFrame(rows, SAMPLE))).collect()}
    assert set(found) == {0, 1}
    for k, (_, want, category) in enumerate(RAMPS):
        r = found[k]
        got = {"gain": r.gain, "dist": r.dist_m, "avg": r.avg_grade, "steepest": r.max_grade, "start": r.start_m, "end": r.end_m}
        assert all(abs(got[n] - v) <= by for n, (v, by) in want.items()) and r.category == category and (r.difficulty is None) == (category is None)


def test_a_climb_has_what_its_profile_says():
    r = random.Random(2)
    for _ in range(60):
        e = np.cumsum([0.0, *(r.choice([-0.6, -0.2, 0, 0.1, 0.5, 0.9]) for _ in range(40))])
        d, e = np.arange(0, 4001, 100.0), 200 + 8 * e
        found = detect.find_climbs(d, e, detect.CONFIG)
        at = lambda m: float(np.interp(m, d, e))
        for start, end, gain, avg, steep in found:
            assert 0 <= start < end <= 4000 and gain >= detect.MIN_GAIN_M and end - start >= detect.MIN_LENGTH_M
            assert gain == pytest.approx(at(end) - at(start)) and avg == pytest.approx(100 * gain / (end - start)) and steep <= np.diff(e).max() + 1e-9
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
    assert detect.find_climbs([0.0], [1.0], detect.CONFIG) == [] == detect.find_climbs([], [], detect.CONFIG) == detect.find_climbs([5.0, 5.0], [1.0, 9.0], detect.CONFIG)


def test_settings():
    assert len(detect.CONFIG) == 32 and set(detect.CONFIG) > detect.RECORDED_ONLY
    assert detect.configured({"CLIMB_START_GRADE_PCT": 5})["CLIMB_START_GRADE_PCT"] == 5 and detect.configured() == detect.CONFIG
    assert detect.configured({"RESAMPLE_MIN_INTERVAL_M": 8, "SPIKE_MAX_SEGMENT_M": 16})["RESAMPLE_MIN_INTERVAL_M"] == 8
    for bad, what in (({"SPEED": 1}, "unknown setting SPEED"), ({"MERGE_MAX_GAP_M": float("inf")}, "finite"), ({"MERGE_MAX_GAP_M": "9"}, "finite"), ({"MERGE_MAX_GAP_M": False}, "finite"),
                      ({"RESAMPLE_MIN_INTERVAL_M": 8}, "needs SPIKE_MAX_SEGMENT_M"), ({"CLIMB_LEADIN_GRADE_PCT": 1, "SPEED": 2}, "unknown setting SPEED; CLIMB_LEADIN_GRADE_PCT needs TRIM_START_GRADE_PCT")):
        with pytest.raises(ValueError, match=what):
            detect.configured(bad)


def test_models(spark):
    climbs = spark.createDataFrame([(1500.0, 7.5)], "dist_m double, avg_grade double")
    assert detect.scored(climbs).first().difficulty == pytest.approx(1.5 * 7.5**2)
    with pytest.raises(NotImplementedError, match="hiking"):
        detect.scored(climbs, "hiking")
    with pytest.raises(ValueError, match="own"):
        detect.scored(climbs, "own")
    histogram = anchors.category_histogram(spark.createDataFrame([("HC",), (None,), ("HC",), ("2",)], "category string")).orderBy("place").collect()
    assert [(r.category, r.n) for r in histogram] == [("HC", 2), ("1", 0), ("2", 1), ("3", 0), ("4", 0), ("uncategorized", 0), ("null", 1)]


PIECE = "candidate_id long, way_ref long, start_node_id long, end_node_id long, length double"
CLIMB = "run_id long, climb_index int, candidate_ids array<long>, start_m double, end_m double, gain double"


def slopes(seed):
    """Pieces in a few roads, and climbs over stretches of them."""
    r = random.Random(seed)
    pieces = [(k, 40 + k // 3 % 4, 500 + k, 501 + k, float(r.choice([150, 320, 700]))) for k in range(18)]
    climbs = []
    for run in range(40):
        a = r.randrange(12)
        ids = list(range(a, a + r.randint(1, 6)))
        total = sum(pieces[i][4] for i in ids)
        lo, hi = sorted(r.choice([0.0, 0.8, 1.0, 150.0, 150.9, 151.5, total / 2, total - 1.5, total - 0.5, total]) for _ in range(2))
        climbs.append((run, r.randrange(2), ids, lo, max(hi, lo + 1), float(r.choice([20, 30, 30, 45]))))
    return pieces, climbs


def covered(climb, pieces):
    """The pieces under a climb: each end may reach a metre over a junction."""
    run, index, ids, start, end, gain = climb
    begins = list(itertools.accumulate([0.0, *(pieces[i][4] for i in ids[:-1])]))
    ends = [b + pieces[i][4] for b, i in zip(begins, ids, strict=True)]
    first = max((k for k in range(len(ids)) if begins[k] <= start + 1), default=0)
    last = next((k for k in range(first, len(ids)) if ends[k] >= end - 1), len(ids) - 1)
    own = ids[first : last + 1]
    ways = [w for w, _ in itertools.groupby(pieces[i][1] for i in own)]
    return {"run": run, "index": index, "ids": own, "start": start - begins[first], "end": end - begins[first], "gain": gain, "ways": ways, "from": pieces[own[0]][2], "to": pieces[own[-1]][3]}


@pytest.mark.parametrize("seed", range(3))
def test_anchors_of_random_climbs(spark, seed):
    pieces, climbs = slopes(seed)
    rows = [covered(c, pieces) for c in climbs]
    known, own = spark.createDataFrame(pieces, PIECE), spark.createDataFrame(climbs, CLIMB)
    found = anchors.anchored(own, known)
    got = {(r.run_id, r.climb_index): (r.candidate_ids, round(r.start_m, 6), round(r.end_m, 6), r.way_refs, r.start_node_id, r.end_node_id) for r in found.collect()}
    assert got == {(r["run"], r["index"]): (r["ids"], round(r["start"], 6), round(r["end"], 6), r["ways"], r["from"], r["to"]) for r in rows}
    # Longest, then highest, then first: a chain that ends a kept one goes, and counts with the first that holds it.
    kept = []
    for r in sorted(rows, key=lambda r: (-len(r["ids"]), -r["gain"], r["run"], r["index"])):
        holder = next((k for k in kept if k["ids"][-len(r["ids"]) :] == r["ids"]), None)
        if holder:
            holder["n"] += 1
        else:
            kept.append(r | {"n": 0})
    lasting = anchors.drop_suffixes(found)
    assert {(r.run_id, r.collapsed) for r in lasting.collect()} == {(k["run"], k["n"]) for k in kept}
    same = {}
    for k in kept:
        same.setdefault((tuple(k["ways"]), k["from"], k["to"]), []).append(k)
    want = set()
    for group in same.values():
        best = min(group, key=lambda k: (-k["gain"], k["run"], k["index"]))
        want.add((best["run"], sum(k["n"] for k in group) + len(group) - 1, len(group) - 1))
    unique = anchors.unique_anchors(lasting)
    assert {(r.run_id, r.collapsed, r.collisions) for r in unique.collect()} == want
    books = anchors.accounts(own, unique).first()
    assert (books.detections, books.climbs) == (len(climbs), len(want)) and books.detections == books.climbs + books.collapsed + books.collisions


def test_unknown_candidates_raise(spark):
    pieces, climbs = slopes(1)
    with pytest.raises(Exception, match="unknown candidate 17"):
        anchors.anchored(spark.createDataFrame([(1, 0, [16, 17], 0.0, 9.0, 5.0)], CLIMB), spark.createDataFrame(pieces[:17], PIECE)).collect()


def test_compare(spark):
    of = lambda *keys: spark.createDataFrame([(list(k), 3, 8) for k in keys], "way_refs array<long>, start_node_id long, end_node_id long")
    old, new = of((5,), (6, 7), (9,)), of((6, 7), (9,), (9, 5), (4,))
    assert anchors.compare(old, new).first().asDict() == {"kept": 2, "new": 2, "lost": 1}
    assert anchors.compare(old, old).select(F.col("kept")).first()[0] == 3
