"""Climb detection along joined profiles. The detector is our own; its thresholds are parameters."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The settings that an override may name, and their defaults (grades in per cent, distances in metres).
CONFIG: dict[str, float] = {
    "CLIMB_CONTINUE_GRADE_PCT": 3.5,
    "CLIMB_END_FLAT_M": 700.0,
    "CLIMB_LEADIN_GRADE_PCT": 2.5,
    "CLIMB_LEADIN_MAX_DISTANCE_M": 500.0,
    "CLIMB_START_GRADE_PCT": 3.75,
    "DESCENT_END_DISTANCE_M": 150.0,
    "DESCENT_END_GRADE_PCT": -1.0,
    "INTERPOLATE_MAX_GAP_M": 25.0,
    "MAX_SUSTAINED_GRADIENT_WINDOW_M": 200.0,
    "MERGE_COHERENT_ASCENT_RATIO": 0.85,
    "MERGE_DESCENT_GAP_MAX_M": 760.0,
    "MERGE_DESCENT_SCALE": 4.0,
    "MERGE_GAP_GAIN_SCALE": 5.5,
    "MERGE_GAP_MAX_BONUS_M": 4000.0,
    "MERGE_MAX_GAP_M": 1200.0,
    "MERGE_MAX_VALLEY_DROP_M": 20.0,
    "MERGE_VALLEY_RATIO": 0.2,
    "RESAMPLE_MIN_INTERVAL_M": 12.0,
    "SMOOTH_GRAD_WINDOW_M": 200.0,
    "SMOOTH_MID_GRADE_THRESHOLD": 0.03,
    "SMOOTH_STEEP_GRADE_THRESHOLD": 0.08,
    "SMOOTH_WINDOW_MAX_M": 250.0,
    "SMOOTH_WINDOW_MID_M": 150.0,
    "SMOOTH_WINDOW_MIN_M": 50.0,
    "SNAP_LOOKAHEAD_MAX_M": 300.0,
    "SPIKE_GRADIENT_THRESHOLD": 0.12,
    "SPIKE_MAX_SEGMENT_M": 24.0,
    "SPIKE_NEIGHBOR_THRESHOLD": 0.08,
    "TRIM_END_GRADE_PCT": 2.5,
    "TRIM_START_GRADE_PCT": 2.5,
    "TRIM_STEEP_RATIO": 0.2,
    "TRIM_TAIL_WINDOW_M": 200.0,
}
#: Settings that our own detector has no use for; they are checked and recorded with the rest.
RECORDED_ONLY = frozenset(
    "INTERPOLATE_MAX_GAP_M MERGE_COHERENT_ASCENT_RATIO MERGE_DESCENT_GAP_MAX_M MERGE_DESCENT_SCALE MERGE_GAP_GAIN_SCALE MERGE_GAP_MAX_BONUS_M "
    "SMOOTH_GRAD_WINDOW_M SMOOTH_MID_GRADE_THRESHOLD SMOOTH_STEEP_GRADE_THRESHOLD SMOOTH_WINDOW_MAX_M SMOOTH_WINDOW_MID_M SNAP_LOOKAHEAD_MAX_M "
    "SPIKE_GRADIENT_THRESHOLD SPIKE_MAX_SEGMENT_M SPIKE_NEIGHBOR_THRESHOLD TRIM_STEEP_RATIO TRIM_TAIL_WINDOW_M".split()
)
#: Settings that may be overridden only together with another.
PAIRS = {"RESAMPLE_MIN_INTERVAL_M": "SPIKE_MAX_SEGMENT_M", "CLIMB_LEADIN_GRADE_PCT": "TRIM_START_GRADE_PCT"}
#: Climbs of less gain or length are none.
MIN_GAIN_M, MIN_LENGTH_M = 10.0, 200.0
MODELS = ("aso", "garmin", "hiking")
#: Least score of each category, ours but for the last.
ASO = (("HC", 600.0), ("1", 400.0), ("2", 250.0), ("3", 150.0), ("4", 60.0), ("uncategorized", 8.0))


def configured(override: Mapping[str, float] | None = None) -> dict[str, float]:
    """The settings with *override*; unknown keys, values that are no finite numbers and halves of a pair raise, all at once."""
    override = dict(override or {})
    numeric = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v)
    faults = [f"unknown setting {k}" for k in override if k not in CONFIG]
    faults += [f"{k} must be a finite number" for k, v in override.items() if k in CONFIG and not numeric(v)]
    faults += [f"{k} needs {other}" for k, other in PAIRS.items() if k in override and other not in override]
    if faults:
        raise ValueError("; ".join(faults))
    return CONFIG | override


def find_climbs(distance, elevation, config: Mapping[str, float]) -> list[tuple[float, float, float, float, float]]:
    """Climbs of a profile: start_m, end_m, gain, avg_grade and max_grade (per cent).

    The profile is read at equal distances of at most RESAMPLE_MIN_INTERVAL_M and its grade taken over a window. A climb
    opens where the grade reaches the start grade, with what leads in to it, and ends after a long descent or
    flat, at its highest point; then its ends are trimmed and neighbours over shallow valleys merged.
    """
    import numpy as np

    distance, elevation = np.asarray(distance, float), np.asarray(elevation, float)
    if len(distance) < 2 or distance[-1] <= distance[0]:
        return []
    n = max(1, math.ceil((distance[-1] - distance[0]) / config["RESAMPLE_MIN_INTERVAL_M"]))
    d = np.linspace(distance[0], distance[-1], n + 1)
    e = np.interp(d, distance, elevation)
    half = config["SMOOTH_WINDOW_MIN_M"] / 2
    a, b = np.maximum(d - half, d[0]), np.minimum(d + half, d[-1])
    grade = 100 * (np.interp(b, d, e) - np.interp(a, d, e)) / (b - a)
    step = d[1] - d[0]
    spans: list[list[int]] = []
    i = 0
    while i <= n:
        if grade[i] < config["CLIMB_START_GRADE_PCT"]:
            i += 1
            continue
        start = high = j = i
        while start > (spans[-1][1] if spans else 0) and grade[start - 1] >= config["CLIMB_LEADIN_GRADE_PCT"] and d[i] - d[start - 1] <= config["CLIMB_LEADIN_MAX_DISTANCE_M"]:
            start -= 1
        flat = down = 0.0
        while j < n:
            j += 1
            high = j if e[j] > e[high] else high
            flat = 0.0 if grade[j] >= config["CLIMB_CONTINUE_GRADE_PCT"] else flat + step
            down = down + step if grade[j] <= config["DESCENT_END_GRADE_PCT"] else 0.0
            if flat > config["CLIMB_END_FLAT_M"] or down > config["DESCENT_END_DISTANCE_M"]:
                break
        spans.append([start, high])
        i = max(j, high) + 1
    for s in spans:
        while s[0] < s[1] and 100 * (e[s[0] + 1] - e[s[0]]) / step < config["TRIM_START_GRADE_PCT"]:
            s[0] += 1
        while s[1] > s[0] and 100 * (e[s[1]] - e[s[1] - 1]) / step < config["TRIM_END_GRADE_PCT"]:
            s[1] -= 1
    merged: list[list[int]] = []
    for s in (s for s in spans if s[1] > s[0]):
        if merged:
            last = merged[-1]
            drop = e[last[1]] - e[last[1] : s[0] + 1].min()
            limit = min(config["MERGE_MAX_VALLEY_DROP_M"], config["MERGE_VALLEY_RATIO"] * (e[last[1]] - e[last[0]]))
            if d[s[0]] - d[last[1]] <= config["MERGE_MAX_GAP_M"] and drop <= limit and e[s[1]] > e[last[1]]:
                last[1] = s[1]
                continue
        merged.append(s)
    out = []
    for s, t in merged:
        gain, length = e[t] - e[s], d[t] - d[s]
        if gain >= MIN_GAIN_M and length >= MIN_LENGTH_M:
            window = min(config["MAX_SUSTAINED_GRADIENT_WINDOW_M"], length)
            heads = d[s : t + 1][d[s : t + 1] + window <= d[t] + 1e-9]
            steep = (np.interp(heads + window, d, e) - np.interp(heads, d, e)).max() / window
            out.append((float(d[s]), float(d[t]), float(gain), float(100 * gain / length), float(100 * steep)))
    return out


def detect_climbs(samples: DataFrame, override: Mapping[str, float] | None = None) -> DataFrame:
    """Climbs (run_id, climb_index, start_m, end_m, dist_m, gain, avg_grade, max_grade) of joined samples (run_id, distance_m, elevation_m).

    A run's profile is gathered in one row; runs are at most 25 km long, so rows
    are small. Runs without a climb give none.
    """
    config = configured(override)
    profiles = samples.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("distance_m", "elevation_m"))).alias("p"))
    profiles = profiles.select("run_id", F.col("p.distance_m").alias("d"), F.col("p.elevation_m").alias("e"))
    names = ["run_id", "climb_index", "start_m", "end_m", "gain", "avg_grade", "max_grade"]

    def kernel(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(r, i, *c) for r, d, e in pdf.itertuples(index=False, name=None) for i, c in enumerate(find_climbs(d, e, config))]
            yield pd.DataFrame(rows, columns=names).astype({"run_id": "int64", "climb_index": "int32"})

    found = profiles.mapInPandas(kernel, "run_id long, climb_index int, start_m double, end_m double, gain double, avg_grade double, max_grade double")
    return found.withColumn("dist_m", F.col("end_m") - F.col("start_m"))


def aso_score(dist_m: Column, avg_grade: Column) -> Column:
    """Kilometres times the square of the average grade in per cent; null below the least category."""
    score = dist_m / 1000 * avg_grade * avg_grade
    return F.when(score >= ASO[-1][1], score)


def aso_category(difficulty: Column) -> Column:
    """The category of a score; null for none."""
    out = F.lit(None).cast("string")
    for name, least in reversed(ASO):
        out = F.when(difficulty >= least, F.lit(name)).otherwise(out)
    return out


def scored(climbs: DataFrame, model: str = "aso") -> DataFrame:
    """Climbs with difficulty and category; both null where no threshold is cleared, and the climb stays."""
    if model not in MODELS:
        raise ValueError(f"unknown scoring model {model}")
    if model != "aso":
        raise NotImplementedError(f"the formula of scoring model {model} was never published")
    with_score = climbs.withColumn("difficulty", aso_score(F.col("dist_m"), F.col("avg_grade")))
    return with_score.withColumn("category", aso_category(F.col("difficulty")))
