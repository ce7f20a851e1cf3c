"""The derivation: candidates of ways, profiles of candidates, runs, climbs and anchors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anchors, detect, network, profiles, runs
from ..operators.arrays import numbered
from ..storage import materialize


def candidates_of(ways: DataFrame) -> DataFrame:
    """Directed candidates of ways (id, nodes, tags); degenerate pieces go. Ridden ways and pieces are written once."""
    pieces = network.reasons(network.junction_segments(materialize(network.ridden(ways), "ways")))
    return network.both_ways(materialize(pieces.where("reason IS NULL").drop("reason"), "pieces"))


def profiles_of(candidates: DataFrame, tiles: DataFrame, tile_px: int, step: float = 10.0) -> DataFrame:
    """Sampled candidates (candidate_id, structure, x, y) with what became of each: parts, length, z, invalid and outcome.

    ``profiles.finished`` makes the profiles of those that are kept, for :func:`climbs_of`.
    """
    return profiles.judged(profiles.heights(candidates, ["candidate_id", "structure"], tiles, step, tile_px))


def climbs_of(candidates: DataFrame, profiled: DataFrame, walk: runs.Walk = runs.Walk(), override: Mapping[str, float] | None = None) -> DataFrame:  # noqa: B008
    """Scored climbs (with their run's candidate_ids) of candidates and their profiles (candidate_id, distance_m, elevation_m)."""
    ends = materialize(profiles.with_ends(profiled, candidates), "ends")
    chains = materialize(runs.ascending_runs(ends, walk).withColumn("__head", F.element_at("candidate_ids", 1)), "chains")
    held = materialize(numbered(chains, "run_id", "__head", "candidate_ids").drop("__head"), "runs")
    samples = profiles.join_profiles(held, profiled, candidates.select("candidate_id", "start_node_id", "end_node_id"))
    return detect.scored(detect.detect_climbs(samples, override)).join(held, "run_id")


def anchors_of(climbs: DataFrame, candidates: DataFrame, profiled: DataFrame) -> DataFrame:
    """Anchored climbs without duplicates, numbered."""
    lengths = profiles.profile_ends(profiled).select("candidate_id", "length")
    known = candidates.select("candidate_id", F.col("id").alias("way_ref"), "start_node_id", "end_node_id").join(lengths, "candidate_id")
    return anchors.unique_anchors(anchors.drop_suffixes(anchors.anchored(climbs, known)))
