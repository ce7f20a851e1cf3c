"""From ways to directed candidates: node degrees, cuts at junctions, filters and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import is_cyclable, structure_of
from .arrays import indices, numbered


def ridden(ways: DataFrame) -> DataFrame:
    """Ways (id, nodes, tags) that are ridden, with their structure; ways of fewer than two nodes go uncounted."""
    return ridden_tags(ways.where(F.size("nodes") >= 2))


def ridden_tags(ways: DataFrame) -> DataFrame:
    """Ways (id, tags, and nodes where given) that are ridden, with their structure instead of their tags."""
    return ways.where(is_cyclable(F.col("tags"))).select(*(c for c in ways.columns if c in ("id", "nodes")), structure_of(F.col("tags")).alias("structure"))


def node_degrees(ways: DataFrame) -> DataFrame:
    """How often each node occurs on the ways, several times on one way included."""
    return ways.select(F.explode("nodes").alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def junction_segments(ways: DataFrame) -> DataFrame:
    """Pieces of ways between their ends and the inner nodes that occur twice or more: id, seq, nodes, structure.

    Only node occurrences, not whole ways, are shuffled to count degrees; the cuts
    then return to their way by its id.
    """
    degrees = node_degrees(ways).where("degree >= 2")
    inner = ways.select("id", F.posexplode(F.slice("nodes", 2, F.greatest(F.size("nodes") - 2, F.lit(0)))).alias("at", "node"))
    cuts = inner.join(degrees, "node").groupBy("id").agg(F.sort_array(F.collect_list(F.col("at") + 1)).alias("inner"))
    cut = ways.join(cuts, "id", "left").withColumn("cuts", F.concat(F.array(F.lit(0)), F.coalesce("inner", F.array().cast("array<int>")), F.array(F.size("nodes") - 1)))
    piece = lambda i: F.struct(i.alias("seq"), F.slice("nodes", F.get("cuts", i) + 1, F.get("cuts", i + 1) - F.get("cuts", i) + 1).alias("piece"))
    return cut.select("id", "structure", F.inline(F.transform(indices(F.size("cuts") - 1), piece))).select("id", "seq", F.col("piece").alias("nodes"), "structure")


def located(segments: DataFrame, nodes: DataFrame) -> DataFrame:
    """Segments with lon and lat of their nodes (arrays) and ``missing``, whether a node has no place.

    Places are joined once for each node occurrence, by a shuffle on the node.
    """
    at = segments.select("id", "seq", F.posexplode("nodes").alias("i", "node"))
    placed = at.join(nodes.select(F.col("id").alias("node"), "lon", "lat"), "node", "left")
    lines = placed.groupBy("id", "seq").agg(F.sort_array(F.collect_list(F.struct("i", "lon", "lat"))).alias("p"), F.bool_or(F.col("lon").isNull() | F.col("lat").isNull()).alias("missing"))
    return segments.join(lines, ["id", "seq"]).select("id", "seq", "nodes", "structure", F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"), "missing")


def reasons(segments: DataFrame, outside: Column | None = None) -> DataFrame:
    """Segments with why each is dropped: degenerate (fewer than two distinct nodes), missing, outside; else null."""
    missing = F.col("missing") if "missing" in segments.columns else F.lit(False)
    beyond = F.lit(False) if outside is None else outside
    return segments.withColumn("reason", F.when(F.size(F.array_distinct("nodes")) < 2, "degenerate").when(missing, "missing").when(beyond, "outside"))


def both_ways(segments: DataFrame) -> DataFrame:
    """Each segment forward and in reverse, numbered in order of way, piece and direction from 0."""
    back = F.col("dir") == 1
    turned = segments.withColumn("dir", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("nodes", F.when(back, F.reverse("nodes")).otherwise(F.col("nodes")))
    for c in ("lon", "lat", "x", "y"):
        if c in segments.columns:
            turned = turned.withColumn(c, F.when(back, F.reverse(c)).otherwise(F.col(c)))
    out = numbered(turned, "candidate_id", "id", "seq", "dir")
    return out.withColumns({
        "direction": F.when(back, "reverse").otherwise("forward"),
        "start_node_id": F.element_at("nodes", 1),
        "end_node_id": F.element_at("nodes", -1),
        "n_points": F.size("nodes"),
    }).drop("dir")


def extract_counts(ways: DataFrame, judged: DataFrame) -> DataFrame:
    """One row of counts over ways and segments with their reasons."""
    seen = ways.agg(F.count("*").alias("ways_seen"), F.count_if(is_cyclable(F.col("tags"))).alias("ways_cyclable"))
    kept = F.col("reason").isNull()
    of = lambda c: F.count_if(c)
    parts = judged.agg(
        of(kept).alias("segments"),
        (of(kept) * 2).alias("candidates"),
        *(of(F.coalesce(F.col("reason") == r, F.lit(False))).alias(f"segments_{r}") for r in ("degenerate", "missing", "outside")),
        of(~kept).alias("segments_dropped"),
        *(of(kept & F.coalesce(F.col("structure") == s, F.lit(False))).alias(f"segments_{s}") for s in ("bridge", "tunnel", "covered")),
    )
    return seen.join(F.broadcast(parts))  # one row each
