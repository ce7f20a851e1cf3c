"""From detected climbs to anchors: covered ranges, identity, and removal of duplicates, all set-based."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import collapse_repeats, numbered

#: Metres by which a climb may reach over a junction without taking the candidate beyond.
TOLERANCE = 1.0
CATEGORIES = ["HC", "1", "2", "3", "4", "uncategorized"]


def covered_range(lengths: Column, start: Column, end: Column) -> Column:
    """First and last covered candidate (from 0) of a run with these lengths, and the climb's offsets from the first.

    The first is the last candidate that begins by start + 1 m, the last the first that reaches end - 1 m.
    """
    n = F.size(lengths)
    begin = F.struct(F.array(F.lit(0.0)).alias("all"), F.lit(0.0).alias("last"))
    add = lambda s, v: F.struct(F.concat(s["all"], F.array(s["last"] + v)).alias("all"), (s["last"] + v).alias("last"))
    cumulative = F.aggregate(lengths, begin, add, lambda s: s["all"])

    def of(cum: Column) -> Column:
        first = F.least(F.greatest(F.size(F.filter(cum, lambda c: c <= start + TOLERANCE)) - 1, F.lit(0)), n - 1)
        reached = F.size(F.filter(F.slice(cum, 2, n), lambda c: c < end - TOLERANCE))
        last = F.least(F.greatest(reached, first), n - 1)
        return F.struct(first.alias("first"), last.alias("last"), (start - F.get(cum, first)).alias("start_m"), (end - F.get(cum, first)).alias("end_m"))

    return F.get(F.transform(F.array(cumulative), of), F.lit(0))


def anchored(climbs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Climbs (run_id, climb_index, candidate_ids, start_m, end_m, ...) cut to what they cover, with their identity.

    *candidates*: candidate_id, way_ref, start_node_id, end_node_id, length. Adds way_refs
    (neighbouring repeats as one), start_node_id and end_node_id, and replaces
    candidate_ids and the offsets. A candidate that is missing raises.
    """
    key = ["run_id", "climb_index"]
    steps = climbs.select(*key, F.posexplode("candidate_ids").alias("i", "candidate_id")).join(candidates, "candidate_id", "left")
    known = F.assert_true(F.col("length").isNotNull(), F.concat(F.lit("unknown candidate "), F.col("candidate_id").cast("string"))).isNull()
    along = steps.where(known).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("i", "candidate_id", "way_ref", "start_node_id", "end_node_id", "length"))).alias("__s"))
    placed = climbs.join(along, key).withColumn("__r", covered_range(F.col("__s.length"), F.col("start_m"), F.col("end_m")))
    held = F.slice("__s", F.col("__r.first") + 1, F.col("__r.last") - F.col("__r.first") + 1)
    placed = placed.withColumn("__s", held).withColumns({
        "candidate_ids": F.col("__s.candidate_id"), "way_refs": F.col("__s.way_ref"), "start_node_id": F.element_at("__s", 1)["start_node_id"],
        "end_node_id": F.element_at("__s", -1)["end_node_id"], "start_m": F.col("__r.start_m"), "end_m": F.col("__r.end_m"),
    })
    return placed.withColumn("way_refs", collapse_repeats(F.col("way_refs"))).drop("__s", "__r")


def _contains_first(a: str) -> list[Column]:
    return [F.size(f"{a}candidate_ids").desc(), F.col(f"{a}gain").desc(), F.col(f"{a}run_id"), F.col(f"{a}climb_index")]


def drop_suffixes(climbs: DataFrame) -> DataFrame:
    """Climbs whose chain is no suffix of a longer or stronger kept one; ``collapsed`` counts what each absorbed.

    Being a suffix is transitive, so a climb goes exactly if some climb before it in the
    order (longest, highest, first run) ends with its chain, and it counts with the first
    kept one that does. Chains are matched by suffix keys: a chain of n
    candidates offers its n suffixes, so the join is an equality and no group of
    chains with one last candidate meets pair by pair.
    """
    ranked = climbs.withColumn("__size", F.size("candidate_ids"))
    same = Window.partitionBy("candidate_ids").orderBy(*_contains_first(""))
    unique = ranked.withColumn("__place", F.row_number().over(same))
    # The first of equal chains stands for them; the others are absorbed by whatever keeps that chain.
    best = unique.where("__place = 1").drop("__place")
    suffix = F.transform(F.sequence(F.lit(1), F.col("__size")), lambda k: F.slice("candidate_ids", k, F.col("__size") - k + 1))
    offered = best.select(F.explode(suffix).alias("chain"), F.struct((-F.col("__size")).alias("less"), (-F.col("gain")).alias("lower"), "run_id", "climb_index").alias("by"))
    keeper = offered.groupBy("chain").agg(F.min("by").alias("keeper"))
    assigned = unique.join(keeper, unique["candidate_ids"] == keeper["chain"]).drop("chain")
    absorbed = assigned.groupBy(F.col("keeper.run_id").alias("run_id"), F.col("keeper.climb_index").alias("climb_index")).agg((F.count("*") - 1).cast("int").alias("collapsed"))
    return best.drop("__size").join(absorbed, ["run_id", "climb_index"])


def unique_anchors(climbs: DataFrame) -> DataFrame:
    """One climb for each identity (way_refs and end nodes): the highest, then the first; it carries the others' collapsed, plus one each.

    Adds ``collisions``, the others, and numbers climbs by run and index as climb_id.
    """
    key = ["way_refs", "start_node_id", "end_node_id"]
    whole = Window.partitionBy(*key)
    order = whole.orderBy(F.col("gain").desc(), "run_id", "climb_index")
    found = climbs.withColumns({"__place": F.row_number().over(order), "__all": F.sum("collapsed").over(whole), "collisions": (F.count("*").over(whole) - 1).cast("int")})
    first = found.where("__place = 1").withColumn("collapsed", (F.col("__all") + F.col("collisions")).cast("int")).drop("__place", "__all")
    return numbered(first, "climb_id", "run_id", "climb_index")


def accounts(detections: DataFrame, anchors: DataFrame) -> DataFrame:
    """One row: detections, climbs, and how many were collapsed (as suffixes) or collided; the last three sum to the first, or it raises."""
    made = anchors.agg(F.count("*").alias("climbs"), F.coalesce(F.sum(F.col("collapsed") - F.col("collisions")), F.lit(0)).alias("collapsed"), F.coalesce(F.sum("collisions"), F.lit(0)).alias("collisions"))
    both = detections.agg(F.count("*").alias("detections")).join(F.broadcast(made))  # one row each
    told = F.concat_ws(" ", F.lit("accounts differ:"), "detections", "climbs", "collapsed", "collisions")
    return both.where(F.assert_true(F.col("detections") == F.col("climbs") + F.col("collapsed") + F.col("collisions"), told).isNull())


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: how many identities two derivations share, and how many only the new or the old one has."""
    key = ["way_refs", "start_node_id", "end_node_id"]
    sides = old.select(*key, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(new.select(*key, F.lit(0).alias("o"), F.lit(1).alias("n")))
    held = sides.groupBy(*key).agg(F.max("o").alias("o"), F.max("n").alias("n"))
    return held.agg(*(F.count_if(c).alias(name) for name, c in (("kept", (F.col("o") == 1) & (F.col("n") == 1)), ("new", F.col("o") == 0), ("lost", F.col("n") == 0))))


def category_histogram(climbs: DataFrame) -> DataFrame:
    """Climbs by category in fixed order, with zeros, null as the text "null"."""
    names = [*CATEGORIES, "null"]
    fixed = climbs.sparkSession.createDataFrame(list(enumerate(names)), "place int, category string")
    counts = climbs.groupBy(F.coalesce("category", F.lit("null")).alias("category")).agg(F.count("*").alias("n"))
    return fixed.join(counts, "category", "left").select("place", "category", F.coalesce("n", F.lit(0)).alias("n"))


def anchor_counts(anchors: DataFrame) -> DataFrame:
    """Anchors by number of way refs, ten or more as 10, with the longest, those over several candidates, and the summits that several share."""
    several = F.count_if(F.size("candidate_ids") > 1).alias("multi_candidate")
    sizes = anchors.groupBy(F.least(F.size("way_refs"), F.lit(10)).alias("size")).agg(F.count("*").alias("climbs"), F.max(F.size("way_refs")).alias("longest"), several)
    shared = anchors.groupBy("end_node_id").count().where("count > 1").agg(F.count("*").alias("multi_climb_summits"))
    return sizes.join(F.broadcast(shared))  # one row

