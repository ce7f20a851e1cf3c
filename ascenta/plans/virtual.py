"""A road network made from the order tables, so that every operator has rows at every scale.

A way is an order, its nodes are the (part, supplier) pairs of its lines in order;
tags come from the order; a node's place and height are whole-number functions of its
key. The SQL here is read by Spark and DuckDB alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import network
from ..operators.arrays import likely
from ..storage import materialize

TAGS = {
    "highway": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'residential' WHEN '2' THEN 'track' WHEN '3' THEN 'service' WHEN '4' THEN 'tertiary' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'path' END END",
    "tracktype": "CASE o_orderkey % 4 WHEN 0 THEN 'grade1' WHEN 1 THEN 'grade3' END",
    "surface": "CASE o_custkey % 3 WHEN 0 THEN 'asphalt' WHEN 1 THEN 'gravel' END",
    "service": "CASE o_orderkey % 5 WHEN 0 THEN 'driveway' END",
    "access": "CASE o_orderstatus WHEN 'F' THEN 'private' WHEN 'P' THEN 'permissive' END",
    "bicycle": "CASE o_custkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END",
    "bridge": "CASE o_orderkey % 7 WHEN 0 THEN 'viaduct' WHEN 1 THEN 'no' END",
    "tunnel": "CASE o_orderkey % 11 WHEN 0 THEN 'building_passage' WHEN 1 THEN 'no' END",
    "covered": "CASE o_orderkey % 13 WHEN 0 THEN 'yes' END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways' tags: id, tags."""
    pairs = F.map_from_arrays(F.array(*(F.lit(k) for k in TAGS)), F.array(*(F.expr(v) for v in TAGS.values())))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("tags"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of ways, in no order: id, and at, by which a way's nodes are ordered.

    Lines that agree in all of *at* have the same node, so what else orders them in the SQL changes no way.
    """
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"))


def in_order(lines: DataFrame) -> DataFrame:
    """Ways of *lines*: id, nodes. The one exchange sends each line once, by its way."""
    at = lines.repartition("id").groupBy("id").agg(F.sort_array(F.collect_list("at")).alias("at"))
    return at.select("id", F.transform("at", lambda a: a["l_partkey"] * 100000 + a["l_suppkey"]).alias("nodes"))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways: id, nodes, tags."""
    return in_order(lines(spark, sf_dir)).join(tagged(spark, sf_dir), "id")


def ridden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`network.ridden` makes of :func:`ways`: tags are judged before anything is sent, and few lines of other ways are sent."""
    own = materialize(network.ridden_tags(tagged(spark, sf_dir)), "ridden")
    return in_order(likely(lines(spark, sf_dir), "id", own)).where(F.size("nodes") >= 2).join(own, "id")


def part_supplier(node: Column) -> tuple[Column, Column]:
    return F.floor(node / 100000).cast("long"), node % 100000


def place(node: Column) -> tuple[Column, Column]:
    """Easting and northing of a node, whole metres below zero."""
    p, s = part_supplier(node)
    return (F.lit(-470000) + (p * 7 + s * 13) % 4001).cast("double"), (F.lit(-1104000) - (p * 11 + s * 3) % 3001).cast("double")


def height(node: Column) -> Column:
    p, s = part_supplier(node)
    return ((p * 37 + s * 101) % 997).cast("double")


#: The same for DuckDB, of a column named node.
X_SQL = "(-470000 + ((node // 100000) * 7 + (node % 100000) * 13) % 4001)::DOUBLE"
Y_SQL = "(-1104000 - ((node // 100000) * 11 + (node % 100000) * 3) % 3001)::DOUBLE"
Z_SQL = "(((node // 100000) * 37 + (node % 100000) * 101) % 997)::DOUBLE"

_ROAD = """(coalesce(highway IN ('motorway_link', 'trunk', 'trunk_link', 'primary', 'primary_link', 'secondary', 'secondary_link', 'tertiary', 'tertiary_link', 'unclassified', 'residential', 'living_street', 'road', 'cycleway'), false)
 OR coalesce(highway = 'track' AND (coalesce(tracktype IN ('grade1', 'grade2'), false) OR coalesce(surface IN ('asphalt', 'chipseal', 'concrete', 'concrete:lanes', 'concrete:plates', 'paving_stones'), false)), false)
 OR coalesce(highway = 'service' AND service IS NULL, false))"""
CYCLABLE_SQL = f"""({_ROAD} AND coalesce(bicycle, '') <> 'no'
 AND (coalesce(access, '') NOT IN ('private', 'no') OR coalesce(bicycle, '') IN ('yes', 'designated', 'permissive')))"""
STRUCTURE_SQL = "CASE WHEN bridge <> 'no' THEN 'bridge' WHEN tunnel <> 'no' THEN 'tunnel' WHEN covered <> 'no' THEN 'covered' END"

#: The network as common table expressions, up to directed candidates.
NETWORK_SQL = f"""
tags AS (SELECT o_orderkey AS id, {", ".join(f"{v} AS {k}" for k, v in TAGS.items())} FROM orders),
way AS (SELECT id, {STRUCTURE_SQL} AS structure FROM tags WHERE {CYCLABLE_SQL}),
pos AS (
  SELECT l_orderkey AS id, l_partkey * 100000 + l_suppkey AS node,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem
),
w AS (SELECT pos.*, structure FROM pos JOIN way USING (id) WHERE n >= 2),
deg AS (SELECT node, count(*) AS degree FROM w GROUP BY node),
cut AS (
  SELECT id, structure, pos, lead(pos) OVER (PARTITION BY id ORDER BY pos) AS nxt, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS seq
  FROM w JOIN deg USING (node) WHERE pos = 0 OR pos = n - 1 OR degree >= 2
),
seg AS (
  SELECT cut.id, cut.seq, any_value(cut.structure) AS structure, list(w.node ORDER BY w.pos) AS nodes
  FROM cut JOIN w ON w.id = cut.id AND w.pos BETWEEN cut.pos AND cut.nxt WHERE cut.nxt IS NOT NULL GROUP BY cut.id, cut.seq
),
kept AS (SELECT * FROM seg WHERE len(list_distinct(nodes)) >= 2),
cand AS (
  SELECT row_number() OVER (ORDER BY id, seq, dir) - 1 AS candidate_id, * FROM (
    SELECT id, seq, 0 AS dir, 'forward' AS direction, structure, nodes FROM kept
    UNION ALL SELECT id, seq, 1, 'reverse', structure, list_reverse(nodes) FROM kept)
)"""
#: Vertices of kept segments with their places.
VERTEX_SQL = f"""vertex AS (
  SELECT id, seq, i, {X_SQL} AS x, {Y_SQL} AS y, {Z_SQL} AS z
  FROM (SELECT id, seq, unnest(nodes) AS node, unnest(range(len(nodes))) AS i FROM kept)
)"""
