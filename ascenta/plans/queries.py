"""Registered queries over the virtual network, each beside the DuckDB SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..functions.geo import line_length, within
from ..functions.tags import is_cyclable, structure_of
from ..operators import anchors, arrays, detect, network, profiles, runs, tiles, warehouse
from ..sources import tables
from ..storage import materialize, noted, release
from . import derive
from .virtual import CYCLABLE_SQL, NETWORK_SQL, STRUCTURE_SQL, TAGS, VERTEX_SQL, Z_SQL, height, place, ridden, table, tagged, ways

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TILE_PX, HALO_M, STEP_M = 64, 8.0, 10.0
_TAGS_SQL = f"WITH tags AS (SELECT o_orderkey AS id, {', '.join(f'{v} AS {k}' for k, v in TAGS.items())} FROM orders)"


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _ids(nodes: str | Column) -> Column:
    return F.array_join(F.transform(nodes, lambda n: n.cast("string")), ",")


def _pieces_of_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of ridden ways; these are read three times, so they are written once."""
    return network.junction_segments(materialize(ridden(spark, sf_dir), "ways", sweep=True))


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.reasons(_pieces_of_ways(spark, sf_dir)).where("reason IS NULL").drop("reason")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept segments with x, y and z of their nodes."""
    at = lambda k: F.transform("nodes", lambda n: place(n)[k])
    return _kept(spark, sf_dir).withColumns({"x": at(0), "y": at(1), "z": F.transform("nodes", height)})


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.both_ways(materialize(_kept(spark, sf_dir), "pieces"))


def _profiles(candidates: DataFrame) -> DataFrame:
    """A profile for each candidate: its nodes' heights, 10 m apart."""
    distance = F.transform("nodes", lambda n, i: (i * 10).cast("double"))
    return candidates.select("candidate_id", distance.alias("distance_m"), F.transform("nodes", height).cast("array<float>").alias("elevation_m"))


def _ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialize(_candidates(spark, sf_dir), "candidates")
    return profiles.profile_ends(_profiles(own)).join(own.select("candidate_id", "start_node_id", "end_node_id"), "candidate_id")


_ENDS_SQL = f"""e AS MATERIALIZED (
  SELECT candidate_id, nodes[1] AS s, nodes[-1] AS t, (len(nodes) - 1) * 10.0::DOUBLE AS length,
         {Z_SQL.replace("node ", "nodes[1] ")} AS foot, {Z_SQL.replace("node ", "nodes[-1] ")} AS top
  FROM cand
)"""


# --- network -------------------------------------------------------------


@query(f"{_TAGS_SQL} SELECT id, {CYCLABLE_SQL} AS cyclable FROM tags")
def way_predicate(spark, sf_dir):
    return tagged(spark, sf_dir).select("id", is_cyclable(F.col("tags")).alias("cyclable"))


@query(f"{_TAGS_SQL} SELECT id, {STRUCTURE_SQL} AS structure FROM tags")
def structure_class(spark, sf_dir):
    return tagged(spark, sf_dir).select("id", structure_of(F.col("tags")).alias("structure"))


@query(f"WITH {NETWORK_SQL} SELECT node, degree FROM deg")
def node_degree(spark, sf_dir):
    return network.node_degrees(ridden(spark, sf_dir))


@query(f"WITH {NETWORK_SQL} SELECT id, seq::INT AS seq, structure, array_to_string(nodes, ',') AS nodes FROM seg")
def junction_segments(spark, sf_dir):
    return _pieces_of_ways(spark, sf_dir).select("id", "seq", "structure", _ids("nodes").alias("nodes"))


@query(f"WITH {NETWORK_SQL} SELECT candidate_id, id, seq::INT AS seq, direction, structure, nodes[1] AS start_node_id, nodes[-1] AS end_node_id, len(nodes)::INT AS n_points, array_to_string(nodes, ',') AS nodes FROM cand")
def candidates_both_ways(spark, sf_dir):
    return _candidates(spark, sf_dir).withColumn("nodes", _ids("nodes"))


@query(f"""WITH {NETWORK_SQL}, j AS (SELECT *, len(list_distinct(nodes)) < 2 AS bad FROM seg)
SELECT (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS ways_seen,
       (SELECT count(*) FROM way WHERE id IN (SELECT l_orderkey FROM lineitem)) AS ways_cyclable,
       count(*) FILTER (WHERE NOT bad) AS segments, 2 * count(*) FILTER (WHERE NOT bad) AS candidates,
       count(*) FILTER (WHERE bad) AS segments_degenerate, 0::BIGINT AS segments_missing, 0::BIGINT AS segments_outside,
       count(*) FILTER (WHERE bad) AS segments_dropped,
       count(*) FILTER (WHERE NOT bad AND structure = 'bridge') AS segments_bridge,
       count(*) FILTER (WHERE NOT bad AND structure = 'tunnel') AS segments_tunnel,
       count(*) FILTER (WHERE NOT bad AND structure = 'covered') AS segments_covered
FROM j""")
def extract_counts(spark, sf_dir):
    own = materialize(ways(spark, sf_dir), "ways")
    return network.extract_counts(own, network.reasons(network.junction_segments(network.ridden(own))))


_RING = [(-469500.0, -1105000.0), (-468000.0, -1105000.0), (-468000.0, -1106000.0), (-469500.0, -1106000.0), (-469500.0, -1105000.0)]


@query(f"WITH {NETWORK_SQL}, {VERTEX_SQL} SELECT id, seq::INT AS seq, bool_or(x BETWEEN -469500 AND -468000 AND y BETWEEN -1106000 AND -1105000) AS inside FROM vertex GROUP BY id, seq")
def vertices_in_boundary(spark, sf_dir):
    from ..functions.geo import covers

    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in _RING))
    return _lines(spark, sf_dir).select("id", "seq", F.exists(F.arrays_zip("x", "y"), lambda p: covers(ring, p["x"], p["y"])).alias("inside"))


_X0, _X1, _Y0, _Y1 = -469500.0, -468000.0, -1106000.0, -1105000.0
_TO_BOX = "sqrt(pow(greatest({a} - {x}, 0, {x} - {b}), 2) + pow(greatest({c} - {y}, 0, {y} - {d}), 2))".replace("{a}", f"({_X0})").replace("{b}", f"({_X1})").replace("{c}", f"({_Y0})").replace("{d}", f"({_Y1})")
_TO_CORNER = "(SELECT sqrt(pow({cx} - x0 - t * (x1 - x0), 2) + pow({cy} - y0 - t * (y1 - y0), 2)) FROM (SELECT coalesce(greatest(0, least(1, (({cx} - x0) * (x1 - x0) + ({cy} - y0) * (y1 - y0)) / nullif(pow(x1 - x0, 2) + pow(y1 - y0, 2), 0))), 0) AS t))"


def _enter_leave(low: float, high: float, a: str, b: str) -> tuple[str, str]:
    """Where along a stretch from *a* to *b* it enters and leaves the strip between two lines."""
    at = lambda v: f"(({v}) - {a}) / nullif({b} - {a}, 0)"
    outside = f"CASE WHEN {a} BETWEEN {low} AND {high} THEN {{}} ELSE {{}} END"
    return f"coalesce(least({at(low)}, {at(high)}), {outside.format(0, 2)})", f"coalesce(greatest({at(low)}, {at(high)}), {outside.format(1, -1)})"


_ENTER, _LEAVE = zip(_enter_leave(_X0, _X1, "x0", "x1"), _enter_leave(_Y0, _Y1, "y0", "y1"), strict=True)


@query(f"""WITH {NETWORK_SQL}, {VERTEX_SQL}, s AS (SELECT a.id, a.seq, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM vertex a JOIN vertex b ON a.id = b.id AND a.seq = b.seq AND b.i = a.i + 1)
SELECT id, seq::INT AS seq, bool_or(greatest(0, {", ".join(_ENTER)}) <= least(1, {", ".join(_LEAVE)}) OR least({", ".join([_TO_BOX.format(x=f"x{k}", y=f"y{k}") for k in (0, 1)] + [_TO_CORNER.format(cx=f"({x})", cy=f"({y})") for x in (_X0, _X1) for y in (_Y0, _Y1)])}) <= 200) AS touches
FROM s GROUP BY id, seq""")
def boundary_touch(spark, sf_dir):
    from ..functions.geo import touches

    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in _RING))
    return _lines(spark, sf_dir).select("id", "seq", touches(ring, F.col("x"), F.col("y"), 200.0).alias("touches"))


# --- grid ----------------------------------------------------------------

_S = TILE_PX * 2


@query(f"WITH {NETWORK_SQL}, {VERTEX_SQL} SELECT id, seq::INT AS seq, i::INT AS i, floor(x / {_S})::BIGINT AS tx, floor(y / {_S})::BIGINT AS ty FROM vertex")
def tile_index(spark, sf_dir):
    points = _lines(spark, sf_dir).select("id", "seq", F.posexplode(F.arrays_zip("x", "y")).alias("i", "p"))
    return points.select("id", "seq", "i", grid.tile_index(F.col("p.x"), TILE_PX).alias("tx"), grid.tile_index(F.col("p.y"), TILE_PX).alias("ty"))


_SEGMENTS_SQL = f"""s AS (
  SELECT a.id, a.seq, a.i, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM vertex a JOIN vertex b ON a.id = b.id AND a.seq = b.seq AND b.i = a.i + 1
), cover AS (
  SELECT DISTINCT tx, unnest(range(y_lo, greatest(y_hi, y_lo) + 1)) AS ty FROM (
    SELECT unnest(range(x_lo, greatest(x_hi, x_lo) + 1)) AS tx, y_lo, y_hi FROM (
      SELECT floor((least(x0, x1) - {HALO_M}) / {_S})::BIGINT AS x_lo, ceil((greatest(x0, x1) + {HALO_M}) / {_S})::BIGINT - 1 AS x_hi,
             floor((least(y0, y1) - {HALO_M}) / {_S})::BIGINT AS y_lo, ceil((greatest(y0, y1) + {HALO_M}) / {_S})::BIGINT - 1 AS y_hi
      FROM {{}}))
)"""
_PIECES_SQL = f"""cutting AS (
  SELECT *, greatest(1, ceil(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) / {_S / 2}))::INT AS n FROM s
), piece AS (
  SELECT id, seq, i, k AS piece, x0 + (x1 - x0) * k / n AS x0, y0 + (y1 - y0) * k / n AS y0, x0 + (x1 - x0) * (k + 1) / n AS x1, y0 + (y1 - y0) * (k + 1) / n AS y1
  FROM (SELECT *, unnest(range(n))::INT AS k FROM cutting)
)"""
_GRID_SQL = f"WITH {NETWORK_SQL}, {VERTEX_SQL}, " + _SEGMENTS_SQL.split(", cover")[0] + f", {_PIECES_SQL}, cover" + _SEGMENTS_SQL.split(", cover", 1)[1].format("piece")


def _pieces(spark, sf_dir):
    return grid.subdivide(grid.segments_of(_lines(spark, sf_dir), ["id", "seq"]), TILE_PX)


@query(_GRID_SQL + " SELECT id, seq::INT AS seq, i::INT AS i, piece, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM piece")
def subdivide(spark, sf_dir):
    return _pieces(spark, sf_dir).select("id", "seq", "i", "piece", *(F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")))


@query(_GRID_SQL + " SELECT tx, ty FROM cover")
def tile_cover_halo(spark, sf_dir):
    return grid.tile_cover(_pieces(spark, sf_dir), TILE_PX, HALO_M)


@query(_GRID_SQL + f""" SELECT tx, ty, tx * {_S} AS min_x, ty * {_S} AS min_y, (tx + 1) * {_S} AS max_x, (ty + 1) * {_S} AS max_y, 'x' || tx || '_y' || ty || '.tif' AS name,
  (tx - (SELECT min(tx) FROM cover)) * {TILE_PX} AS x_off, ((SELECT max(ty) FROM cover) - ty) * {TILE_PX} AS y_off FROM cover""")
def tile_bbox(spark, sf_dir):
    cover = grid.tile_cover(_pieces(spark, sf_dir), TILE_PX, HALO_M).checkpoint()
    named = cover.select("tx", "ty", grid.tile_box(F.col("tx"), F.col("ty"), TILE_PX).alias("b"), grid.tile_name(F.col("tx"), F.col("ty")).alias("name"))
    return named.select("tx", "ty", "b.*", "name").join(grid.mosaic_offsets(cover, TILE_PX), ["tx", "ty"])


_KNOWN_SQL = "held AS (SELECT DISTINCT (p_partkey % 40 - 3680)::BIGINT AS tx, (p_size - 8660)::BIGINT AS ty FROM part)"


def _held(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select((F.col("p_partkey") % 40 - 3680).alias("tx"), (F.col("p_size") - 8660).cast("long").alias("ty")).distinct()


@query(_GRID_SQL + f", {_KNOWN_SQL} SELECT tx, ty FROM held EXCEPT SELECT tx, ty FROM cover")
def unplanned_tiles(spark, sf_dir):
    return tiles.unplanned(_held(spark, sf_dir), grid.tile_cover(_pieces(spark, sf_dir), TILE_PX, HALO_M))


@query(_GRID_SQL + f""", {_KNOWN_SQL}, files AS (SELECT tx, ty, sha256(tx || ':' || ty) AS recorded, CASE WHEN (tx + ty) % 3 = 0 THEN 'torn' ELSE sha256(tx || ':' || ty) END AS sha256 FROM held)
SELECT tx, ty FROM cover EXCEPT SELECT tx, ty FROM files WHERE recorded = sha256""")
def refetch_set(spark, sf_dir):
    digest = F.sha2(F.concat_ws(":", "tx", "ty"), 256)
    files = _held(spark, sf_dir).select("tx", "ty", digest.alias("recorded"), F.when((F.col("tx") + F.col("ty")) % 3 == 0, "torn").otherwise(digest).alias("sha256"))
    return tiles.to_fetch(grid.tile_cover(_pieces(spark, sf_dir), TILE_PX, HALO_M), files)


@query(f"""WITH t AS (SELECT (p_partkey % 7)::BIGINT AS tx, (p_size % 5)::BIGINT AS ty, CASE WHEN p_size = 7 THEN -9999.0 WHEN p_size = 9 THEN 0.0 ELSE p_retailprice END AS z FROM part),
tile AS (SELECT tx, ty, count(*) AS px, count(*) FILTER (WHERE z = -9999) AS nodata_px, count(*) FILTER (WHERE z = 0) AS zero_px,
         min(z) FILTER (WHERE z <> -9999 AND z <> 0) AS min_m, max(z) FILTER (WHERE z <> -9999 AND z <> 0) AS max_m FROM t GROUP BY ALL)
SELECT count(*) AS tiles, sum(px)::BIGINT AS px, sum(nodata_px)::BIGINT AS nodata_px, sum(zero_px)::BIGINT AS zero_px,
       count(*) FILTER (WHERE nodata_px = px) AS nodata_tiles, min(min_m) AS min_m, max(max_m) AS max_m FROM tile""")
def tile_stats(spark, sf_dir):
    z = F.when(F.col("p_size") == 7, profiles.NODATA).when(F.col("p_size") == 9, 0.0).otherwise(F.col("p_retailprice"))
    pixels = table(spark, sf_dir, "part").select((F.col("p_partkey") % 7).alias("tx"), (F.col("p_size") % 5).cast("long").alias("ty"), z.alias("z"))
    return tiles.stats(pixels)


@query(_GRID_SQL + f""", {_KNOWN_SQL} SELECT tx, ty FROM (SELECT tx, ty FROM cover EXCEPT SELECT tx, ty FROM held) ORDER BY tx, ty LIMIT 25""")
def next_tiles(spark, sf_dir):
    """The first 25 tiles that need fetching: the limit is the feature."""
    return tiles.first_to_fetch(grid.tile_cover(_pieces(spark, sf_dir), TILE_PX, HALO_M), _held(spark, sf_dir).withColumns({"sha256": F.lit("x"), "recorded": F.lit("x")}), 25)


# --- profiles ------------------------------------------------------------

#: Each stretch between two vertices gives the samples from its start up to the next vertex, the last one the end as well.
_RESAMPLE_SQL = f"""step AS (
  SELECT id, seq, i, x, y, coalesce(sqrt(pow(x - lag(x) OVER o, 2) + pow(y - lag(y) OVER o, 2)), 0) AS d FROM vertex WINDOW o AS (PARTITION BY id, seq ORDER BY i)
), run AS (
  SELECT *, sum(d) OVER (PARTITION BY id, seq ORDER BY i ROWS UNBOUNDED PRECEDING) AS c, sum(d) OVER w AS total, max(i) OVER w AS n FROM step WINDOW w AS (PARTITION BY id, seq)
), line AS (
  SELECT *, greatest(1, ceil(total / {STEP_M}))::INT AS parts FROM run
), begun AS (
  SELECT *, CASE WHEN i = 0 THEN 0 WHEN i = n OR total = 0 THEN parts + 1 ELSE ceil(c * parts / total) END::INT AS k0 FROM line
), stretch AS (
  SELECT *, lead(x) OVER p AS x1, lead(y) OVER p AS y1, lead(d) OVER p AS d1, lead(k0) OVER p AS k1 FROM begun WINDOW p AS (PARTITION BY id, seq ORDER BY i)
), sample AS MATERIALIZED (
  SELECT id, seq, k, parts, total, d, x + coalesce((x1 - x) * (d - c) / nullif(d1, 0), 0) AS x, y + coalesce((y1 - y) * (d - c) / nullif(d1, 0), 0) AS y
  FROM (SELECT *, CASE WHEN k = parts THEN total ELSE total * k / parts END AS d FROM (SELECT * EXCLUDE (d), unnest(range(k0, k1))::INT AS k FROM stretch WHERE k1 IS NOT NULL))
)"""
_SAMPLES_SQL = f"WITH {NETWORK_SQL}, {VERTEX_SQL}, {_RESAMPLE_SQL}"
# Pixels are negative and % keeps the sign, so remainders are made positive.
_DEM_SQL = """CASE WHEN ((px * 7 + py * 3) % 97 + 97) % 97 = 5 THEN -9999.0::DOUBLE WHEN ((px + py) % 89 + 89) % 89 = 1 THEN 0.0::DOUBLE
  ELSE 400.0::DOUBLE + 0.125::DOUBLE * ((px + 0.5::DOUBLE) * 2 + 470000) + 0.0625::DOUBLE * ((py + 0.5::DOUBLE) * 2 + 1104000) END"""
_BILINEAR_SQL = f"""corner AS (
  SELECT *, floor(x / 2 - 0.5) AS fx, floor(y / 2 - 0.5) AS fy, x / 2 - 0.5::DOUBLE AS gx, y / 2 - 0.5::DOUBLE AS gy FROM sample
), read AS MATERIALIZED (
  SELECT id, seq, k, parts, total, d, CASE WHEN bad THEN NULL ELSE (z00 * (1 - wx) + z10 * wx) * (1 - wy) + (z01 * (1 - wx) + z11 * wx) * wy END AS z
  FROM (SELECT *, gx - fx AS wx, gy - fy AS wy, {" OR ".join(f"z{a}{b} IN (0, -9999)" for a in (0, 1) for b in (0, 1))} AS bad
        FROM (SELECT *, {", ".join(f"{_DEM_SQL.replace('px', f'(fx + {a})').replace('py', f'(fy + {b})')} AS z{a}{b}" for a in (0, 1) for b in (0, 1))} FROM corner))
)"""
_PROFILE_KEYS = ["id", "seq", "structure"]


def _virtual_tiles(wanted: DataFrame) -> DataFrame:
    """The raster's tiles *wanted* (tx, ty), made by a rule."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            tiles = []
            for tx, ty in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                py, px = np.indices((TILE_PX, TILE_PX)) + np.array([ty, tx]).reshape(2, 1, 1) * TILE_PX
                z = 400 + 0.125 * ((px + 0.5) * 2 + 470000) + 0.0625 * ((py + 0.5) * 2 + 1104000)
                tiles.append(np.where((px * 7 + py * 3) % 97 == 5, profiles.NODATA, np.where((px + py) % 89 == 1, 0.0, z)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tiles, pa.binary())], ["tx", "ty", "data"])

    return wanted.select("tx", "ty").mapInArrow(kernel, "tx long, ty long, data binary")


def _read(spark, sf_dir):
    """Lines with the heights read along them."""
    with noted() as network_tables:
        lines = _lines(spark, sf_dir)
    read = profiles.heights(lines, _PROFILE_KEYS, _virtual_tiles, STEP_M, TILE_PX)
    release(spark, network_tables)  # the lines are written now, and the network is not read again
    return read


def _digest(values: Column) -> Column:
    """A hash of whole numbers in order, null as such; all of a line's values in one column."""
    return F.md5(F.array_join(F.transform(values, lambda v: v.cast("string")), ",", "null"))


def _digest_sql(value: str) -> str:
    return f"md5(string_agg(coalesce(({value})::VARCHAR, 'null'), ',' ORDER BY k))"


#: Values in hundredths, moved off the ties that whole metres and halves give.
_CENTI = lambda v: F.floor(v * 100 + 0.31).cast("long")
_CENTI_SQL = "floor({} * 100 + 0.31)::BIGINT".format


@query(f"{_SAMPLES_SQL} SELECT id, seq::INT AS seq, any_value(parts) AS parts, round(any_value(total), 4) AS length, {_digest_sql(_CENTI_SQL('x'))} AS x, {_digest_sql(_CENTI_SQL('y'))} AS y FROM sample GROUP BY id, seq")
def resample(spark, sf_dir):
    """Each line's samples every 10 m: their number, the length, and hashes of all their places."""
    # A line of a few hundred bytes becomes hundreds of samples, so lines are dealt by count, not by bytes.
    lines = _lines(spark, sf_dir).select("id", "seq", "x", "y").repartition(spark.sparkContext.defaultParallelism * 4)
    whole = profiles.resampled(lines, ["id", "seq"], STEP_M)
    at = lambda c: _digest(F.transform(c, _CENTI))
    return whole.select("id", "seq", "parts", F.round("length", 4).alias("length"), at("x").alias("x"), at("y").alias("y"))


@query(f"{_SAMPLES_SQL}, {_BILINEAR_SQL} SELECT id, seq::INT AS seq, count(*) AS samples, count(*) FILTER (WHERE z IS NULL) AS without, {_digest_sql(_CENTI_SQL('z'))} AS z FROM read GROUP BY id, seq")
def bilinear_plane(spark, sf_dir):
    """Heights read along each line: how many, how many without terrain, and a hash of all."""
    bad = F.size(F.filter("z", lambda v: v.isNull()))
    return _read(spark, sf_dir).select("id", "seq", F.size("z").cast("long").alias("samples"), bad.cast("long").alias("without"), _digest(F.transform("z", _CENTI)).alias("z"))


_OUTCOME_SQL = """judged AS MATERIALIZED (
  SELECT id, seq, any_value(structure) AS structure, any_value(total) AS length,
         count(*) FILTER (WHERE structure IS NULL OR k IN (0, parts)) AS n, count(*) FILTER (WHERE z IS NULL AND (structure IS NULL OR k IN (0, parts))) AS bad
  FROM read JOIN kept USING (id, seq) GROUP BY id, seq
)"""


@query(_SAMPLES_SQL + f""", {_BILINEAR_SQL}, {_OUTCOME_SQL}
SELECT count(*) AS candidates, count(*) FILTER (WHERE length > 0 AND bad = 0) AS kept, count(*) FILTER (WHERE length <= 0) AS degenerate,
       count(*) FILTER (WHERE length > 0 AND bad > 0 AND bad = n) AS nodata_whole, count(*) FILTER (WHERE length > 0 AND bad > 0 AND bad < n) AS nodata_partial,
       sum(bad)::BIGINT AS nodata_samples, count(*) FILTER (WHERE length > 0 AND bad = 0 AND structure IS NOT NULL) AS structures FROM judged""")
def nodata_drop_counts(spark, sf_dir):
    return profiles.outcome_counts(profiles.judged(_read(spark, sf_dir)))


@query(_SAMPLES_SQL + f""", {_BILINEAR_SQL}, {_OUTCOME_SQL}, ends AS (
  SELECT id, seq, any_value(judged.structure) AS structure, arg_min(z, k) AS a, arg_max(z, k) AS b FROM read JOIN judged USING (id, seq) WHERE bad = 0 AND length > 0 GROUP BY id, seq
), final AS (SELECT id, seq, k, parts, total, CASE WHEN structure IS NULL THEN z ELSE a + (b - a) * d / total END::FLOAT::DOUBLE AS z FROM read JOIN ends USING (id, seq))
SELECT id, seq::INT AS seq, any_value(parts) AS parts, {_digest_sql(_CENTI_SQL('z'))} AS z FROM final GROUP BY id, seq""")
def deck_interpolation(spark, sf_dir):
    """Kept profiles, structures on the line that joins their ends: a hash of the heights as 32-bit numbers."""
    kept = profiles.finished(profiles.judged(_read(spark, sf_dir)))
    return kept.select("id", "seq", "parts", _digest(F.transform(F.col("elevation_m").cast("array<double>"), _CENTI)).alias("z"))


@query(_SAMPLES_SQL + f""", {_BILINEAR_SQL}, {_OUTCOME_SQL} SELECT id, seq::INT AS seq FROM kept WHERE NOT EXISTS (FROM judged j WHERE j.id = kept.id AND j.seq = kept.seq AND bad = 0 AND length > 0)""")
def without_profile(spark, sf_dir):
    """Pieces that have no profile."""
    lines = materialize(_lines(spark, sf_dir).select(*_PROFILE_KEYS, "x", "y"), "lines")
    read = profiles.heights(lines, _PROFILE_KEYS, _virtual_tiles, STEP_M, TILE_PX)
    named = lambda df: df.withColumn("candidate_id", F.struct("id", "seq"))
    return profiles.without_profile(named(lines), named(profiles.finished(profiles.judged(read)))).select("id", "seq")


@query(f"WITH {NETWORK_SQL}, {_ENDS_SQL} SELECT candidate_id, foot, top, length FROM e")
def profile_ends(spark, sf_dir):
    return profiles.profile_ends(_profiles(_candidates(spark, sf_dir)))


def _way_runs(spark, sf_dir):
    """One run for each way: its forward candidates in order, where each starts at the end of the one before."""
    own = materialize(_candidates(spark, sf_dir), "candidates")
    whole = own.where("direction = 'forward'").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("seq", "candidate_id", "start_node_id", "end_node_id"))).alias("s"))
    meets = F.forall(arrays.indices(F.size("s") - 1), lambda i: F.get("s", i)["end_node_id"] == F.get("s", i + 1)["start_node_id"])
    return own, whole.where(meets).select(F.col("id").alias("run_id"), F.col("s.candidate_id").alias("candidate_ids"))


_RUNS_SQL = f"""f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) - 1 AS i, lag(nodes[-1]) OVER (PARTITION BY id ORDER BY seq) AS before FROM cand WHERE dir = 0),
good AS (SELECT id FROM f GROUP BY id HAVING bool_and(before IS NULL OR before = nodes[1])),
part_ AS (SELECT f.*, coalesce(sum((len(nodes) - 1) * 10) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM f JOIN good USING (id)),
joined AS (
  SELECT id AS run_id, i::INT AS i, k::INT AS k, (off + k * 10)::DOUBLE AS distance_m, {Z_SQL} AS elevation_m
  FROM (SELECT *, unnest(nodes) AS node, unnest(range(len(nodes))) AS k FROM part_) WHERE i = 0 OR k > 0
)"""


@query(f"WITH {NETWORK_SQL}, {_RUNS_SQL} SELECT * FROM joined")
def join_profiles(spark, sf_dir):
    own, chains = _way_runs(spark, sf_dir)
    return profiles.join_profiles(chains, _profiles(own), own.select("candidate_id", "start_node_id", "end_node_id"))


@query(f"""WITH {NETWORK_SQL}, {_RUNS_SQL}, held AS (SELECT run_id, i, k, distance_m, elevation_m FROM joined WHERE distance_m BETWEEN 5 - 1e-6 AND 10.0 * (run_id % 5) + 1e-6)
SELECT * FROM held WHERE run_id IN (SELECT run_id FROM held GROUP BY run_id HAVING count(*) >= 2)""")
def clip_profile(spark, sf_dir):
    own, chains = _way_runs(spark, sf_dir)
    windows = chains.select("run_id", F.lit(5.0).alias("start_m"), (F.col("run_id") % 5 * 10).cast("double").alias("end_m"))
    return profiles.clip(profiles.join_profiles(chains, _profiles(own)), windows).drop("start_m", "end_m")


# --- walk and detection --------------------------------------------------

_EDGES_SQL = "edges AS MATERIALIZED (SELECT a.candidate_id AS a, b.candidate_id AS b FROM e a JOIN e b ON a.t = b.s AND b.top > a.top WHERE a.top > a.foot AND b.top > b.foot)"


@query(f"WITH {NETWORK_SQL}, {_ENDS_SQL}, {_EDGES_SQL} SELECT a, b FROM edges")
def rising_edges(spark, sf_dir):
    return runs.rising_edges(_ends(spark, sf_dir))


#: Gain telescopes on the virtual network, whose heights belong to nodes: the best chain into a candidate begins at the lowest foot that reaches it.
_SWEEP_SQL = f"""WITH RECURSIVE {NETWORK_SQL}, {_ENDS_SQL}, {_EDGES_SQL}, reach AS (
  SELECT candidate_id, foot AS base FROM e WHERE top > foot
  UNION SELECT edges.b, reach.base FROM reach JOIN edges ON edges.a = reach.candidate_id
), ahead AS (
  SELECT candidate_id, top AS peak FROM e WHERE top > foot
  UNION SELECT edges.a, ahead.peak FROM ahead JOIN edges ON edges.b = ahead.candidate_id
), swept AS (
  SELECT e.candidate_id, foot, top, length, i.best_in, o.best_out FROM e
  JOIN (SELECT candidate_id, max(top - base) AS best_in FROM reach JOIN e USING (candidate_id) GROUP BY candidate_id) i USING (candidate_id)
  JOIN (SELECT candidate_id, max(peak - foot) AS best_out FROM ahead JOIN e USING (candidate_id) GROUP BY candidate_id) o USING (candidate_id)
)"""


@query(f"{_SWEEP_SQL} SELECT candidate_id, best_in FROM swept")
def dag_best_in(spark, sf_dir):
    return runs.sweeps(_ends(spark, sf_dir)).select("candidate_id", "best_in")


@query(f"{_SWEEP_SQL} SELECT candidate_id, best_out, best_in + best_out - (top - foot) AS through FROM swept")
def dag_best_out(spark, sf_dir):
    ends = _ends(spark, sf_dir)
    gain = ends.select("candidate_id", (F.col("top") - F.col("foot")).alias("gain"))
    return runs.sweeps(ends).join(gain, "candidate_id").select("candidate_id", "best_out", (F.col("best_in") + F.col("best_out") - F.col("gain")).alias("through"))


#: Short enough that runs on the virtual network, whose candidates are 10 m a node, are cut.
_MAX_RUN_M = 30.0
#: The cover, one candidate after the other, of those with an edge; all others are runs of their own.
_COVER_SQL = f"""{_SWEEP_SQL}, back AS (
  SELECT b AS k, arg_min(a, (-best_in, a)) AS p FROM edges JOIN swept ON candidate_id = a GROUP BY b
), onward AS MATERIALIZED (
  SELECT a AS k, arg_min(b, (-best_out, b)) AS c FROM edges JOIN swept ON candidate_id = b GROUP BY a
), linked AS MATERIALIZED (
  SELECT * FROM swept WHERE candidate_id IN (SELECT a FROM edges UNION SELECT b FROM edges)
), head AS (
  SELECT candidate_id AS k, candidate_id AS pos, [candidate_id] AS ids, [length] AS ms FROM linked
  UNION ALL SELECT head.k, p, list_prepend(p, ids), list_prepend(e.length, ms) FROM head JOIN back ON back.k = pos JOIN e ON e.candidate_id = p
), tail AS (
  SELECT candidate_id AS k, candidate_id AS pos, []::BIGINT[] AS ids, []::DOUBLE[] AS ms FROM linked
  UNION ALL SELECT tail.k, c, list_append(ids, c), list_append(ms, e.length) FROM tail JOIN onward ON onward.k = pos JOIN e ON e.candidate_id = c
), whole AS (
  SELECT h.k, h.ids || t.ids AS ids, h.ms || t.ms AS ms, len(h.ids) AS mine
  FROM (SELECT k, arg_max(ids, len(ids)) AS ids, arg_max(ms, len(ms)) AS ms FROM head GROUP BY k) h
  JOIN (SELECT k, arg_max(ids, len(ids)) AS ids, arg_max(ms, len(ms)) AS ms FROM tail GROUP BY k) t USING (k)
), front AS (
  SELECT *, least(mine, coalesce(list_min(list_filter(range(1, len(ms) + 1), lambda i: list_sum(ms[i:]) <= {_MAX_RUN_M})), mine)) AS f FROM whole
), shortened AS (
  SELECT k, ids[f:greatest(mine, coalesce(list_max(list_filter(range(f, len(ms) + 1), lambda j: list_sum(ms[f:j]) <= {_MAX_RUN_M})), mine))] AS ids FROM front
), turn AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY best_in + best_out - (top - foot) DESC, candidate_id) AS n, candidate_id AS k, ids FROM linked JOIN shortened ON k = candidate_id
), taken AS (
  SELECT 0::BIGINT AS n, []::BIGINT[] AS covered, NULL::BIGINT[] AS ids
  UNION ALL SELECT turn.n, CASE WHEN list_contains(covered, k) THEN covered ELSE covered || turn.ids END, CASE WHEN list_contains(covered, k) THEN NULL ELSE turn.ids END
  FROM taken JOIN turn ON turn.n = taken.n + 1
), run AS (
  SELECT DISTINCT ids FROM taken WHERE ids IS NOT NULL
  UNION ALL SELECT [candidate_id] FROM swept WHERE candidate_id NOT IN (SELECT candidate_id FROM linked)
)"""


def _runs(spark, sf_dir):
    ends = materialize(_ends(spark, sf_dir), "ends")
    return ends, runs.ascending_runs(ends, runs.Walk(max_run_m=_MAX_RUN_M))


@query(f"{_COVER_SQL} SELECT array_to_string(ids, ',') AS candidate_ids, len(ids)::INT AS n FROM run")
def ascending_runs(spark, sf_dir):
    return _runs(spark, sf_dir)[1].select(_ids("candidate_ids").alias("candidate_ids"), F.size("candidate_ids").alias("n"))


@query(f"""{_COVER_SQL}, step AS (SELECT ids, unnest(ids) AS candidate_id FROM run), metre AS (SELECT ids, sum(length) AS m FROM step JOIN e USING (candidate_id) GROUP BY ids)
SELECT (SELECT count(*) FROM run) AS runs, (SELECT count(*) FROM step) AS candidate_instances, (SELECT max(m) FROM metre) AS longest_run_m,
       (SELECT len(arg_min(ids, (-m, ids))) FROM metre) AS longest_run_candidates, count(*) AS rising, count(*) FILTER (WHERE candidate_id IN (SELECT candidate_id FROM step)) AS covered,
       round(100.0::DOUBLE * count(*) FILTER (WHERE candidate_id IN (SELECT candidate_id FROM step)) / count(*), 3) AS coverage_pct FROM swept""")
def run_coverage(spark, sf_dir):
    ends, found = _runs(spark, sf_dir)
    return runs.run_metrics(found, ends)


@query()
def detect_climbs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    # A profile for each user: the running sum of their events' values, 10 m apart.
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("event_id")
    samples = events.select(F.col("user_id").alias("run_id"), (F.row_number().over(order) * 10).cast("double").alias("distance_m"), F.sum(F.abs("value") / 100).over(order).alias("elevation_m"))
    return detect.scored(detect.detect_climbs(samples))


_SCORE_SQL = "s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 100 AS dist_m, l_discount * 100 AS avg_grade FROM lineitem), d AS (SELECT *, dist_m / 1000 * avg_grade * avg_grade AS score FROM s)"
_CATEGORY_SQL = "CASE " + " ".join(f"WHEN score >= {least} THEN '{name}'" for name, least in detect.ASO) + " END"


def _scored(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_quantity") * 100).alias("dist_m"), (F.col("l_discount") * 100).alias("avg_grade"))
    return detect.scored(lines)


@query(f"WITH {_SCORE_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN score >= 8 THEN score END, 6) AS difficulty, {_CATEGORY_SQL} AS category FROM d")
def aso_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("difficulty", 6).alias("difficulty"), "category")


_NAMES_SQL = ", ".join(f"({i}, '{c}')" for i, c in enumerate([*anchors.CATEGORIES, "null"]))


@query(f"WITH {_SCORE_SQL}, c AS (SELECT coalesce({_CATEGORY_SQL}, 'null') AS category FROM d) SELECT place, n.category, count(c.category) AS n FROM (VALUES {_NAMES_SQL}) AS n(place, category) LEFT JOIN c USING (category) GROUP BY ALL")
def category_histogram(spark, sf_dir):
    return anchors.category_histogram(_scored(spark, sf_dir))


# --- anchors -------------------------------------------------------------


def _chains(spark, sf_dir):
    """A climb for each order: its lines' lengths, ways and candidates in order."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))).alias("s"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_totalprice").alias("gain"), "o_custkey")
    return lines.join(orders, "run_id").withColumns({
        "climb_index": F.lit(0),
        "lengths": F.col("s.l_quantity"),
        "candidate_ids": F.transform("s", lambda x: x["l_partkey"] % 5),
        "way_refs": F.transform("s", lambda x: x["l_suppkey"] % 3),
    }).drop("s")


_CHAINS_SQL = """chain AS (
  SELECT l_orderkey AS run_id, list(l_quantity ORDER BY o) AS lengths, list(l_partkey % 5 ORDER BY o) AS candidate_ids, list(l_suppkey % 3 ORDER BY o) AS way_refs
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS o FROM lineitem) GROUP BY l_orderkey
), c AS (SELECT chain.*, o_totalprice AS gain, o_custkey FROM chain JOIN orders ON o_orderkey = run_id)"""


@query(f"""WITH {_CHAINS_SQL}, t AS (
  SELECT run_id, lengths, len(lengths) AS n, list_sum(lengths) * 0.2::DOUBLE AS s, list_sum(lengths) * 0.7::DOUBLE AS e,
         [list_sum(list_slice(lengths, 1, i)) FOR i IN range(1, len(lengths) + 1)] AS cum FROM c
), f AS (
  SELECT *, least(len(list_filter(cum, lambda v: v <= s + 1)), n - 1) AS first FROM t
), l AS (
  SELECT *, least(greatest(len(list_filter(cum, lambda v: v < e - 1)), first), n - 1) AS last, CASE WHEN first = 0 THEN 0 ELSE cum[first] END AS base FROM f
) SELECT run_id, first::INT AS first, last::INT AS last, round(s - base, 6) AS start_m, round(e - base, 6) AS end_m FROM l""")
def covered_range(spark, sf_dir):
    total = F.aggregate("lengths", F.lit(0.0), lambda a, x: a + x)
    found = _chains(spark, sf_dir).select("run_id", anchors.covered_range(F.col("lengths"), total * 0.2, total * 0.7).alias("r"))
    return found.select("run_id", "r.first", "r.last", F.round("r.start_m", 6).alias("start_m"), F.round("r.end_m", 6).alias("end_m"))


_COLLAPSED_SQL = "list_transform(list_filter(list_zip(way_refs, range(len(way_refs))), lambda p: p[2] = 0 OR p[1] <> way_refs[p[2]]), lambda p: p[1])"


@query(f"WITH {_CHAINS_SQL} SELECT run_id, array_to_string({_COLLAPSED_SQL}, ',') AS way_refs FROM c")
def collapse_repeats(spark, sf_dir):
    return _chains(spark, sf_dir).select("run_id", _ids(arrays.collapse_repeats(F.col("way_refs"))).alias("way_refs"))


_SUFFIX_SQL = f"""{_CHAINS_SQL}, r AS (SELECT run_id, candidate_ids, array_to_string(candidate_ids, ',') AS chain, row_number() OVER (ORDER BY len(candidate_ids) DESC, gain DESC, run_id) AS place FROM c),
offered AS (SELECT array_to_string(list_slice(candidate_ids, k, len(candidate_ids)), ',') AS chain, place FROM (SELECT *, unnest(range(1, len(candidate_ids) + 1)) AS k FROM r)),
first AS (SELECT chain, min(place) AS keeper FROM offered GROUP BY chain),
owner AS (SELECT r.run_id, r.place, first.keeper FROM r JOIN first USING (chain)),
kept AS (SELECT r.run_id, r.chain, (SELECT count(*) FROM owner o WHERE o.keeper = r.place) - 1 AS collapsed FROM r JOIN owner USING (run_id) WHERE owner.keeper = owner.place)"""


@query(f"WITH {_SUFFIX_SQL} SELECT run_id, chain AS candidate_ids, collapsed::INT AS collapsed FROM kept")
def suffix_dedupe(spark, sf_dir):
    return anchors.drop_suffixes(_chains(spark, sf_dir)).select("run_id", _ids("candidate_ids").alias("candidate_ids"), "collapsed")


def _identified(spark, sf_dir):
    own = _chains(spark, sf_dir).withColumn("way_refs", arrays.collapse_repeats(F.col("way_refs")))
    return own.withColumns({"start_node_id": F.col("run_id") % 7, "end_node_id": F.col("run_id") % 11, "collapsed": (F.col("run_id") % 3).cast("int")})


_IDENTITY_SQL = f"""{_CHAINS_SQL}, k AS (SELECT run_id, gain, len(candidate_ids) AS steps, {_COLLAPSED_SQL} AS way_refs, run_id % 7 AS s, run_id % 11 AS t, run_id % 3 AS collapsed FROM c),
u AS (SELECT *, row_number() OVER (PARTITION BY way_refs, s, t ORDER BY gain DESC, run_id) AS place, sum(collapsed) OVER (PARTITION BY way_refs, s, t) AS every, count(*) OVER (PARTITION BY way_refs, s, t) - 1 AS collisions FROM k),
anchor AS (SELECT row_number() OVER (ORDER BY run_id) - 1 AS climb_id, run_id, array_to_string(way_refs, ',') AS way_refs, len(way_refs) AS n, s, t, (every + collisions)::INT AS collapsed, collisions::INT AS collisions, steps FROM u WHERE place = 1)"""


@query(f"WITH {_IDENTITY_SQL} SELECT climb_id, run_id, way_refs, s AS start_node_id, t AS end_node_id, collapsed, collisions FROM anchor")
def unique_anchor(spark, sf_dir):
    return anchors.unique_anchors(_identified(spark, sf_dir)).select("climb_id", "run_id", _ids("way_refs").alias("way_refs"), "start_node_id", "end_node_id", "collapsed", "collisions")


@query(f"""WITH {_IDENTITY_SQL}, o AS (SELECT DISTINCT way_refs, s, t FROM k WHERE run_id % 2 = 0), w AS (SELECT DISTINCT way_refs, s, t FROM k WHERE run_id % 2 = 1 OR run_id % 3 > 0)
SELECT (SELECT count(*) FROM (SELECT * FROM o INTERSECT SELECT * FROM w)) AS kept, (SELECT count(*) FROM (SELECT * FROM w EXCEPT SELECT * FROM o)) AS new, (SELECT count(*) FROM (SELECT * FROM o EXCEPT SELECT * FROM w)) AS lost""")
def anchor_compare(spark, sf_dir):
    own = _identified(spark, sf_dir)
    return anchors.compare(own.where("run_id % 2 = 0"), own.where("run_id % 2 = 1 OR run_id % 3 > 0"))


@query(f"WITH {_IDENTITY_SQL} SELECT least(n, 10)::INT AS size, count(*) AS climbs, max(n)::INT AS longest, count(*) FILTER (WHERE steps > 1) AS multi_candidate, (SELECT count(*) FROM (SELECT t FROM anchor GROUP BY t HAVING count(*) > 1)) AS multi_climb_summits FROM anchor GROUP BY least(n, 10)")
def anchor_counts(spark, sf_dir):
    return anchors.anchor_counts(anchors.unique_anchors(_identified(spark, sf_dir)))


@query(f"""WITH {_SUFFIX_SQL}, lasting AS (SELECT kept.run_id, kept.collapsed, c.gain, {_COLLAPSED_SQL} AS way_refs FROM kept JOIN c USING (run_id)),
same AS (SELECT way_refs, run_id % 7 AS s, run_id % 11 AS t, sum(collapsed) AS collapsed, count(*) - 1 AS collisions FROM lasting GROUP BY ALL)
SELECT (SELECT count(*) FROM c) AS detections, count(*) AS climbs, sum(collapsed)::BIGINT AS collapsed, sum(collisions)::BIGINT AS collisions FROM same""")
def anchor_accounts(spark, sf_dir):
    own = materialize(_chains(spark, sf_dir), "chains")
    lasting = anchors.drop_suffixes(own).withColumns({"way_refs": arrays.collapse_repeats(F.col("way_refs")), "start_node_id": F.col("run_id") % 7, "end_node_id": F.col("run_id") % 11})
    return anchors.accounts(own, anchors.unique_anchors(materialize(lasting, "lasting")))


@query(f"WITH {_IDENTITY_SQL} SELECT t AS end_node_id, count(*) AS approaches FROM anchor GROUP BY t HAVING count(*) > 1")
def approach_variants(spark, sf_dir):
    return warehouse.approaches(anchors.unique_anchors(_identified(spark, sf_dir)))


@query(f"""WITH {NETWORK_SQL}, {_RUNS_SQL}, m AS (
  SELECT id AS run_id, list(candidate_id ORDER BY i) AS ids, list(nodes[1] ORDER BY i) AS s, list(nodes[-1] ORDER BY i) AS t, list((len(nodes) - 1) * 10.0::DOUBLE ORDER BY i) AS lengths FROM part_ GROUP BY id
), g AS (
  SELECT *, len(ids) AS n, list_sum(lengths) * 0.25::DOUBLE AS a, list_sum(lengths) * 0.75::DOUBLE AS b, [list_sum(list_slice(lengths, 1, i)) FOR i IN range(1, len(lengths) + 1)] AS cum FROM m
), h AS (SELECT *, least(len(list_filter(cum, lambda v: v <= a + 1)), n - 1) AS first FROM g),
l AS (SELECT *, least(greatest(len(list_filter(cum, lambda v: v < b - 1)), first), n - 1) AS last, CASE WHEN first = 0 THEN 0 ELSE cum[first] END AS base FROM h)
SELECT run_id, array_to_string(list_slice(ids, first + 1, last + 1), ',') AS candidate_ids, run_id::VARCHAR AS way_refs, s[first + 1] AS start_node_id, t[last + 1] AS end_node_id, round(a - base, 6) AS start_m, round(b - base, 6) AS end_m FROM l""")
def anchor_build(spark, sf_dir):
    own, chains = _way_runs(spark, sf_dir)
    lengths = profiles.profile_ends(_profiles(own)).select("candidate_id", "length")
    known = own.select("candidate_id", F.col("id").alias("way_ref"), "start_node_id", "end_node_id").join(lengths, "candidate_id")
    total = chains.select("run_id", F.explode("candidate_ids").alias("candidate_id")).join(lengths, "candidate_id").groupBy("run_id").agg(F.sum("length").alias("m"))
    climbs = chains.join(total, "run_id").select("run_id", F.lit(0).alias("climb_index"), "candidate_ids", (F.col("m") * 0.25).alias("start_m"), (F.col("m") * 0.75).alias("end_m"))
    found = anchors.anchored(climbs, known)
    return found.select("run_id", _ids("candidate_ids").alias("candidate_ids"), _ids("way_refs").alias("way_refs"), "start_node_id", "end_node_id", F.round("start_m", 6).alias("start_m"), F.round("end_m", 6).alias("end_m"))


# --- warehouse -----------------------------------------------------------

_POINTS_SQL = "point AS (SELECT c_custkey, 12 + (c_custkey * 7 % 1600) / 200.0::DOUBLE AS lon, 48.5::DOUBLE + (c_custkey * 13 % 560) / 200.0::DOUBLE AS lat FROM customer)"
_REGIONS_SQL = "box AS (SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, 12 + (n_nationkey % 5) * 1.5::DOUBLE AS x0, 48.5::DOUBLE + (n_nationkey // 5) * 0.5::DOUBLE AS y0 FROM nation)"


def _points(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", (F.lit(12) + (key * 7 % 1600) / F.lit(200.0)).alias("lon"), (F.lit(48.5) + (key * 13 % 560) / F.lit(200.0)).alias("lat"))


def _regions(spark, sf_dir):
    key = F.col("n_nationkey")
    x, y = F.lit(12) + (key % 5) * F.lit(1.5), F.lit(48.5) + F.floor(key / 5) * F.lit(0.5)
    corner = lambda dx, dy: F.struct((x + dx).alias("lon"), (y + dy).alias("lat"))
    ring = F.array(corner(0.0, 0.0), corner(1.5, 0.0), corner(1.5, 0.5), corner(0.0, 0.5), corner(0.0, 0.0))
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("code"), ring.alias("ring"))


_ASSIGNED_SQL = f"{_POINTS_SQL}, {_REGIONS_SQL}, assigned AS (SELECT c_custkey, min(code) AS region_code FROM point LEFT JOIN box ON lon BETWEEN x0 AND x0 + 1.5 AND lat BETWEEN y0 AND y0 + 0.5 GROUP BY c_custkey)"


@query(f"WITH {_ASSIGNED_SQL} SELECT c_custkey, region_code FROM assigned")
def assign_region(spark, sf_dir):
    return warehouse.assign_region(_points(spark, sf_dir), _regions(spark, sf_dir), ["c_custkey"]).select("c_custkey", "region_code")


@query(f"WITH {_ASSIGNED_SQL} SELECT coalesce(region_code, 'outside') AS region_code, count(*) AS n FROM assigned GROUP BY ALL")
def outside_dropped(spark, sf_dir):
    found = warehouse.assign_region(_points(spark, sf_dir), _regions(spark, sf_dir), ["c_custkey"])
    return found.groupBy(F.coalesce("region_code", F.lit("outside")).alias("region_code")).agg(F.count("*").alias("n"))


@query(f"WITH {_ASSIGNED_SQL} SELECT c_custkey, '© OpenStreetMap contributors' AS attribution FROM assigned WHERE region_code = 'N07'")
def climbs_in_region(spark, sf_dir):
    found = warehouse.assign_region(_points(spark, sf_dir), _regions(spark, sf_dir), ["c_custkey"])
    return warehouse.in_region(found, "N07").select("c_custkey", "attribution")


@query("SELECT c_custkey, '© OpenStreetMap contributors' AS attribution FROM customer WHERE lower(replace(c_name, '#', '-')) = (SELECT lower(replace(min(c_name), '#', '-')) FROM customer WHERE c_custkey = 7)")
def climb_by_slug(spark, sf_dir):
    own = table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("slug"))
    slug = own.where("c_custkey = 7").agg(F.min("slug")).first()[0]
    return warehouse.by_slug(own, slug).select("c_custkey", "attribution")


def _distance_sql(lon0: str, lat0: str, lon1: str, lat1: str) -> str:
    e2 = (2 - 1 / 298.257223563) / 298.257223563
    w = f"sqrt(1 - {e2!r}::DOUBLE * pow(sin(radians(({lat0} + {lat1}) / 2)), 2))"
    return f"sqrt(pow(radians({lat1} - {lat0}) * {6378137.0 * (1 - e2)!r}::DOUBLE / pow({w}, 3), 2) + pow(radians({lon1} - {lon0}) * 6378137.0::DOUBLE * cos(radians(({lat0} + {lat1}) / 2)) / {w}, 2))"


@query(f"""WITH {_POINTS_SQL}, ask AS (SELECT s_suppkey, 12 + (s_suppkey * 11 % 1600) / 200.0::DOUBLE AS q_lon, 48.5::DOUBLE + (s_suppkey * 17 % 560) / 200.0::DOUBLE AS q_lat FROM supplier)
SELECT s_suppkey, c_custkey, round(d, 3) AS distance FROM (SELECT *, {_distance_sql("q_lon", "q_lat", "lon", "lat")} AS d FROM ask, point) WHERE d <= 1500""")
def dwithin_top(spark, sf_dir):
    key = F.col("s_suppkey")
    asked = table(spark, sf_dir, "supplier").select("s_suppkey", (F.lit(12) + (key * 11 % 1600) / F.lit(200.0)).alias("lon"), (F.lit(48.5) + (key * 17 % 560) / F.lit(200.0)).alias("lat"))
    return within(_points(spark, sf_dir), asked, 1500.0).select("s_suppkey", "c_custkey", F.round("distance", 3).alias("distance"))


@query(f"""WITH {NETWORK_SQL}, {VERTEX_SQL}, d AS (SELECT id, seq, i, 18 + (x + 470000) / 100000 AS lon, 49.8::DOUBLE + (y + 1104000) / 100000 AS lat FROM vertex),
s AS (SELECT id, seq, lon, lat, lag(lon) OVER o AS lon0, lag(lat) OVER o AS lat0 FROM d WINDOW o AS (PARTITION BY id, seq ORDER BY i))
SELECT id, seq::INT AS seq, round(sum(coalesce({_distance_sql("lon0", "lat0", "lon", "lat")}, 0)), 3) AS length_m FROM s GROUP BY id, seq""")
def line_length_m(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("lon", F.transform("x", lambda v: 18 + (v + 470000) / 100000)).withColumn("lat", F.transform("y", lambda v: 49.8 + (v + 1104000) / 100000))
    return lines.select("id", "seq", F.round(line_length(F.col("lon"), F.col("lat")), 3).alias("length_m"))


@query(f"WITH {_IDENTITY_SQL}, p AS (SELECT DISTINCT array_to_string(way_refs, ',') AS way_refs, s, t, len(way_refs) AS n FROM k) SELECT climb_id, p.n::INT AS n FROM p JOIN anchor USING (way_refs, s, t)")
def ids_by_anchor(spark, sf_dir):
    own = _identified(spark, sf_dir)
    lines = own.select("way_refs", "start_node_id", "end_node_id", F.size("way_refs").alias("n")).distinct()
    return warehouse.with_ids(lines, anchors.unique_anchors(own)).select("climb_id", "n")


@query(f"WITH {_ASSIGNED_SQL}, o AS (SELECT o_custkey AS c_custkey, sum(o_orderkey % 7)::BIGINT AS points FROM orders GROUP BY o_custkey) SELECT coalesce(region_code, 'outside') AS region_code, count(*) AS climbs, coalesce(sum(points), 0)::BIGINT AS points FROM assigned LEFT JOIN o USING (c_custkey) GROUP BY ALL")
def region_histogram(spark, sf_dir):
    found = warehouse.assign_region(_points(spark, sf_dir), _regions(spark, sf_dir), ["c_custkey"]).withColumnRenamed("c_custkey", "climb_id")
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("climb_id"), arrays.indices((F.col("o_orderkey") % 7).cast("int")).alias("geom"))
    return warehouse.region_histogram(found, lines)


@query(f"""WITH {_POINTS_SQL}, ask AS (SELECT s_suppkey, 12 + (s_suppkey * 11 % 1600) / 200.0::DOUBLE AS q_lon, 48.5::DOUBLE + (s_suppkey * 17 % 560) / 200.0::DOUBLE AS q_lat FROM supplier)
SELECT s_suppkey AS ask_id, c_custkey AS climb_id FROM ask, point WHERE {_distance_sql("q_lon", "q_lat", "lon", "lat")} <= 3000 AND {_distance_sql("(q_lon + 0.01)", "q_lat", "(lon + 0.02)", "lat")} <= 5000""")
def resolve_climbs(spark, sf_dir):
    key = F.col("s_suppkey")
    lon, lat = F.lit(12) + (key * 11 % 1600) / F.lit(200.0), F.lit(48.5) + (key * 17 % 560) / F.lit(200.0)
    asked = table(spark, sf_dir, "supplier").select(key.alias("ask_id"), lon.alias("top_lon"), lat.alias("top_lat"), (lon + 0.01).alias("start_lon"), lat.alias("start_lat"))
    climbs = _points(spark, sf_dir).select(F.col("c_custkey").alias("climb_id"), F.col("lon").alias("top_lon"), F.col("lat").alias("top_lat"), (F.col("lon") + 0.02).alias("start_lon"), F.col("lat").alias("start_lat"))
    return warehouse.resolve(climbs, asked, 3000.0, 5000.0)


@query(r"""SELECT doc_id, try_cast(regexp_extract_all(w, 'AUTHORITY\["EPSG","([0-9]+)"\]', 1)[-1] AS INT) AS epsg FROM (SELECT doc_id, 'PROJCS["' || lang || '",AUTHORITY["EPSG","4156"]]' || CASE WHEN doc_id % 2 = 0 THEN ',AUTHORITY["EPSG","' || doc_id || '"]' ELSE '' END AS w FROM documents)""")
def declared_crs(spark, sf_dir):
    from .provenance import declared_epsg

    more = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(',AUTHORITY["EPSG","'), F.col("doc_id").cast("string"), F.lit('"]'))).otherwise("")
    wkt = F.concat(F.lit('PROJCS["'), "lang", F.lit('",AUTHORITY["EPSG","4156"]]'), more)
    return table(spark, sf_dir, "documents").select("doc_id", declared_epsg(wkt).alias("epsg"))


_BROKEN_SQL = """climb AS (
  SELECT o_orderkey AS climb_id, CASE WHEN o_orderkey % 17 > 0 THEN [o_custkey] ELSE [] END AS way_refs, o_orderkey % 101 AS s, o_custkey % 5 AS t,
         (o_orderkey % 19)::DOUBLE AS dist_m, (o_orderkey % 23)::DOUBLE AS gain, CASE o_orderkey % 29 WHEN 0 THEN '9' WHEN 1 THEN NULL ELSE '4' END AS category,
         o_orderkey % 31 AS n_elevations, CASE WHEN o_orderkey % 37 = 0 THEN 3 ELSE o_orderkey % 31 END AS n_vertices,
         CASE WHEN o_orderkey % 2 = 0 THEN 'climb-' || (o_orderkey % 5003) END AS slug, CASE WHEN o_orderkey % 41 = 0 THEN 'XX' ELSE 'CZ080' END AS region_code
  FROM orders)"""


@query(f"""WITH {_BROKEN_SQL}
SELECT 'way_refs_empty' AS rule, climb_id FROM climb WHERE len(way_refs) < 1 UNION ALL SELECT 'dist_not_positive', climb_id FROM climb WHERE dist_m <= 0
UNION ALL SELECT 'gain_not_positive', climb_id FROM climb WHERE gain <= 0 UNION ALL SELECT 'category_unknown', climb_id FROM climb WHERE category NOT IN ('HC', '1', '2', '3', '4', 'uncategorized')
UNION ALL SELECT 'vertices_differ', climb_id FROM climb WHERE n_elevations <> n_vertices UNION ALL SELECT 'profile_empty', climb_id FROM climb WHERE n_elevations = 0
UNION ALL SELECT 'anchor_repeats', max(climb_id) FROM climb GROUP BY way_refs, s, t HAVING count(*) > 1
UNION ALL SELECT 'slug_repeats', max(climb_id) FROM climb WHERE slug IS NOT NULL GROUP BY slug HAVING count(*) > 1
UNION ALL SELECT 'region_unknown', climb_id FROM climb WHERE region_code <> 'CZ080'""")
def constraint_violations(spark, sf_dir):
    k = F.col("o_orderkey")
    empty = F.array().cast("array<bigint>")
    size = (k % 31).cast("int")
    row = lambda n: F.transform(arrays.indices(n), lambda i: i.cast("float"))
    climbs = table(spark, sf_dir, "orders").select(
        k.alias("climb_id"), F.lit(1).alias("derivation_id"), F.when(k % 17 > 0, F.array("o_custkey")).otherwise(empty).alias("way_refs"),
        (k % 101).alias("start_node_id"), (F.col("o_custkey") % 5).alias("end_node_id"), (k % 19).cast("double").alias("dist_m"), (k % 23).cast("double").alias("gain"),
        F.when(k % 29 == 0, "9").when(k % 29 == 1, F.lit(None)).otherwise("4").alias("category"), row(size).alias("elevations"),
        row(F.when(k % 37 == 0, 3).otherwise(size)).alias("geom"), F.when(k % 2 == 0, F.concat(F.lit("climb-"), (k % 5003).cast("string"))).alias("slug"),
        F.when(k % 41 == 0, "XX").otherwise("CZ080").alias("region_code"),
    )
    regions = spark.createDataFrame(warehouse.REGIONS, "code string, name string, slug string, osm_relation_id long")
    return warehouse.violations(climbs, regions)


@query("SELECT o_orderpriority AS derivation_id, count(*) AS climbs FROM orders GROUP BY ALL")
def climbs_by_derivation(spark, sf_dir):
    return warehouse.by_derivation(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("derivation_id"), F.col("o_orderkey").alias("climb_id")))


@query("SELECT 'lineitem' AS name, count(*) AS n, (SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS columns FROM lineitem")
def footer_reads(spark, sf_dir):
    """Rows and columns of a table from its footers: no column is read."""
    path = f"{sf_dir}/lineitem.parquet"
    held = [("lineitem", tables.rows_in(spark, path), len(tables.columns_of(spark, path)))]
    return spark.createDataFrame(held, "name string, n long, columns long")


@query("SELECT min(o_orderkey) AS id, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' GROUP BY ALL")
def derivation_repeat(spark, sf_dir):
    known = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority")
    wanted = spark.createDataFrame([("O", "1-URGENT")], "o_orderstatus string, o_orderpriority string")
    return warehouse.matching_derivation(known, wanted)


@query("SELECT doc_id, regexp_extract(line, '^([a-z_]+):\\s+(.*?)\\s*$', 1) AS key, regexp_extract(line, '^([a-z_]+):\\s+(.*?)\\s*$', 2) AS value FROM (SELECT doc_id, 'doc_' || lang || ': ' || source || '/' || n_chars || '  ' AS line FROM documents)")
def version_fields(spark, sf_dir):
    from .provenance import field

    line = F.concat(F.lit("doc_"), "lang", F.lit(": "), "source", F.lit("/"), F.col("n_chars").cast("string"), F.lit("  "))
    return table(spark, sf_dir, "documents").select("doc_id", field(line, 1).alias("key"), field(line, 2).alias("value"))


@query("""SELECT event_id, regexp_extract(props, '"k": *([0-9]+)', 1) AS k FROM events""")
def manifest_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT o_orderkey, sha256('{\"predicate\":\"' || o_orderpriority || '\",\"structure\":\"' || o_orderstatus || '\"}') AS signature FROM orders")
def stage_signature(spark, sf_dir):
    from .provenance import signature

    return table(spark, sf_dir, "orders").select("o_orderkey", signature({"predicate": F.col("o_orderpriority"), "structure": F.col("o_orderstatus")}).alias("signature"))


@query("SELECT c_custkey, 'SRID=4326;POINT(' || (c_custkey % 90) || ' ' || (c_nationkey) || ')' AS ewkt FROM customer")
def ewkt_point(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", warehouse.point(F.col("c_custkey") % 90, F.col("c_nationkey")).alias("ewkt"))


@query("""SELECT o_orderkey FROM orders WHERE sha256(o_orderkey::VARCHAR) <> CASE WHEN o_orderkey % 13 = 0 THEN 'changed' ELSE sha256(o_orderkey::VARCHAR) END""")
def digest_chain(spark, sf_dir):
    from .provenance import broken_links

    own = table(spark, sf_dir, "orders").select("o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"))
    wanted = own.select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, "changed").otherwise(F.col("sha256")).alias("expected"))
    return broken_links(wanted, own, ["o_orderkey"]).select("o_orderkey")


@query()
def derive_anchors(spark, sf_dir):
    """The derivation on the virtual network from given profiles, not sampled ones, up to numbered anchors."""
    own = _candidates(spark, sf_dir).checkpoint()
    # Heights a tenth as steep and lengths ten times as far give grades that roads have.
    distance = F.transform("nodes", lambda n, i: (i * 1500).cast("double"))
    profiled = own.select("candidate_id", distance.alias("distance_m"), F.transform("nodes", lambda n: (height(n) / 10).cast("float")).alias("elevation_m")).checkpoint()
    found = derive.anchors_of(derive.climbs_of(own, profiled), own, profiled)
    return found.select("climb_id", "run_id", "climb_index", _ids("candidate_ids").alias("candidate_ids"), _ids("way_refs").alias("way_refs"), "start_node_id", "end_node_id", "gain", "category", "collapsed")
