"""Published tables: regions of summits, checks, repeats, publication by pointer, and the reader's queries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import covers, line_length, within
from .anchors import CATEGORIES

ATTRIBUTION = "© OpenStreetMap contributors"
SCORING_MODELS = ["aso", "garmin", "hiking"]
# Region code, name, slug and boundary relation.
REGIONS = [
    ("CZ010", "Praha", "praha", 435514),
    ("CZ020", "Středočeský kraj", "stredocesky", 442397),
    ("CZ031", "Jihočeský kraj", "jihocesky", 442321),
    ("CZ032", "Plzeňský kraj", "plzensky", 442466),
    ("CZ041", "Karlovarský kraj", "karlovarsky", 442314),
    ("CZ042", "Ústecký kraj", "ustecky", 442452),
    ("CZ051", "Liberecký kraj", "liberecky", 442455),
    ("CZ052", "Královéhradecký kraj", "kralovehradecky", 442463),
    ("CZ053", "Pardubický kraj", "pardubicky", 442460),
    ("CZ063", "Kraj Vysočina", "vysocina", 442453),
    ("CZ064", "Jihomoravský kraj", "jihomoravsky", 442311),
    ("CZ071", "Olomoucký kraj", "olomoucky", 442459),
    ("CZ072", "Zlínský kraj", "zlinsky", 442449),
    ("CZ080", "Moravskoslezský kraj", "moravskoslezsky", 442461),
]


def assign_region(points: DataFrame, regions: DataFrame, keys: list[str], cell: float = 0.25) -> DataFrame:
    """*points* (keys, lon, lat) with region_code: the first by code of *regions* (code, ring) that covers each; null for none.

    Regions are dealt over the grid cells of their boxes, so the join has an
    equality; the ray cast on the ring decides, its border counting as inside.
    """
    edges = regions.select("code", "ring", *(F.array_min(F.transform("ring", lambda p: p[c])).alias(f"{c}0") for c in ("lon", "lat")), *(F.array_max(F.transform("ring", lambda p: p[c])).alias(f"{c}1") for c in ("lon", "lat")))
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    cells = edges.withColumn("__cx", F.explode(F.sequence(at("lon0"), at("lon1")))).withColumn("__cy", F.explode(F.sequence(at("lat0"), at("lat1"))))
    placed = points.withColumns({"__cx": at("lon"), "__cy": at("lat")})
    inside = F.col("lon").between(F.col("lon0"), F.col("lon1")) & F.col("lat").between(F.col("lat0"), F.col("lat1"))
    hits = placed.join(cells, ["__cx", "__cy"]).where(inside).where(covers(F.col("ring"), F.col("lon"), F.col("lat")))
    first = hits.groupBy(*keys).agg(F.min("code").alias("region_code"))
    return points.join(first, keys, "left")


def violations(climbs: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows that break a rule of the climb table, as (rule, climb_id); an empty result means it may be published."""
    key = ["derivation_id", "way_refs", "start_node_id", "end_node_id"]
    rules: dict[str, Column] = {
        "way_refs_empty": F.coalesce(F.size("way_refs"), F.lit(0)) < 1,
        "dist_not_positive": ~F.coalesce(F.col("dist_m") > 0, F.lit(False)),
        "gain_not_positive": ~F.coalesce(F.col("gain") > 0, F.lit(False)),
        "category_unknown": F.col("category").isNotNull() & ~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False)),
        "vertices_differ": F.coalesce(F.size("elevations"), F.lit(0)) != F.coalesce(F.size("geom"), F.lit(0)),
        "profile_empty": F.coalesce(F.size("elevations"), F.lit(0)) == 0,
    }
    each = F.explode(F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())), lambda r: r.isNotNull()))
    rows = climbs.select(each.alias("rule"), "climb_id")
    again = climbs.groupBy(*key).agg(F.count("*").alias("n"), F.max("climb_id").alias("climb_id")).where("n > 1")
    slugs = climbs.where("slug IS NOT NULL").groupBy("derivation_id", "slug").agg(F.count("*").alias("n"), F.max("climb_id").alias("climb_id")).where("n > 1")
    strange = climbs.where("region_code IS NOT NULL").join(regions.select(F.col("code").alias("region_code")), "region_code", "left_anti")
    named = lambda df, rule: df.select(F.lit(rule).alias("rule"), "climb_id")
    return rows.unionByName(named(again, "anchor_repeats")).unionByName(named(slugs, "slug_repeats")).unionByName(named(strange, "region_unknown"))


def derivation_faults(derivations: DataFrame) -> DataFrame:
    """Derivation rows that break a rule: an engine commit of 40 hex digits, a known model, assignment by summit, an override that is an object."""
    override = F.col("engine_config_override")
    checks = {
        "commit": ~F.coalesce(F.col("engine_commit").rlike("^[0-9a-f]{40}$"), F.lit(False)),
        "model": ~F.coalesce(F.col("scoring_model").isin(*SCORING_MODELS), F.lit(False)),
        "assignment": ~F.coalesce(F.col("boundary_assignment") == "summit", F.lit(False)),
        "override": override.isNotNull() & ~F.coalesce(override.rlike(r"^\s*\{") & F.try_parse_json(override).isNotNull(), F.lit(False)),
    }
    return derivations.select("id", F.explode(F.filter(F.array(*(F.when(v, F.lit(k)) for k, v in checks.items())), lambda r: r.isNotNull())).alias("rule"))


def matching_derivation(derivations: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first derivation by id with all the columns of the one-row *wanted*; empty for none."""
    same = derivations.join(F.broadcast(wanted), wanted.columns, "left_semi")  # one row
    return same.orderBy("id").limit(1)


def checked(climbs: DataFrame) -> DataFrame:
    """Climbs as they are; one with an unknown category or without coordinates raises when it is read."""
    known = F.col("category").isNull() | F.col("category").isin(*CATEGORIES)
    placed = F.col("start_lon").isNotNull() & F.col("start_lat").isNotNull() & F.col("top_lon").isNotNull() & F.col("top_lat").isNotNull()
    rules = F.coalesce(
        F.assert_true(known, F.concat(F.lit("unknown category "), F.coalesce("category", F.lit("")))),
        F.assert_true(placed, F.concat(F.lit("no coordinates for climb "), F.col("climb_id").cast("string"))),
        F.lit(True),
    )
    return climbs.where(rules)


def by_derivation(climbs: DataFrame) -> DataFrame:
    """How many climbs each derivation has."""
    return climbs.groupBy("derivation_id").agg(F.count("climb_id").alias("climbs"))


def with_ids(profiles: DataFrame, climbs: DataFrame) -> DataFrame:
    """Profiles by identity (way_refs, start_node_id, end_node_id) with the climb_id that identity got: never by order."""
    key = ["way_refs", "start_node_id", "end_node_id"]
    return profiles.join(climbs.select("climb_id", *key), key)


def region_histogram(climbs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Climbs and profile points (climb_id, geom) by region, "outside" for none."""
    points = profiles.groupBy("climb_id").agg(F.sum(F.size("geom")).alias("points"))
    joined = climbs.join(points, "climb_id", "left")
    return joined.groupBy(F.coalesce("region_code", F.lit("outside")).alias("region_code")).agg(F.count("*").alias("climbs"), F.coalesce(F.sum("points"), F.lit(0)).alias("points"))


def point(lon: Column, lat: Column) -> Column:
    """A point as EWKT, longitude first."""
    return F.concat(F.lit("SRID=4326;POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def linestring(lon: Column, lat: Column) -> Column:
    """A line as EWKT."""
    pairs = F.transform(F.arrays_zip(lon.alias("lon"), lat.alias("lat")), lambda p: F.concat(p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string")))
    return F.concat(F.lit("SRID=4326;LINESTRING("), F.array_join(pairs, ", "), F.lit(")"))


class Warehouse:
    """Versioned climbs under one folder, partitioned by derivation and region.

    A derivation's tables are written whole to a staging folder of their own and
    become readable when one rename moves it among the published, so a load that
    fails leaves nothing behind. Paths are Hadoop's, so any store will do.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def derivations(self) -> list[int]:
        fs, at = self._fs(f"{self.path}/published")
        return sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(at)) if fs.exists(at) else []

    def provenance(self, derivation_id: int) -> dict:
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/published/derivation_id={derivation_id}/provenance")
        return json.loads(text.first()[0])

    def load(self, provenance: dict, climbs: DataFrame, profiles: DataFrame, force: bool = False) -> int:
        """Publish a derivation and return its id; equal provenance is refused unless forced."""
        known = self.derivations()
        if not force and any(self.provenance(i) == provenance for i in known):
            raise ValueError("load: a derivation with this provenance is published already")
        new = max(known, default=0) + 1
        staged = f"{self.path}/staging/derivation_id={new}"
        fs, at = self._fs(staged)
        fs.delete(at, True)
        self.spark.createDataFrame([(json.dumps(provenance, sort_keys=True),)], "value string").coalesce(1).write.text(f"{staged}/provenance")
        climbs.write.partitionBy("region_code").parquet(f"{staged}/climb")
        profiles.write.parquet(f"{staged}/climb_profile")
        done, target = self._fs(f"{self.path}/published/derivation_id={new}")
        done.mkdirs(target.getParent())
        if not fs.rename(at, target):
            raise OSError(f"load: {staged} could not be published")
        return new

    def drop(self, derivation_id: int) -> None:
        """Remove a derivation with its climbs and profiles."""
        fs, at = self._fs(f"{self.path}/published/derivation_id={derivation_id}")
        fs.delete(at, True)

    def table(self, name: str, derivation_id: int | None = None) -> DataFrame:
        """climb or climb_profile of one derivation, the newest by default."""
        which = derivation_id or max(self.derivations())
        return self.spark.read.parquet(f"{self.path}/published/derivation_id={which}/{name}").withColumn("derivation_id", F.lit(which))


def by_slug(climbs: DataFrame, slug: str) -> DataFrame:
    return climbs.where(F.col("slug") == slug).withColumn("attribution", F.lit(ATTRIBUTION))


def in_region(climbs: DataFrame, code: str) -> DataFrame:
    return climbs.where(F.col("region_code") == code).withColumn("attribution", F.lit(ATTRIBUTION))


def resolve(climbs: DataFrame, asked: DataFrame, top_m: float = 150.0, start_m: float = 250.0) -> DataFrame:
    """Climbs whose top and start lie near the asked ones: asked (ask_id, top_lon, top_lat, start_lon, start_lat)."""
    tops = within(climbs.select("climb_id", F.col("top_lon").alias("lon"), F.col("top_lat").alias("lat")), asked.select("ask_id", F.col("top_lon").alias("lon"), F.col("top_lat").alias("lat")), top_m)
    starts = within(climbs.select("climb_id", F.col("start_lon").alias("lon"), F.col("start_lat").alias("lat")), asked.select("ask_id", F.col("start_lon").alias("lon"), F.col("start_lat").alias("lat")), start_m)
    return tops.select("ask_id", "climb_id").join(starts.select("ask_id", "climb_id"), ["ask_id", "climb_id"])


def approaches(climbs: DataFrame) -> DataFrame:
    """Summits that several climbs reach, with how many."""
    return climbs.groupBy("end_node_id").agg(F.count("*").alias("approaches")).where("approaches > 1")


def profile_lengths(profiles: DataFrame) -> DataFrame:
    """Metres, points and ends of each profile line (climb_id, lon, lat)."""
    return profiles.select("climb_id", line_length(F.col("lon"), F.col("lat")).alias("length_m"), F.size("lon").alias("n_points"), F.element_at("lon", 1).alias("start_lon"), F.element_at("lat", 1).alias("start_lat"))
