"""Which ways are ridden, and which structure a way is on, from its tag map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREDICATE_VERSION = "cyclable/v2"
STRUCTURE_VERSION = "structure/v1"

# Fixed values.
RIDDEN_HIGHWAY = ["motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street", "road", "cycleway"]
RIDDEN_TRACKTYPE = ["grade1", "grade2"]
PAVED_SURFACE = ["asphalt", "chipseal", "concrete", "concrete:lanes", "concrete:plates", "paving_stones"]
BARRED_ACCESS = ["private", "no"]
GRANTED_BICYCLE = ["yes", "designated", "permissive"]
STRUCTURES = ["bridge", "tunnel", "covered"]


def tag(tags: Column, key: str) -> Column:
    """The value of a tag; null where it's missing or the map is null."""
    return F.try_element_at(tags, F.lit(key))


def _one_of(tags: Column, key: str, values: list[str]) -> Column:
    """Whether a tag has one of the values: false, not null, where it is missing."""
    return F.coalesce(tag(tags, key).isin(*values), F.lit(False))


def is_cyclable(tags: Column) -> Column:
    """Whether a way with these tags is ridden; never null."""
    track = _one_of(tags, "highway", ["track"]) & (_one_of(tags, "tracktype", RIDDEN_TRACKTYPE) | _one_of(tags, "surface", PAVED_SURFACE))
    service = _one_of(tags, "highway", ["service"]) & tag(tags, "service").isNull()
    road = _one_of(tags, "highway", RIDDEN_HIGHWAY) | track | service
    barred = _one_of(tags, "bicycle", ["no"]) | (_one_of(tags, "access", BARRED_ACCESS) & ~_one_of(tags, "bicycle", GRANTED_BICYCLE))
    return road & ~barred


def structure_of(tags: Column) -> Column:
    """The first of bridge, tunnel and covered whose value is present and not "no", else null."""
    return F.coalesce(*(F.when(tag(tags, s) != "no", F.lit(s)) for s in STRUCTURES))
