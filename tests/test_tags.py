"""The tag rules against a plain statement of them, over all combinations of the values that they tell apart."""

import itertools

import pytest
from pyspark.sql import functions as F

from ascenta.functions.tags import is_cyclable, structure_of

VALUES = {
    "highway": [None, "primary", "secondary_link", "living_street", "road", "motorway", "steps", "track", "service"],
    "tracktype": [None, "grade2", "grade5"],
    "surface": [None, "paving_stones", "sand"],
    "service": [None, "parking_aisle"],
    "access": [None, "private", "no", "customers"],
    "bicycle": [None, "no", "permissive", "dismount"],
}
SIDES = {"bridge": [None, "no", "aqueduct", "yes"], "tunnel": [None, "no", "culvert"], "covered": [None, "no", "arcade"]}
OPEN = {"primary", "secondary_link", "living_street", "road"}


def maps(values):
    for combination in itertools.product(*values.values()):
        yield {k: v for k, v in zip(values, combination, strict=True) if v is not None}


def ridden(tags):
    kind = tags.get("highway")
    if kind == "track":
        fit = tags.get("tracktype") == "grade2" or tags.get("surface") == "paving_stones"
    elif kind == "service":
        fit = "service" not in tags
    else:
        fit = kind in OPEN
    closed = tags.get("access") in ("private", "no") and tags.get("bicycle") != "permissive"
    return fit and not closed and tags.get("bicycle") != "no"


def covered_by(tags):
    kinds = [k for k in SIDES if tags.get(k, "no") != "no"]
    return kinds[0] if kinds else None


@pytest.mark.parametrize(("of", "rule", "values"), [(is_cyclable, ridden, VALUES), (structure_of, covered_by, SIDES)])
def test_every_combination(spark, of, rule, values):
    cases = [*maps(values), None]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, tags map<string,string>")
    found = {r.i: r.v for r in df.select("i", of(F.col("tags")).alias("v")).collect()}
    assert found == {i: rule(t or {}) for i, t in enumerate(cases)}


def test_a_right_to_ride_opens_no_other_road(spark):
    cases = [{"highway": h, "bicycle": "permissive"} for h in ("motorway", "steps", "track")] + [{"highway": "service", "service": "alley", "bicycle": "permissive"}]
    df = spark.createDataFrame([(t,) for t in cases], "tags map<string,string>")
    assert not any(r.v for r in df.select(is_cyclable(F.col("tags")).alias("v")).collect())
