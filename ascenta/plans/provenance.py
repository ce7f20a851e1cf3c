"""Provenance and resuming: manifests, signatures, digests and key-value files."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import bytes_at, publish_bytes

_FIELD = r"^([a-z_]+):\s+(.*?)\s*$"


class StageError(SystemExit):
    """An operator's mistake, told in one line: the stage, then what is wrong."""

    def __init__(self, stage: str, what: str):
        super().__init__(f"{stage}: {what}")


def field(line: Column, group: int) -> Column:
    """Key (1) or value (2) of a ``key: value`` line; empty where it is none."""
    return F.regexp_extract(line, _FIELD, group)


def read_fields(text: str, wanted: list[str]) -> dict[str, str]:
    """The wanted fields of a key-value file; a repeated or missing key, or a sha that isn't 40 hex digits, raises."""
    found: dict[str, str] = {}
    for line in text.splitlines():
        if m := re.match(_FIELD, line):
            if m[1] in found:
                raise StageError("version", f"{m[1]} occurs twice")
            found[m[1]] = m[2]
    for key in wanted:
        if key not in found:
            raise StageError("version", f"{key} is missing")
        if key.endswith("sha") and not re.fullmatch("[0-9a-f]{40}", found[key]):
            raise StageError("version", f"{key} is not a commit")
    return {k: found[k] for k in wanted}


def declared_epsg(wkt: Column) -> Column:
    """The code of the last EPSG authority in a coordinate system's text; null for none."""
    return F.try_element_at(F.regexp_extract_all(wkt, F.lit(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]'), F.lit(1)), F.lit(-1)).cast("int")


def signature(values: Mapping[str, Column | str]) -> Column:
    """SHA-256 of the values as a JSON object with sorted keys, as a column."""
    parts = [F.concat(F.lit(f'"{k}":"'), v if isinstance(v, Column) else F.lit(v), F.lit('"')) for k, v in sorted(values.items())]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")), 256)


def signature_of(values: Mapping) -> str:
    """The same for plain values."""
    return hashlib.sha256(json.dumps(values, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def broken_links(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of *expected* (keys, expected) whose digest isn't the sha256 of the same key in *actual*."""
    return expected.join(actual.select(*keys, F.col("sha256").alias("expected")), [*keys, "expected"], "left_anti")


def leaves(value, *keys: str):
    """(dotted key, value) of everything in a manifest that is neither an object nor a list, in order."""
    inner = value.items() if isinstance(value, Mapping) else enumerate(value) if isinstance(value, (list, tuple)) else None
    if inner is None:
        yield ".".join(keys), value
        return
    for key, item in inner:
        yield from leaves(item, *keys, str(key))


#: Strings that only mean something on one machine.
_ON_THIS_MACHINE = re.compile(r"/|file:/|[A-Za-z]:[\\/]")


def publish_record(spark: SparkSession, path: str, manifest: Mapping) -> None:
    """A manifest as sorted JSON, without ``run``, which differs each time; strings that are absolute paths are refused, all by their keys."""
    lasting = {k: v for k, v in manifest.items() if k != "run"}
    local = [key for key, value in leaves(lasting) if isinstance(value, str) and _ON_THIS_MACHINE.match(value)]
    if local:
        raise StageError("record", f"absolute paths at {', '.join(local)}")
    publish_bytes(spark, path, json.dumps(lasting, indent=2, sort_keys=True).encode() + b"\n")


def record_at(spark: SparkSession, path: str) -> dict:
    """A manifest; one that is missing, no JSON or no object proves nothing and is empty."""
    try:
        held = json.loads(bytes_at(spark, path) or b"")
    except ValueError:
        held = None
    return held if isinstance(held, dict) else {}


def may_skip(spark: SparkSession, output: str, manifest: str, wanted: Mapping, force: bool = False) -> bool:
    """Whether a stage has nothing to do: not forced, its manifest agrees with all that is *wanted*, and its output is there."""
    held = record_at(spark, manifest)
    if force or not held or any(key not in held or held[key] != value for key, value in wanted.items()):
        return False
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(output)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


#: What each stage's signature is made of, by dotted key of its manifest.
SIGNED = {
    "candidates": ("osm_snapshot.sha256", "boundary.relation_id", "boundary.relation_version", "boundary.buffer_m", "way_filter.version", "way_filter.structure"),
    "dem": ("candidates.sha256", "dem.product", "dem.crs", "dem.resolution_m", "grid.tile_px"),
    "profiles": ("candidates.sha256", "dem.sha256", "sampling.step_m", "sampling.transform"),
    "climbs": ("profiles.sha256", "derivation.engine_commit", "derivation.scoring_model", "derivation.engine_config_override", "walk.max_run_m", "walk.dip_drop_m", "walk.dip_gap_m", "walk.dip_ratio"),
    "anchors": ("climbs.sha256", "candidates.sha256"),
}


def stage_signature_of(stage: str, manifest: Mapping) -> str:
    """The signature of a stage from the fields that it is signed by; all that are missing are named."""
    held = dict(leaves(manifest))
    for key in SIGNED[stage]:  # an object, such as an override, is signed whole
        value = manifest
        for step in key.split("."):
            value = value.get(step) if isinstance(value, Mapping) else None
        if isinstance(value, (Mapping, list)):
            held[key] = value
    if lacking := [key for key in SIGNED[stage] if key not in held]:
        raise StageError(stage, f"the manifest has no {', '.join(lacking)}")
    return signature_of({key: held[key] for key in SIGNED[stage]})


def fetch_plan(tiles: int, bytes_each: int, rate: int = 3_000_000) -> dict[str, float]:
    """What a dry run says: tiles, bytes and seconds at a rate."""
    return {"tiles": tiles, "bytes": tiles * bytes_each, "seconds": tiles * bytes_each / rate}


#: Columns of a derivation and where the manifests hold them.
DERIVATION = {
    "way_filter_version": ("candidates", "way_filter", "version"),
    "structure_version": ("candidates", "way_filter", "structure"),
    "osm_snapshot_sha256": ("candidates", "osm_snapshot", "sha256"),
    "osm_snapshot_replication_ts": ("candidates", "osm_snapshot", "replication_ts"),
    "osm_snapshot_seq": ("candidates", "osm_snapshot", "replication_seq"),
    "boundary_relation_id": ("candidates", "boundary", "relation_id"),
    "boundary_relation_version": ("candidates", "boundary", "relation_version"),
    "boundary_buffer_m": ("candidates", "boundary", "buffer_m"),
    "boundary_assignment": ("candidates", "boundary", "assignment"),
    "dem_product": ("dem", "dem", "product"),
    "dem_route": ("dem", "dem", "route"),
    "dem_resolution_m": ("dem", "dem", "resolution_m"),
    "dem_crs": ("dem", "dem", "crs"),
    "dem_vertical_crs": ("dem", "dem", "vertical_crs"),
    "dem_nodata_value": ("dem", "dem", "nodata_value"),
    "dem_fetched_at": ("dem", "dem", "fetched_at"),
}


def derivation_row(manifests: Mapping[str, Mapping], snapshot_url: str, dem_sha256: str) -> dict:
    """The derivation's columns out of the stages' manifests; what a manifest lacks or misstates is named."""
    row = {"osm_snapshot_url": snapshot_url, "dem_manifest_sha256": dem_sha256}
    for column, path in DERIVATION.items():
        value = manifests
        for step in path:
            if not isinstance(value, Mapping) or step not in value:
                raise StageError("load", f"{path[0]} manifest has no {'.'.join(path[1:])}")
            value = value[step]
        row[column] = value
    try:
        row["osm_snapshot_seq"] = int(row["osm_snapshot_seq"])
        whole = int(row["boundary_buffer_m"])
    except (TypeError, ValueError) as wrong:
        raise StageError("load", f"a number is misstated: {wrong}") from wrong
    if whole != row["boundary_buffer_m"]:
        raise StageError("load", f"boundary.buffer_m {row['boundary_buffer_m']} is not a whole number of metres")
    engine = manifests.get("climbs", {}).get("derivation")
    if not isinstance(engine, Mapping):
        raise StageError("load", "climbs manifest has no derivation")
    return {**engine, **row, "boundary_buffer_m": whole}


def vouch(links: list[tuple[str, str | None, str | None]]) -> None:
    """Each link is (what, digest recorded by the later stage, digest found); the first that differs is named."""
    for what, recorded, found in links:
        if not recorded or recorded != found:
            raise StageError("load", f"{what} is not what the next stage was derived from")


def same_grid(recorded: Mapping, wanted: Mapping) -> None:
    """A mosaic that was begun on another grid is refused."""
    for key, value in wanted.items():
        if recorded and recorded.get(key, value) != value:
            raise StageError("dem", f"{key} was {recorded[key]}, now {value}; begin a new folder")


def complete(planned: int, held: int) -> None:
    """A mosaic with tiles missing is neither recorded nor sampled."""
    if held < planned:
        raise StageError("dem", f"{planned - held} of {planned} tiles are missing")
