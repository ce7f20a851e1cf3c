"""A data source for OpenStreetMap extracts (.osm.pbf): nodes, ways and relations, a partition for a range of blobs.

    spark.dataSource.register(OsmPbf)
    spark.read.format("osm_pbf").option("kind", "ways").load(path)
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.geo import covers

SCHEMAS = {
    "nodes": "id long, lon double, lat double",
    "ways": "id long, nodes array<long>, tags map<string,string>",
    "relations": "id long, version int, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>",
}
#: Bytes of an extract that one partition reads.
PARTITION_BYTES = 32 << 20


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            width = {1: 8, 5: 4}[kind]
            value, at = data[at : at + width], at + width
        yield key >> 3, value


def _message(data: bytes) -> dict[int, list]:
    out: dict[int, list] = {}
    for number, value in _fields(data):
        out.setdefault(number, []).append(value)
    return out


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = _varint(data, at)
        out.append(value)
    return out


def _signed(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def _running(data: bytes) -> list[int]:
    total, out = 0, []
    for v in _packed(data):
        total += _signed(v)
        out.append(total)
    return out


def _open(path: str):
    """The file for reading: a local path, or a URI of a store that Arrow reads, as executors have no JVM at hand."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def blobs(path: str) -> Iterator[tuple[int, int, str]]:
    """Offset, size and type of each blob; only the headers are read."""
    with _open(path) as f:
        while head := f.read(4):
            header = _message(f.read(struct.unpack(">I", head)[0]))
            size = header[3][0]
            yield f.tell(), size, header[1][0].decode()
            f.seek(size, 1)


def _blob(path: str, offset: int, size: int) -> bytes:
    with _open(path) as f:
        f.seek(offset)
        blob = _message(f.read(size))
    return blob[1][0] if 1 in blob else zlib.decompress(blob[3][0])


def read_header(path: str) -> dict:
    """Replication timestamp (UTC), sequence, base url and writing program; what is absent is None."""
    offset, size, kind = next(blobs(path))
    if kind != "OSMHeader":
        raise ValueError(f"{path} does not start with a header")
    found = _message(_blob(path, offset, size))
    one = lambda n: found[n][0] if n in found else None
    text = lambda n: one(n).decode() if one(n) is not None else None
    stamp = one(32)
    return {
        "replication_ts": None if stamp is None else datetime.fromtimestamp(stamp, UTC).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "replication_seq": one(33),
        "replication_base_url": text(34),
        "writing_program": text(16),
    }


def _tags(strings: list[str], keys: bytes, values: bytes) -> dict[str, str]:
    return {strings[k]: strings[v] for k, v in zip(_packed(keys), _packed(values), strict=True)}


def decode_block(raw: bytes, kind: str) -> Iterator[tuple]:
    """Rows of one kind in a primitive block."""
    block = _message(raw)
    strings = [s.decode() for s in _message(block[1][0]).get(1, [])]
    grain, lat0, lon0 = (block[n][0] if n in block else default for n, default in ((17, 100), (19, 0), (20, 0)))
    lat0, lon0 = (v - (1 << 64) if v >> 63 else v for v in (lat0, lon0))
    degrees = lambda v, origin: (origin + grain * v) / 1e9
    for group in block.get(2, []):
        for number, value in _fields(group):
            if number == 1 and kind == "nodes":
                node = _message(value)
                yield _signed(node[1][0]), degrees(_signed(node[9][0]), lon0), degrees(_signed(node[8][0]), lat0)
            elif number == 2 and kind == "nodes":
                dense = _message(value)
                for i, lat, lon in zip(*(_running(dense[n][0]) for n in (1, 8, 9)), strict=True):
                    yield i, degrees(lon, lon0), degrees(lat, lat0)
            elif number == 3 and kind == "ways":
                way = _message(value)
                yield way[1][0], _running(b"".join(way.get(8, []))), _tags(strings, b"".join(way.get(2, [])), b"".join(way.get(3, [])))
            elif number == 4 and kind == "relations":
                rel = _message(value)
                info = _message(rel[4][0]) if 4 in rel else {}
                roles, refs, types = _packed(b"".join(rel.get(8, []))), _running(b"".join(rel.get(9, []))), _packed(b"".join(rel.get(10, [])))
                members = [(("node", "way", "relation")[t], r, strings[s]) for t, r, s in zip(types, refs, roles, strict=True)]
                yield rel[1][0], info.get(1, [None])[0], members, _tags(strings, b"".join(rel.get(2, [])), b"".join(rel.get(3, [])))


class _Blobs(InputPartition):
    def __init__(self, path: str, where: list[tuple[int, int]]):
        self.path, self.where = path, where


class _Reader(DataSourceReader):
    def __init__(self, path: str, kind: str):
        self.path, self.kind = path, kind

    def partitions(self) -> list[_Blobs]:
        out, held, size = [], [], 0
        for offset, length, kind in blobs(self.path):
            if kind == "OSMData":
                held.append((offset, length))
                size += length
                if size >= PARTITION_BYTES:
                    out.append(_Blobs(self.path, held))
                    held, size = [], 0
        return [*out, *([_Blobs(self.path, held)] if held else [])] or [_Blobs(self.path, [])]

    def read(self, partition: _Blobs) -> Iterator[tuple]:
        for offset, size in partition.where:
            yield from decode_block(_blob(partition.path, offset, size), self.kind)


class OsmPbf(DataSource):
    """Format ``osm_pbf``; option ``kind``: nodes, ways or relations."""

    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMAS[self._kind()]

    def _kind(self) -> str:
        kind = self.options.get("kind", "ways")
        if kind not in SCHEMAS:
            raise ValueError(f"kind must be one of {', '.join(SCHEMAS)}")
        return kind

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self._kind())


def read_osm(spark: SparkSession, path: str, kind: str) -> DataFrame:
    spark.dataSource.register(OsmPbf)
    return spark.read.format("osm_pbf").option("kind", kind).load(path)


def stitch(ways: list[list]) -> list[list]:
    """Closed rings of node lists that meet end to end; pieces that close no ring raise."""
    rest, rings = [list(w) for w in ways if len(w) > 1], []
    while rest:
        ring = rest.pop()
        while ring[0] != ring[-1]:
            for i, w in enumerate(rest):
                if ring[-1] in (w[0], w[-1]):
                    rest.pop(i)
                    ring += (w if w[0] == ring[-1] else w[::-1])[1:]
                    break
            else:
                raise ValueError("the boundary does not close")
        rings.append(ring)
    return rings


def _within(ring: list, point) -> bool:
    """Whether the ring of (lon, lat) holds the point, by the crossings of a ray."""
    x, y = point
    return sum((b[1] > y) != (a[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, ring[1:], strict=False)) % 2 == 1


_RING = "array<struct<lon:double,lat:double>>"


def boundaries(relations: DataFrame, ways: DataFrame, nodes: DataFrame, ids: list[int]) -> DataFrame:
    """Areas (relation_id, version, ring, holes) of the relations *ids*: an outer ring each, with the inner rings that lie in it.

    A relation that is absent or does not close raises; so does one whose ways or nodes are missing.
    """
    wanted = relations.where(F.col("id").isin(ids))
    missing = set(ids) - {r.id for r in wanted.select("id").collect()}  # as many as were asked for
    if missing:
        raise ValueError(f"relations not in the extract: {sorted(missing)}")
    parts = wanted.select(F.col("id").alias("relation_id"), "version", F.explode("members").alias("m")).where("m.type = 'way' AND m.role IN ('outer', 'inner', '')")
    lines = parts.select("relation_id", "version", (F.col("m.role") == "inner").alias("hole"), F.col("m.ref").alias("id")).join(ways.select("id", "nodes"), "id", "left")
    points = lines.select("relation_id", "version", "hole", F.col("id").alias("way"), F.posexplode_outer("nodes").alias("i", "id")).join(nodes, "id", "left")

    def assemble(pdf):
        import pandas as pd

        if pdf["lon"].isna().any():
            raise ValueError(f"relation {pdf['relation_id'].iloc[0]} has ways or nodes that are not in the extract")
        at = {n: (lon, lat) for n, lon, lat in zip(pdf["id"], pdf["lon"], pdf["lat"], strict=True)}
        rings = {hole: [[at[n] for n in r] for r in stitch([g.sort_values("i")["id"].tolist() for _, g in part.groupby("way")])] for hole, part in pdf.groupby("hole")}
        points = lambda ring: [{"lon": x, "lat": y} for x, y in ring]
        rows = [(pdf["relation_id"].iloc[0], pdf["version"].iloc[0], points(r), [points(h) for h in rings.get(True, []) if _within(r, h[0])]) for r in rings.get(False, [])]
        return pd.DataFrame(rows, columns=["relation_id", "version", "ring", "holes"])

    return points.groupBy("relation_id").applyInPandas(assemble, f"relation_id long, version int, ring {_RING}, holes array<{_RING}>")


def region_areas(relations: DataFrame, ways: DataFrame, nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """Areas of *regions* (code, osm_relation_id), in order of code; all of them must be in the extract."""
    codes = regions.select("code", F.col("osm_relation_id").alias("relation_id"))
    ids = [r.relation_id for r in codes.select("relation_id").distinct().collect()]  # a table of a country's regions
    return boundaries(relations, ways, nodes, ids).join(codes, "relation_id").select("code", "relation_id", "version", "ring", "holes").orderBy("code")


def inside(ring: Column, holes: Column, lon: Column, lat: Column) -> Column:
    """Whether an area holds a point: within or on its ring and not within a hole."""
    return covers(ring, lon, lat) & ~F.exists(F.coalesce(holes, F.array().cast(f"array<{_RING}>")), lambda h: covers(h, lon, lat))
