import json

import pytest
from pyspark.sql import functions as F

from ascenta.operators import warehouse
from ascenta.plans import provenance
from ascenta.sources import terrain


def box(a, b):
    return [(a, 49.0), (b, 49.0), (b, 49.1), (a, 49.1), (a, 49.0)]


def test_regions(spark):
    regions = spark.createDataFrame([("CZ072", box(17.9, 18.0)), ("CZ080", box(18.0, 18.1))], "code string, ring array<struct<lon:double,lat:double>>")
    points = spark.createDataFrame([(1, 17.95, 49.05), (2, 18.05, 49.05), (3, 18.05, 49.95), (4, 18.0, 49.05)], "id int, lon double, lat double")
    assert {r.id: r.region_code for r in warehouse.assign_region(points, regions, ["id"]).collect()} == {1: "CZ072", 2: "CZ080", 3: None, 4: "CZ072"}


def test_publication(spark, tmp_path):
    store = warehouse.Warehouse(spark, f"file://{tmp_path}/w")
    climbs = spark.createDataFrame([(1, "CZ080", "a"), (2, "CZ072", None)], "climb_id long, region_code string, slug string")
    lines = spark.createDataFrame([(1, [18.29, 18.30], [49.83, 49.84])], "climb_id long, lon array<double>, lat array<double>")
    assert store.load({"tuning": 1}, climbs, lines) == 1
    with pytest.raises(ValueError, match="provenance"):
        store.load({"tuning": 1}, climbs, lines)
    assert store.load({"tuning": 2}, climbs, lines) == 2 and store.load({"tuning": 1}, climbs, lines, force=True) == 3
    failing = climbs.withColumn("slug", F.raise_error(F.lit("torn")).cast("string"))
    with pytest.raises(Exception, match="torn"):
        store.load({"tuning": 4}, failing, lines)
    assert store.derivations() == [1, 2, 3]
    assert warehouse.in_region(store.table("climb"), "CZ080").first().climb_id == 1 and warehouse.by_slug(store.table("climb", 1), "a").count() == 1
    length = warehouse.profile_lengths(store.table("climb_profile", 2)).first()
    assert 1000 < length.length_m < 1500 and length.n_points == 2
    store.drop(2)
    assert store.derivations() == [1, 3]


def test_derivation_rules(spark):
    good = ("0" * 40, "aso", "summit", None)
    rows = [(0, *good), (1, "xyz", *good[1:]), (2, good[0], "own", *good[2:]), (3, *good[:2], "start", None), (4, *good[:3], "[1]"), (5, *good[:3], '{"a": 1}'), (6, *good[:3], "null")]
    df = spark.createDataFrame(rows, "id int, engine_commit string, scoring_model string, boundary_assignment string, engine_config_override string")
    assert {(r.id, r.rule) for r in warehouse.derivation_faults(df).collect()} == {(1, "commit"), (2, "model"), (3, "assignment"), (4, "override"), (6, "override")}


def test_resolution(spark):
    climbs = spark.createDataFrame([(1, 18.30, 49.84, 18.29, 49.83), (2, 18.30, 49.84, 18.5, 49.83)], "climb_id int, top_lon double, top_lat double, start_lon double, start_lat double")
    asked = spark.createDataFrame([(5, 18.3005, 49.8401, 18.2905, 49.8301)], "ask_id int, top_lon double, top_lat double, start_lon double, start_lat double")
    assert [tuple(r) for r in warehouse.resolve(climbs, asked).collect()] == [(5, 1)]


def test_records(spark, tmp_path):
    at, out = f"file://{tmp_path}/deep/er/stage.json", f"file://{tmp_path}/table"
    provenance.publish_record(spark, at, {"n": [1, {"x": None}], "run": {"host": "/here"}})
    assert json.loads((tmp_path / "deep/er/stage.json").read_text()) == {"n": [1, {"x": None}]}
    provenance.publish_record(spark, at, {"counts": 5})
    assert provenance.record_at(spark, at) == {"counts": 5} and len(list((tmp_path / "deep/er").glob("stage*"))) == 1
    with pytest.raises(SystemExit, match=r"record: absolute paths at from\.0\.pbf, to, win$"):
        provenance.publish_record(spark, at, {"from": [{"pbf": "file:/a"}, "b/c"], "to": "/d", "win": "C:\\e", "url": "https://x/y"})
    assert provenance.record_at(spark, at) == {"counts": 5}
    assert not provenance.may_skip(spark, out, at, {"counts": 5})
    spark.range(1).write.parquet(out)
    assert provenance.may_skip(spark, out, at, {"counts": 5}) and provenance.may_skip(spark, out, at, {})
    assert not any((provenance.may_skip(spark, out, at, {"counts": 6}), provenance.may_skip(spark, out, at, {"other": None}), provenance.may_skip(spark, out, at, {}, force=True)))
    for torn in (b"{", b"[1]", b""):
        provenance.publish_bytes(spark, at, torn)
        assert provenance.record_at(spark, at) == {} and not provenance.may_skip(spark, out, at, {})
    assert provenance.record_at(spark, f"file://{tmp_path}/none") == {}


def test_stage_signatures():
    manifest = {"climbs": {"sha256": "c"}, "candidates": {"sha256": "d"}, "counts": {"n": 3}}
    one = provenance.stage_signature_of("anchors", manifest)
    assert one == provenance.stage_signature_of("anchors", manifest | {"counts": {"n": 4}}) != provenance.stage_signature_of("anchors", manifest | {"climbs": {"sha256": "x"}})
    with pytest.raises(SystemExit, match=r"profiles: the manifest has no dem\.sha256, sampling\.step_m"):
        provenance.stage_signature_of("profiles", {"candidates": {"sha256": "d"}, "sampling": {"transform": "t"}})


def test_fields(spark):
    text = "engine: x\ncommit_sha: " + "a" * 40 + "  \nnoise\n"
    assert provenance.read_fields(text, ["engine", "commit_sha"]) == {"engine": "x", "commit_sha": "a" * 40}
    for bad in ("engine: x\nengine: y\n", "engine: x\n", "engine: x\ncommit_sha: zz\n"):
        with pytest.raises(SystemExit):
            provenance.read_fields(bad, ["engine", "commit_sha"])
    wkt = spark.range(1).select(provenance.declared_epsg(F.lit('PROJCS["x",AUTHORITY["EPSG","4156"]],AUTHORITY["EPSG","5514"]')).alias("a"), provenance.declared_epsg(F.lit("none")).alias("b")).first()
    assert tuple(wkt) == (5514, None)
    same = spark.range(1).select(provenance.signature({"b": "2", "a": "1"}).alias("s")).first().s
    assert same == provenance.signature_of({"a": "1", "b": "2"})


def test_fetching(spark):
    good = b"II*\x00" + b"x" * 10
    waits, replies = [], iter([(good[:5], len(good)), (b'{"error"}', 9), (good, len(good))])
    assert terrain.fetch_window(lambda u: next(replies), "u", attempts=3, sleep=waits.append) == good and waits == [1.0, 2.0]
    with pytest.raises(OSError, match="no TIFF"):
        terrain.fetch_window(lambda u: (b"{}", None), "u", attempts=2, sleep=waits.append)
    assert terrain.window_faults({"size": 128, "nodata": None}, {"size": 128, "nodata": -9999, "epsg": 5514}) == ["nodata is None, not -9999", "epsg is None, not 5514"]
    tiles = spark.createDataFrame([(-1, 2)], "tx long, ty long")
    row = terrain.fetch_tiles(tiles, lambda u: (good, None), "http://x/export", 256, 128).first()
    assert "bbox=-256%2C512%2C0%2C768" in row.url and len(row.sha256) == 64


def test_checked_and_ids(spark):
    rows = [(1, "4", 18.0, 49.0, 18.1, 49.1), (2, None, 18.0, 49.0, 18.1, 49.1)]
    schema = "climb_id int, category string, start_lon double, start_lat double, top_lon double, top_lat double"
    assert warehouse.checked(spark.createDataFrame(rows, schema)).count() == 2
    for bad, what in (((3, "5", 1.0, 1.0, 1.0, 1.0), "category 5"), ((4, None, None, 1.0, 1.0, 1.0), "climb 4")):
        with pytest.raises(Exception, match=what):
            warehouse.checked(spark.createDataFrame([*rows, bad], schema)).collect()


def test_boundary(spark):
    from ascenta.functions.geo import touches

    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (100, 0), (100, 100), (0, 100), (0, 0))))
    cases = [([10.0, 20.0], [10.0, 20.0], True), ([-50.0, 150.0], [50.0, 50.0], True), ([105.0, 200.0], [50.0, 50.0], True), ([111.0, 200.0], [50.0, 50.0], False), ([-20.0, 50.0], [120.0, 108.0], True), ([500.0, 600.0], [0.0, 1.0], False)]
    df = spark.createDataFrame([(k, x, y) for k, (x, y, _) in enumerate(cases)], "k int, x array<double>, y array<double>")
    assert {r.k: r.t for r in df.select("k", touches(ring, F.col("x"), F.col("y"), 10.0).alias("t")).collect()} == {k: c[2] for k, c in enumerate(cases)}


def test_derivation_row():
    m = {
        "candidates": {"osm_snapshot": {"sha256": "s", "replication_ts": "t", "replication_seq": "4897"}, "boundary": {"relation_id": 1, "relation_version": 2, "buffer_m": 10000.0, "assignment": "summit"}, "way_filter": {"version": "v", "structure": "w"}},
        "dem": {"dem": {"product": "p", "route": "r", "resolution_m": 2, "crs": 5514, "vertical_crs": 8357, "nodata_value": -9999.0, "fetched_at": "f"}},
        "climbs": {"derivation": {"engine_version": "1", "engine_commit": "a" * 40, "scoring_model": "aso", "engine_config_override": {}}},
    }
    row = provenance.derivation_row(m, "url", "d")
    assert len(row) == 22 and row["osm_snapshot_seq"] == 4897 and row["boundary_buffer_m"] == 10000
    m["candidates"]["boundary"]["buffer_m"] = 10.5
    with pytest.raises(SystemExit, match="whole"):
        provenance.derivation_row(m, "url", "d")
    del m["dem"]["dem"]["route"]
    with pytest.raises(SystemExit, match="dem manifest has no dem.route"):
        provenance.derivation_row(m, "url", "d")
    provenance.vouch([("profiles", "x", "x")])
    with pytest.raises(SystemExit, match="profiles"):
        provenance.vouch([("profiles", "x", "y")])
    provenance.same_grid({}, {"tile_px": 128})
    with pytest.raises(SystemExit, match="tile_px"):
        provenance.same_grid({"tile_px": 64}, {"tile_px": 128})
    provenance.complete(3, 3)
    with pytest.raises(SystemExit, match="1 of 3"):
        provenance.complete(3, 2)


def test_migrations(tmp_path):
    from ascenta.plans import migrate

    scripts = {f"{n:04d}_{w}.{side}.sql": f"-- {w}\n{side} {w} one;\n{side} {w} two;" for n, w in enumerate(("roads", "climbs", "names"), 1) for side in ("up", "down")}
    for name, text in scripts.items():
        (tmp_path / name).write_text(text)
    changes = migrate.discover(tmp_path)
    assert [(c.number, c.name) for c in changes] == [(1, "roads"), (2, "climbs"), (3, "names")]
    ran, applied = [], set()
    assert migrate.up(ran.append, applied, changes, to=2) == [1, 2] and ran == ["up roads one", "up roads two", "up climbs one", "up climbs two"]
    assert migrate.up(ran.append, applied, changes) == [3] and migrate.up(ran.append, applied, changes) == []
    del ran[:]
    assert migrate.down(ran.append, applied, changes, to=1) == [3, 2] and ran[0] == "down names one" and applied == {1}
    without = lambda *gone: {k: v for k, v in scripts.items() if k not in gone}
    for bad, what in (
        (without("0002_climbs.up.sql", "0002_climbs.down.sql"), "0002 is missing"),
        (without("0003_names.down.sql"), "0003_names has no down.sql"),
        (scripts | {"0003_more.up.sql": "", "0003_more.down.sql": ""}, "2 changes are numbered 0003"),
        (scripts | {"4_x.up.sql": ""} | {"readme.sql": ""}, "4_x.up.sql is no .*; readme.sql is no "),
    ):
        with pytest.raises(SystemExit, match=what):
            migrate.changes_in(bad)
    assert migrate.changes_in({}) == []


def test_tables(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ascenta.sources import tables

    pq.write_table(pa.table({"candidate_id": pa.array([1, 2], pa.uint64()), "ids": pa.array([[1], [2, 3]], pa.list_(pa.uint64()))}), tmp_path / "a.parquet")
    df = tables.read_table(spark, f"file://{tmp_path}/a.parquet")
    assert dict(df.dtypes) == {"candidate_id": "bigint", "ids": "array<bigint>"}
    out = f"file://{tmp_path}/out"
    tables.write_table(df.limit(1), out)
    old = tables.read_table(spark, out)
    tables.write_table(df, out)
    assert old.count() == 1 and tables.read_table(spark, out).count() == tables.rows_in(spark, out) == 2 and tables.columns_of(spark, out) == ["candidate_id", "ids"]
    with pytest.raises(Exception, match="torn"):
        tables.write_table(df.withColumn("x", F.raise_error(F.lit("torn")).cast("string")), out)
    assert tables.read_table(spark, out).count() == 2
    tables.forget_old(spark, out)
    assert tables.read_table(spark, out).count() == 2 and len(list((tmp_path / "out").glob("v-*"))) == 1


def test_row_groups_and_geo_metadata(spark, tmp_path):
    import pyarrow.parquet as pq

    from ascenta.functions.geo import from_wkb, with_wkb
    from ascenta.sources import tables

    out = f"file://{tmp_path}/plain"
    tables.write_table(spark.range(120_000).coalesce(1), out)
    meta = pq.ParquetFile(next((tmp_path / "plain").glob("v-*/*.parquet"))).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 50_000
    lines = with_wkb(spark.createDataFrame([(1, [14.0, 14.5], [50.0, 50.5]), (2, [15.0, 15.5], [49.0, 49.5])], "id long, lon array<double>, lat array<double>").repartition(2))
    geo = f"file://{tmp_path}/geo"
    tables.write_geo(lines, geo)
    (tmp_path / "geo" / next((tmp_path / "geo").glob("v-*")).name / "part-left.parquet").write_bytes(b"left by a lost task")
    rows = {r.id: from_wkb(bytes(r.geometry)) for r in tables.read_table(spark, geo).collect()}
    assert rows == {1: [(14.0, 50.0), (14.5, 50.5)], 2: [(15.0, 49.0), (15.5, 49.5)]}
    held = json.loads(pq.ParquetFile(next(p for p in (tmp_path / "geo").glob("v-*/part-*") if "left" not in p.name)).metadata.metadata[b"geo"])
    assert held["primary_column"] == "geometry" and held["columns"]["geometry"]["encoding"] == "WKB"
