"""Rows that a join can't use go before they are sent, and no others."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from ascenta import storage
from ascenta.operators import arrays, network, profiles
from ascenta.plans import queries, virtual

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("most", [arrays.MOST_LOG, arrays.MAP_LOG])
def test_likely_keeps_every_row_of_a_key(spark, monkeypatch, most):
    monkeypatch.setattr(arrays, "MOST_LOG", most)  # at MAP_LOG the bits are too few for the keys
    rows = spark.range(-100_000, 100_000).select((F.col("id") * 7919).alias("k"), F.col("id").alias("v"))
    keys = rows.where("v % 5 = 0").select("k")
    left = arrays.likely(rows, "k", keys)
    assert left.join(keys, "k").count() == 40_000
    if most > arrays.MAP_LOG:
        assert left.count() < 40_000 + 160_000 * 0.08


def test_likely_of_no_keys_nulls_and_text(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    assert arrays.likely(rows, "k", rows.where("false")).count() == 0
    assert {1, 4} <= {r.v for r in arrays.likely(rows, "k", rows.where("v = 1")).collect()}
    assert 3 in {r.v for r in arrays.likely(rows, "k", rows.where("v = 3")).collect()}


def test_ridden_is_that_of_all_ways(spark):
    row = lambda df: sorted((r.id, tuple(r.nodes), r.structure or "") for r in df.collect())
    got = row(virtual.ridden(spark, DATA))
    assert got == row(network.ridden(virtual.ways(spark, DATA))) and len(got) > 200


def test_lines_in_order_as_in_sql(spark, tmp_path):
    """Lines of one number are ordered by part and supplier, and equal ones stay, whatever their price."""
    rows = [(1, 2, 5, 9, 3.0, 1.0), (1, 1, 7, 100_001, 1.0, 1.0), (1, 1, 8, 0, 2.0, 1.0), (1, 2, 5, 9, 1.0, 1.0), (1, 1, 7, -3, 9.0, 2.0), (2, 1, 4, 4, 1.0, 1.0), (2, 1, 3, 4, 2.0, 1.0)]
    path = f"{tmp_path}/lineitem.parquet"
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double").write.parquet(path)
    want = duckdb.sql(f"""SELECT l_orderkey, list(l_partkey * 100000 + l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)
      FROM '{path}/*.parquet' GROUP BY l_orderkey ORDER BY l_orderkey""").fetchall()
    got = virtual.in_order(virtual.lines(spark, str(tmp_path))).orderBy("id").collect()
    assert [(r.id, r.nodes) for r in got] == want


def sent(spark):
    """Records that each stage so far has sent."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


@pytest.mark.parametrize("name", ["without_profile", "deck_interpolation", "nodata_drop_counts"])
def test_lines_of_other_ways_stay(spark, name):
    before = set(sent(spark))
    assert queries.QUERIES[name](spark, DATA).collect()
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    # Two of five orders are ridden; the lines that stages sent by node are fewer still.
    most = max(n for k, n in sent(spark).items() if k not in before)
    assert 0 < most < 0.6 * lines


def shuffles(spark):
    """Bytes of each shuffle file on disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {(f := files.apply(i)).getName(): f.length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("name", ["deck_interpolation"])
def test_shuffles_go_with_the_writes_they_serve(spark, monkeypatch, name):
    """What a table written on the way has sent is not left to the driver's garbage collection."""
    left = {}

    def written(df, name, **more):
        before = shuffles(df.sparkSession)
        out = storage.materialize(df, name, **more)
        time.sleep(0.5)  # shuffles are deleted in the background
        left[name] = sum(n for k, n in shuffles(df.sparkSession).items() if k not in before)
        return out

    for module in (queries, profiles):
        monkeypatch.setattr(module, "materialize", written)
    df = queries.QUERIES[name](spark, DATA)
    assert {k: left[k] for k in ("ways", "lines", "needed")} == {"ways": 0, "lines": 0, "needed": 0}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    assert df.collect() == df.collect()


def tables(spark):
    """Names of the folders that hold tables written on the way."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(storage.shared_dir(spark))
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in store.listStatus(folder)} if store.exists(folder) else set()


@pytest.mark.parametrize("name", ["nodata_drop_counts"])
def test_the_network_goes_once_lines_are_written(spark, name):
    before = tables(spark)
    df = queries.QUERIES[name](spark, DATA)
    assert sorted(t.partition("-")[0] for t in tables(spark) - before) == ["blocks", "lines", "needed"]
    assert df.collect() == df.collect() and df.count() == 1


def test_noted_paths_alone_are_released(spark):
    rows = spark.range(3)
    kept = storage.materialize(rows, "kept")
    with storage.noted() as paths:
        gone = storage.materialize(rows, "gone")
    after = storage.materialize(rows, "after")
    storage.release(spark, paths)
    assert len(paths) == 1 and kept.count() == after.count() == 3
    with pytest.raises(Exception, match="gone-"):
        gone.collect()
