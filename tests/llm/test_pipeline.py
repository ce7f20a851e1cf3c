import hashlib

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from ascenta.llm import queries

from .test_exact import bare
from .test_near import components
from .test_rules import brute


def test_stages(spark, corpus):
    path, docs = corpus
    now = spark.read.parquet(f"{path}/documents.parquet")
    columns = now.columns
    text = {i: t for i, t, *_ in docs}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, path).collect(), now.schema)
        assert now.columns == columns, name
        kept.append({r.doc_id for r in now.collect()})
    rules, exact, near, mixed = kept
    assert all(not brute(text[i])[5] for i in rules)
    assert len(exact) == len({bare(text[i]) for i in rules}) and exact <= rules
    ids = sorted(exact)
    assert near == {i for i, _, c in components([(i, text[i]) for i in ids], 5, 80) if i == c}
    assert mixed <= near
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, now, path).collect()}
    assert set(last) == mixed
    assert all(r.decoded_sha256 == hashlib.sha256((text[i] or "").encode()).hexdigest() for i, r in last.items())
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).collect()} == mixed


def test_stages_take_any_rows(spark, edge, empty):
    for df in (edge, empty):
        now = df
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, "")
        now.collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, corpus, name):
    path, _ = corpus
    own = queries.QUERIES[name](spark, path).toPandas()
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    want = db.sql(queries.ORACLES[name]).df()[list(own.columns)]
    order = lambda d: d.sort_values(list(d.columns)).reset_index(drop=True).astype(str)
    pd.testing.assert_frame_equal(order(own), order(want))
