import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from ascenta.plans import queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        found.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return found


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_equals_sql(spark, db, name):
    own = queries.QUERIES[name](spark, DATA).toPandas()
    if name not in queries.ORACLES:
        assert len(own)
        return
    want = db.sql(queries.ORACLES[name]).df()[list(own.columns)]
    order = lambda d: sorted(map(repr, d.astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    assert order(own) == order(want)
    assert isinstance(want, pd.DataFrame)


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
