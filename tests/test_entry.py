"""All registered queries against their SQL, on the smallest tables."""

import math
import sys

import duckdb
import pandas as pd
import pytest

from conftest import ROOT

sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
from gridflow.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(plain(v) for v in row) for row in frame.itertuples(index=False)), key=str)


def test_every_query_has_sql():
    assert set(catalog.oracles()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, tables, name):
    found = contract.queries()[name](spark, SF).toPandas()
    wanted = tables.execute(contract.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert len(found) > 0 or name == "dq_tariff_violations"
    assert rows_of(found) == rows_of(wanted)


def test_flagship(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "renewable_contribution_pct" in result.columns
