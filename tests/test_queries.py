"""Every query of the engine against its SQL, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from graphloom.plans import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


def plain(x):
    if x is None or (not isinstance(x, (list, str)) and pd.isna(x)):
        return None
    if hasattr(x, "year"):
        return str(pd.Timestamp(x))
    if isinstance(x, str) or type(x).__name__ in ("bool", "bool_"):
        return x if isinstance(x, str) else bool(x)
    return int(x) if float(x).is_integer() else round(float(x), 6)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(map(plain, r)) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(own.queries()))
def test_query(spark, small, duck, name):
    got = own.queries()[name](spark, small)
    if name in own.oracle_sql():
        assert rows(got.toPandas()) == rows(duck.sql(own.oracle_sql()[name]).df())
    else:
        found = got.collect()
        assert found and all(len(r) == len(got.columns) for r in found)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert math.isfinite(len(__spark_entry__.queries()))
