"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from gridmill.plans import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, CHECKS = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


# Queries of the optional operators are tested with them.
OWN = sorted(registry.QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    ours = sorted(tuple(plain(r[c]) for c in sorted(frame.columns)) for r in frame.collect())
    relation = duck.execute(CHECKS[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in sorted(columns)]
    theirs = sorted(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    assert len(ours) > 0
    assert ours == theirs


def test_entry(spark):
    assert driver.entry(spark).count() > 0
