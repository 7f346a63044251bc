"""Every registered query against DuckDB on the same files."""

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect
from tunefeed.plans.oracles import ORACLES
from tunefeed.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DUCK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.dtypes == [("conv_id", "bigint"), ("text", "string")]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES[name]
    assert compare(df, con, sql) > 0 or name == "ckpt_retention"
    duck = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == duck
