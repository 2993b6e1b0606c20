"""Every catalog query equals its DuckDB SQL on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from tidemark.plans import catalog  # noqa: E402
from check_oracle import canon, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(scols, srows) == canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "repo_name" in df.columns
