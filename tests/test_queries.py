"""Every registered query against its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from topicloom.plans.catalog import QUERIES
from topicloom.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, db, name):
    got = QUERIES[name](spark, sf_dir)
    want = db.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    rows = [repr([plain(r[c]) for c in order]) for r in got.collect()]
    assert sorted(rows) == sorted(repr([plain(r[names.index(c)]) for c in order]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
