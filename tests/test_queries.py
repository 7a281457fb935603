"""Every registered query runs, and agrees with its SQL where it has one."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as contract
from gridmotion.catalog.base import QUERIES
from oracle import compare, connect

# The training-data queries have tests of their own.
NAMES = sorted(n for n in contract.queries() if n in QUERIES)

# Too little data at the usual size for these to find anything.
LARGER = {"cluster_examples": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def findings(spark, sf_dir):
    """Problems per query; the queries run side by side, as Spark jobs of one session can."""
    folders = {sf_dir, *filter(None, LARGER.values())}
    connections = {folder: connect(folder) for folder in folders}

    def check(name):
        folder = LARGER.get(name) or sf_dir
        try:
            return compare(spark, connections[folder].cursor(), name, folder)
        except Exception as error:  # one failing query must not hide the others
            return [f"{name}: {type(error).__name__} {str(error)[:2000]}"]

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(NAMES, pool.map(check, NAMES)))


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 42 and df.count() == 1000


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(findings, name):
    found = findings[name]
    assert not found, "\n".join(found)
