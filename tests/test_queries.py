"""Every registered query equals its SQL on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"


def module(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    loaded = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(loaded)
    return loaded


entry = module("spark_entry", ROOT / "__spark_entry__.py")
check = module("check_queries", ROOT / "tools" / "check_queries.py")


@pytest.fixture(scope="module")
def duck():
    return check.connect(DATA)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, duck, name):
    ours = entry.queries()[name](spark, DATA).toPandas()
    assert check.difference(ours, duck.execute(entry.oracle_sql()[name]).df()) is None
