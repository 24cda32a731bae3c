"""Every registered query against its SQL, at the smallest scale."""

import os

import __spark_entry__ as entry
import oracle_check
import pytest

from tidemark.plans.oracles import all_oracles
from tidemark.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(entry.queries()) >= set(all_queries())


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, name):
    problem, _ = oracle_check.compare(spark, name, SF_DIR)
    assert problem is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_id", "hh", "sales"]
    assert not df.isEmpty()
