"""Every registered query against its independent SQL oracle."""

import pytest

import __spark_entry__ as driver
from tests.compare import database, differences
from triplewright.operators import skew
from triplewright_checks.oracle import ORACLE
from triplewright_checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE.items() <= driver.oracle_sql().items()


# Operators that leave the JVM, or pair all rows with all rows.
UNWANTED = ["Python", "Pandas", "CartesianProduct", "NestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, connection, name, capsys):
    df = QUERIES[name](spark, SF_DIR)
    df.explain()
    plan = capsys.readouterr().out
    assert [word for word in UNWANTED if word in plan] == []
    assert differences(df, connection, ORACLE[name]) == []


COMPOSITES = sorted(n for n in QUERIES if n.startswith(("company_", "person_", "listed_", "join_", "top1_")))


@pytest.mark.parametrize("name", COMPOSITES)
def test_ways_for_hot_keys_and_large_lookups(spark, connection, monkeypatch, name):
    """The same results when nothing may be broadcast and many keys count as hot."""
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(skew, "HOT_SHARE", 1 / 150)
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 2)
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, connection, ORACLE[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["sub", "pred", "obj"]
    assert df.count() > 0
