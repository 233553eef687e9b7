"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest
from conftest import SF01
from oracle_compare import compare, duck

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


#: The tree rule for paragraphs is no SQL; tests/test_html_exact.py checks every page.
WITHOUT_SQL = {"first_line"}


def test_every_query_has_an_oracle():
    from docketline.plans.queries import QUERIES as own
    assert set(own) - WITHOUT_SQL <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(k for k in ORACLE if not k.startswith("op")))
def test_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert r["cols_ok"], r
    assert r["rows_ok"], r
    assert r["hash_ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["court_book_id", "line_id", "payload"]
