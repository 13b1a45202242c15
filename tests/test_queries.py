import pytest

from litloom.plans import ingest, parsing, training

SQL = ingest.SQL | parsing.SQL | training.SQL
QUERIES = ingest.QUERIES | parsing.QUERIES | training.QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(agree, name):
    agree(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.schema == df.schema and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_filters_reach_the_scan(spark, capsys):
    ingest.QUERIES["incremental_cutoff"](spark, "/root/testdata/sf0.001").explain("formatted")
    assert "GreaterThan(last_modified" in capsys.readouterr().out
