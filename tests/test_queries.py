"""Every query that SQL can express against its SQL; the others for rows."""

import pytest
from compare import canon, duck

from colloquy.plans import catalog


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, sf, con, name):
    got, want = catalog.QUERIES[name](spark, sf).toPandas(), con.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_has_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_quotes_and_choices_of_whole_texts(spark, sf):
    """All of a text is cleaned, not its first characters."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "length(text) AS n")
    turns = spark.read.parquet(f"{sf}/conversations.parquet").selectExpr("conv_id", "turn", "length(text) AS n")
    assert catalog.QUERIES["quotes_whole"](spark, sf).join(docs, "doc_id").where("length(quoted) <> n + 2 OR quoted RLIKE '[‘’“”]'").count() == 0
    assert catalog.QUERIES["choice_whole"](spark, sf).join(turns, ["conv_id", "turn"]).where("length(clean) <> n + 16 OR plain <> clean").count() == 0
