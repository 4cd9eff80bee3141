"""The entry point: names, schemas, and a few queries beside their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db(sample):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sample}/{t}.parquet'")
    return con


def values(frame):
    """Rows as comparable text: numbers to five digits, columns by name."""
    def cell(x):
        if x is None or x != x:
            return "~"
        try:
            return f"{float(x):.5f}"
        except (TypeError, ValueError):
            return str(x)

    return sorted(tuple(cell(x) for x in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["scorecard", "price_history", "dataset_parity", "contract_gaps", "vendor_fuzzy_candidates",
                                  "dashboard_counts", "recon_stage_diff", "vendor_scope", "src_load_contract"])
def test_query_and_sql_agree(spark, sample, db, name):
    got, want = entry.queries()[name](spark, sample).toPandas(), db.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got) == values(want)
