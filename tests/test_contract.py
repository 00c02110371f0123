"""The driver contract and the DuckDB oracle, query by query."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, digest
from conftest import SF01


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["direction", "n_pairs", "sl_chars", "tl_chars", "first_pair_id", "last_pair_id"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF01)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]
