import duckdb
import pytest

from lorekeel.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    expected = con.sql(ORACLES[name])
    got, columns = QUERIES[name](spark, small), sorted(expected.columns)
    assert sorted(got.columns) == columns
    plain = lambda rows, names: sorted(repr([r[names.index(c)] for c in columns]) for r in rows)
    assert plain(got.collect(), list(got.columns)) == plain(expected.fetchall(), list(expected.columns))


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
