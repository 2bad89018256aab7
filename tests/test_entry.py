"""Driver contract: entry, queries and oracles line up."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from pactline.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert len(df.columns) == 36
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle_at_smallest_scale(spark, duck, name):
    from tools.compare import digest, type_diffs

    df = entry_mod.queries()[name](spark, SF)
    rows = df.collect()
    rel = duck.sql(entry_mod.oracle_sql()[name])
    assert type_diffs(dict(df.dtypes), dict(zip(rel.columns, [str(t) for t in rel.types]))) == []
    cur = duck.execute(entry_mod.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    orows = cur.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[1] == digest(names, orows)[1]


def test_every_query_has_an_oracle():
    assert set(all_queries()) <= set(entry_mod.oracle_sql())
