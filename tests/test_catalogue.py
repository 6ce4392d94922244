"""Every registered query of the library against its SQL."""

import duckdb
import pytest

from quillmesh.plans import catalogue, formats, state  # noqa: F401  (the last two add their queries to the catalogue)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def database(tables):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, tables, database, name):
    got = catalogue.queries()[name](spark, tables)
    columns = sorted(got.columns)
    rows = sorted(tuple(shown(r[c]) for c in columns) for r in got.collect())
    if name not in catalogue.oracle_sql():
        assert rows
        return
    found = database.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert rows == sorted(tuple(shown(dict(zip(names, r))[c]) for c in columns) for r in found.fetchall())


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(catalogue.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_progress_stream_counts_every_event(spark, tables):
    rows = catalogue.queries()["ledger_progress_stream"](spark, tables).collect()
    assert sum(r.attempts for r in rows) == spark.read.parquet(f"{tables}/events.parquet").where("ts IS NOT NULL").count()
