"""Every registered query against its SQL on the given tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) for v in row)


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(picked, key=_key), [columns[i] for i in order]


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    got, got_columns = _sorted_rows([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want, want_columns = _sorted_rows(cursor.fetchall(), columns)
    assert got_columns == want_columns
    assert len(got) == len(want)
    assert got, "nothing to compare"
    different = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    assert not different, different[:3]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 15
