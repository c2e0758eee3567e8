import math

import duckdb
import pytest
from helpers import DATA

import __spark_entry__ as entry
from quarrysift.plans import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows_as_sql(spark, database, name):
    frame = entry.queries()[name](spark, DATA)
    rows = frame.collect()
    sql = entry.oracle_sql()[name]
    cursor = database.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    wanted = [dict(zip(columns, row)) for row in cursor.fetchall()]
    order = sorted(columns)
    left = sorted(([plain(r[c]) for c in order] for r in rows), key=str)
    right = sorted(([plain(r[c]) for c in order] for r in wanted), key=str)
    assert left == right


def test_entry(spark):
    assert entry.entry(spark).count() == 8
