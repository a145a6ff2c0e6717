"""Every query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels pages benchmark conversations".split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def normal(columns, rows):
    """Rows in the order of their exact cells, then of their numbers."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def key(row):
        return tuple((0, "") if isinstance(x, float) else (1, str(x)) for x in row), tuple(
            float(f"{x:.6g}") for x in row if isinstance(x, float) and not math.isnan(x)
        )

    return sorted((tuple(r[i] for i in order) for r in rows), key=key)


def same(a, b):
    """Numbers agree to seven digits, or to the last place that queries round to; all else is equal."""
    if isinstance(a, float) and isinstance(b, float):
        return math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-12)
    return str(a) == str(b)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    found = duck.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    ours, theirs = normal(df.columns, rows), normal(columns, found.fetchall())
    assert len(ours) == len(theirs)
    differ = [(a, b) for a, b in zip(ours, theirs) if not all(map(same, a, b))]
    assert not differ, differ[:3]


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "query_id", "doc", "position", "score"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
