"""Every query of the engine against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from cellplane.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def shown(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(name, spark, duck):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    rel = duck.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(shown(dict(zip(names, r, strict=True))[c]) for c in columns) for r in rel.fetchall())
    assert ours == theirs


def test_queries_without_sql_run(spark):
    for name in set(catalogue.queries()) - set(SQL):
        assert catalogue.queries()[name](spark, SF).count() > 0
