"""Each query that has SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from emberlog.queries import ORACLES, QUERIES, flagship

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(frame):
    names = sorted(frame.columns)
    plain = [tuple(None if v is None or v != v else v.item() if hasattr(v, "item") else v for v in r) for r in frame[names].itertuples(index=False)]
    return names, sorted(plain, key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, FOLDER).toPandas()) == rows(duck.execute(ORACLES[name]).df())


def test_flagship(spark):
    assert flagship(spark, FOLDER).count() == 3
