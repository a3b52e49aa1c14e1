import duckdb
import pytest

from swipelens.llm.oracle import ORACLE
from swipelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, duck, name):
    found = QUERIES[name](spark, SF)
    names = sorted(found.columns)
    twin = duck.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert in_order(found.select(*names).collect()) == in_order(twin)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
