import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns[0] == "trans_num" and found.count() == 1000


def test_every_sql_has_a_query():
    assert not set(SQL) - set(entry.queries())


def plain(value):
    return None if value is None or value != value else value


#: Fits all presets at full size, which takes minutes; the driver runs it.
LONG = {
    "train_all_check", "boosting_check", "search_check", "calibrate_check", "ratio_sweep_check", "best_ratios_check",
    "best_model_check", "importance_check", "fold_means_check", "attribution_check",
}


@pytest.mark.parametrize("name", sorted(set(SQL) - LONG))
def test_query_equals_sql(spark, con, name):
    found = entry.queries()[name](spark, SF)
    twin = con.execute(SQL[name])
    names = [d[0] for d in twin.description]
    assert sorted(found.columns) == sorted(names)
    got = sorted((tuple(plain(r[c]) for c in names) for r in found.collect()), key=str)
    want = sorted((tuple(plain(v) for v in r) for r in twin.fetchall()), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == pytest.approx(y, abs=2e-6) if isinstance(y, float) else x == y for x, y in zip(a, b)), (a, b)
