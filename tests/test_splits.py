import pytest
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators import splits as L


@pytest.fixture(scope="module")
def order(txn):
    rows = txn.select(C.ROW_ID, C.TIME).collect()
    return [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]


def ids(df):
    return {r[0] for r in df.select(C.ROW_ID).collect()}


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.333, 1.0])
def test_time_based_split(txn, order, fraction):
    train, late = L.time_based_split(txn, fraction)
    cut = int(len(order) * (1 - fraction))
    assert ids(train) == set(order[:cut]) and ids(late) == set(order[cut:])


def test_time_series_folds(txn, order):
    n = len(order)
    folds = L.time_series_folds(txn, 4)
    size = n // 5
    for k in range(1, 5):
        train, test = L.fold(folds, k)
        start = n - (5 - k) * size
        assert ids(test) == set(order[start:start + size]) and ids(train) == set(order[:start])
    with pytest.raises(ValueError):
        L.time_series_folds(txn, 5, int(n * 0.2))


def test_block_folds_cover_every_row_once(txn, order):
    folds = L.block_folds(txn, 3, 0.3)
    size = int(len(order) * 0.3)
    bounds = [0, size, 2 * size, len(order)]
    for k in range(1, 4):
        train, test = L.without_block(folds, k)
        assert ids(test) == set(order[bounds[k - 1]:bounds[k]])
        assert ids(train) == set(order) - ids(test)


def test_ties_are_cut_by_row_id(spark):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(100)], "trans_num STRING").withColumn(
        C.TIME, F.lit("2024-01-01 00:00:00").cast("timestamp")
    ).repartition(5)
    train, late = L.time_based_split(df, 0.37)
    assert ids(train) == {f"{i:03d}" for i in range(63)} and late.count() == 37


def test_exact_sample(txn):
    a, b, c = (ids(L.exact_sample(txn, 200, seed)) for seed in (1, 1, 2))
    assert a == b != c and len(a) == 200
    assert ids(L.exact_sample(txn, 10 ** 9)) == ids(txn) and L.exact_sample(txn, 0).count() == 0
    assert [r[0] for r in L.shuffled(txn).select(C.ROW_ID).take(5)] == [r[0] for r in L.shuffled(txn).select(C.ROW_ID).take(5)]


def test_stratified_split(txn):
    train, test = L.stratified_split(txn, 0.2)
    assert ids(train) | ids(test) == ids(txn) and not ids(train) & ids(test)
    sizes = {r[C.TARGET]: r["count"] for r in test.groupBy(C.TARGET).count().collect()}
    whole = {r[C.TARGET]: r["count"] for r in txn.groupBy(C.TARGET).count().collect()}
    assert sizes == {k: -(-n // 5) for k, n in whole.items()}


def test_stratified_split_of_many_classes_is_the_same(txn, monkeypatch):
    want = ids(L.stratified_split(txn, 0.3, by="cc_num")[1])
    monkeypatch.setattr(L, "MAX_STRATA", 3)
    train, test = L.stratified_split(txn, 0.3, by="cc_num")
    assert ids(test) == want and ids(train) == ids(txn) - want and test.columns == txn.columns


def test_balance_keeps_all_positives(txn):
    pos = txn.where("is_fraud = 1").count()
    got = {r[C.TARGET]: r["count"] for r in L.balance_data(txn, ratio=10).groupBy(C.TARGET).count().collect()}
    assert got == {1: pos, 0: pos * 10}
    assert L.balance_data(txn, ratio=10 ** 6).count() == txn.count()


def test_no_shuffle_of_the_table(txn):
    train, _ = L.time_based_split(txn, 0.2)
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


def test_small_relations(txn):
    assert L.top_n(txn, "amt", 3, C.ROW_ID).count() == 3
    days = [r[0] for r in L.distinct_sorted(txn.withColumn("d", F.dayofmonth(C.TIME)), "d", 20).collect()]
    assert days == sorted(set(days)) and days[0] == 20
    assert L.union_all(txn, txn, txn).count() == 3 * txn.count()
