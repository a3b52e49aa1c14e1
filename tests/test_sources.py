import datetime as dt

import pytest

from swipelens.session import new_path
from swipelens.sources import transactions as IO

HEADER = ",trans_date_trans_time,cc_num,merchant,category,amt,gender,dob,is_fraud,zip"
LINES = [
    "0,2019-01-01 00:00:18,2703186189652095,m1,misc_net,4.97,F,1988-03-09,0,28654",
    '1,2019-01-01 00:00:44,0630423337322,"m, 2",grocery_pos,107.23,F,1978-06-21,1,99160',
    "2,2019-01-01 00:00:51,38859492057661,m3,misc_net,NaN,,1962-01-19,0,",
]


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_typed_scan(spark, csv):
    rows = IO.read_transactions(spark, csv)
    assert rows.columns[0] == "trans_date_trans_time" and len(rows.columns) == 9
    first, second, third = rows.orderBy("trans_date_trans_time").collect()
    assert second["cc_num"] == "0630423337322" and second["merchant"] == "m, 2"
    assert first["dob"] == dt.date(1988, 3, 9) and first["trans_date_trans_time"].second == 18
    assert third["amt"] is None and third["gender"] is None and third["zip"] is None
    assert IO.read_transactions(spark, csv, nrows=2).count() == 2


def test_wrong_type_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("cc_num,amt\n1,abc\n")
    with pytest.raises(Exception):
        IO.read_transactions(spark, str(path)).collect()


def test_pair_counts(spark, csv):
    counts = IO.row_counts(*IO.read_pair(spark, csv, csv))
    assert {r["part"]: r["n_rows"] for r in counts.collect()} == {"train": 3, "test": 3}


def test_round_trips(spark):
    df = spark.createDataFrame([(1.5, 2, 0), (None, 3, 1)], "a DOUBLE, b INT, y INT")
    path = new_path(spark)
    IO.save_matrix(df, path, ["b", "a"], "y")
    rows, names = IO.load_matrix(spark, path)
    assert names == ["b", "a"] and rows.columns == ["b", "a", "y"] and rows.count() == 2
    report = new_path(spark)
    IO.save_report(df, report)
    assert sorted(map(str, IO.load_report(spark, report, df.schema).collect())) == sorted(map(str, df.collect()))
