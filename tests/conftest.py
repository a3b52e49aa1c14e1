import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from swipelens.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    # Small partitions stay apart, so that what crosses a sort segment is tested too.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def txn(spark):
    from swipelens.session import materialize
    from swipelens.sources import stand_in

    return materialize(stand_in.transactions(spark, SF))


SCHEMA = (
    "trans_num STRING, cc_num STRING, trans_date_trans_time TIMESTAMP, amt DOUBLE, lat DOUBLE, long DOUBLE, "
    "merch_lat DOUBLE, merch_long DOUBLE, city_pop BIGINT, dob DATE, is_fraud INT"
)


@pytest.fixture(scope="session")
def card(spark):
    """Transactions from (time, amount[, card]) rows; the customer moves north-east, row by row."""
    def build(rows):
        made = []
        for number, (when, amount, *which) in enumerate(rows):
            here, shop = (48.0 + number / 50, 2.0 + number / 20), (48.25, 2.5)
            made.append((
                f"txn_{number}", which[0] if which else "c-7", dt.datetime.fromisoformat(when), amount,
                *here, *shop, 12_000 + number, dt.date(1975, 11, 30), number % 2,
            ))
        return spark.createDataFrame(made, SCHEMA)

    return build
