import os

import pytest
from pyspark.sql import functions as F

from swipelens import session as S
from swipelens.plans.queries import QUERIES
from swipelens.sizing import broadcast_if_small

SF = "/root/testdata/sf0.001"


def left(spark):
    folder = S.shared_folder(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n.startswith("swipelens-") and not n.endswith(".zip")}


@pytest.mark.parametrize("name", ["interpolate_bfill", "kendall_tau_b", "report_sink", "target_encode"])
def test_scratch_leaves_nothing_behind(spark, name):
    before = left(spark)
    with S.scratch(spark):
        assert QUERIES[name](spark, SF).count() > 0
    assert left(spark) == before


def test_scratch_cleans_up_after_a_failure(spark):
    before = left(spark)
    with pytest.raises(ZeroDivisionError), S.scratch(spark):
        S.materialize(spark.range(3))
        raise ZeroDivisionError
    assert left(spark) == before


def test_scratch_keeps_what_was_there(spark):
    table = S.materialize(spark.range(5))
    with S.scratch(spark):
        S.materialize(spark.range(3))
    assert table.count() == 5


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_broadcast_is_bounded_in_rows_and_bytes(spark):
    rows = spark.range(100).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert hinted(broadcast_if_small(rows))
    assert not hinted(broadcast_if_small(rows, max_rows=99))
    assert not hinted(broadcast_if_small(rows, max_bytes=50_000))
    nested = rows.withColumn("text", F.array(F.struct("text")))
    assert not hinted(broadcast_if_small(nested, max_bytes=50_000)) and hinted(broadcast_if_small(nested))
    assert hinted(broadcast_if_small(rows.limit(0)))
