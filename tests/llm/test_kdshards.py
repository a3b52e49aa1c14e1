import zlib

import pytest
from pyspark.sql import functions as F

from swipelens.llm import kdshards
from swipelens.session import new_path

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def tree(points, n_shards):
    """Leaves by recursion over (coordinates, tie, row, size) in memory."""
    found = {}

    def grow(rows, low, leaves):
        if leaves == 1 or not rows:
            found.update({r[2]: low for r in rows})
            return
        widths = [max(r[0][d] for r in rows) - min(r[0][d] for r in rows) for d in range(len(rows[0][0]))]
        dim = widths.index(max(widths))
        rows = sorted(rows, key=lambda r: (r[0][dim], r[1], r[2]))
        want, before, left = 2 * sum(r[3] for r in rows) * (leaves // 2) // leaves, 0, []
        for r in rows:
            if 2 * before + r[3] > want:
                break
            left.append(r)
            before += r[3]
        grow(left, low, leaves // 2)
        grow(rows[len(left):], low + leaves // 2, leaves - leaves // 2)

    grow(points, 0, n_shards)
    return found


def check(rows, expected, n_shards):
    """Every row comes back once, slots are gapless, and shards are near equal in bytes."""
    assert len(rows) == len(expected)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert 0 <= shard < n_shards and slots == list(range(len(slots)))
    digest = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows)
    assert digest == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in expected
    )
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(n_shards)]
    # Each of the levels may be off by half a row.
    largest = max((r["size"] for r in rows), default=0)
    assert max(sizes) - min(sizes) <= 2 * largest * max(1, (n_shards - 1).bit_length())


@pytest.mark.parametrize("n_shards", [16, 5])
def test_documents_equal_a_recursive_tree(spark, documents, n_shards):
    points, rows, levels, _, _, _ = kdshards._grow(documents, kdshards.DIMENSIONS, "doc_id", "text", n_shards, None)
    known = [(tuple(r["at"]), r["tie"], r["row"], r["size"]) for r in points.drop("doc").collect()]
    assert {r["row"]: r["low"] for r in rows.collect()} == tree(known, n_shards)


def test_report_over_documents(spark, documents):
    found = kdshards.shard_report(documents).collect()
    check(found, [(r["doc_id"], r["text"]) for r in documents.collect()], 16)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_hot_values_copies_and_nulls(spark):
    rows = [(7, "same text", "en", "hot", 9)] * 300
    rows += [(i, "x" * (i % 50), None if i % 3 else "de", f"s{i % 4}", None if i % 5 else i) for i in range(300)]
    rows += [(None, None, None, None, None)] * 50 + [(1000, "", "", "", 0), (1001, "é" * 4000, "fr", "s", -5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check(kdshards.shard_report(df, piece_bytes=1 << 9).collect(), [(r[0], r[1]) for r in rows], 16)


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)
    assert [(r["size"], r["slot"]) for r in kdshards.shard_report(one).collect()] == [(2, 0)]
    assert kdshards.shard_report(one.limit(0)).collect() == []


def test_further_columns_pass_through(spark):
    rows = [(i, "t" * i, "en", "s", float("nan") if i % 2 else float("inf")) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars DOUBLE")
    inner = ["doc", "tie", "row", "at", "low", "leaves", "dim", "lo", "hi", "pivot", "cut", "side", "m0", "piece", "first", "x", "value", "rank"]
    wide = df.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id")) for n in inner}).withColumns({n: F.lit(-1) for n in kdshards.RESULTS})
    out = kdshards.write_shards(wide, new_path(spark), target_bytes=100)
    assert set(out.columns) == {*wide.columns}
    assert out.count() == 40 and out.where("low = concat('low ', doc_id) and size = length(text) + 1").count() == 40
    assert out.groupBy("shard").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] <= 200
