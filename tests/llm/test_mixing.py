import math
import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from swipelens.llm import mixing

SCHEMA = "doc_id BIGINT, text STRING, source STRING, size INT, taken STRING"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Share by weight, stop at twice the size, share what is left again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += left * weight[s] / total
            if target[s] >= 2 * sizes[s]:
                excess += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
        left = excess
    return target


def check(rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == n_words(r["text"]) if "text" in r else True
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
    for s, target in want.items():
        assert taken[s] in (math.floor(target + 1e-6), math.floor(target))


def test_documents(spark, documents):
    rows = [r.asDict() for r in mixing.mix(documents, keep_text=True).collect()]
    assert len(rows) == documents.count()
    check(rows)
    # In the unfinished pass each source is taken in the order of its keys.
    again = mixing.mix(documents).select("doc_id", "taken").collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in rows}


def test_hot_source_nulls_ties_and_clashes(spark):
    rows = [(i, "w " * (i % 7), "hot", 9, "x") for i in range(500)]
    rows += [(i, "w " * 3, f"s{i % 5}", 9, "x") for i in range(40)]
    rows += [(7, "a b c", None, 9, "x")] * 6 + [(None, "a b", None, 9, "x"), (None, None, "", 9, "x"), (1, "a", "", 9, "x")]
    rows += [(2, None, "blank", 9, "x"), (3, "w " * 60_000, "long", 9, "x")]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), keep_text=True)
    assert got.columns == ["doc_id", "text", "source", *mixing.RESULTS]
    found = [r.asDict() for r in got.collect()]
    assert len(found) == len(rows)
    check(found)


def test_expand_takes_whole_documents(spark):
    rows = [(i, f"a{i}  b\nc" * (1 + i % 3), f"s{i % 2}", 0, "") for i in range(20)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), keep_text=True)
    known = {r["doc_id"]: (r["text"], r["taken"], r["size"]) for r in mixed.collect()}
    found = defaultdict(int)
    for r in mixing.expand(mixed).collect():
        assert r["text"] == known[r["doc_id"]][0]
        found[r["doc_id"]] += 1
    # Half of a document or more counts as one.
    assert dict(found) == {i: n for i, (_, t, s) in known.items() if (n := (2 * t + s) // (2 * s))}
    total = sum(found[i] * s for i, (_, _, s) in known.items())
    assert abs(total - sum(t for _, t, _ in known.values())) <= 2 * max(s for _, _, s in known.values())


def test_inner_names_pass_through(spark):
    inner = sorted({c for c in re.findall(r'"(_\w+)"', Path(mixing.__file__).read_text())} | {"source_size", "weight", "pass"})
    rows = spark.createDataFrame([(i, "a b c " * (i % 4), f"s{i % 3}", 0, "") for i in range(30)], SCHEMA)
    more = rows.withColumns({n: F.lit("x") for n in inner if n not in rows.columns})
    plain, wide = mixing.mix(rows, keep_text=True), mixing.mix(more, keep_text=True)
    assert sorted(map(tuple, wide.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    kept = [n for n in inner if n not in mixing.RESULTS]
    assert set(kept) <= set(wide.columns) and wide.where(" or ".join(f"{n} <> 'x'" for n in kept)).count() == 0
    assert set(kept) <= set(mixing.expand(wide).columns)


def test_targets_with_many_caps(spark):
    sizes = {f"s{i:02d}": v for i, v in enumerate([1, 100, 3, 1000, 20, 7, 0, 50_000, 2, 2, 2])}
    frame = spark.createDataFrame(list(sizes.items()), "source STRING, source_size BIGINT")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 0, ""), (2, "", None, 0, "")], SCHEMA)
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_only_built_in_functions(spark, documents, capsys):
    mixing.expand(mixing.mix(documents.withColumn("x", F.lit(1)), keep_text=True)).explain()
    assert "Python" not in capsys.readouterr().out
