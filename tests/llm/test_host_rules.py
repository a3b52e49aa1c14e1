import re
from pathlib import Path
from collections import Counter

import pytest
from pyspark.sql import functions as F

from swipelens.llm import host_rules

SCHEMA = "doc_id BIGINT, text STRING, source STRING, n INT, failed STRING"


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


CASES = [
    None, "", " \n\t ", "a b", "a b c a b c a b c", "é b  x\x0by\n\n a\na\n a", "a " * 30_000,
    "x y x y x y z", "one\ntwo\none\n \none", "#*$%&|<> é　b", "\x1c a \x85 b",
]


def test_metrics_equal_brute_force(spark, documents):
    odd = spark.createDataFrame([(i, t, "h", 1, "x") for i, t in enumerate(CASES)], SCHEMA)
    for frame in (documents, odd):
        rows = host_rules.document_metrics(frame).collect()
        assert len(rows) == frame.count()
        for row in rows:
            assert tuple(row[m] for m in host_rules.METRICS) == brute(row["text"])


def test_clashing_columns_and_repeated_rows(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good, "h", 7, "x"), (1, good, "h", 7, "x"), (None, good, None, None, None)]
    out = host_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["kept"] for r in out] == [True] * 3
    assert sorted(str(r["n"]) for r in out) == ["7", "7", "None"]


def test_inner_names_pass_through(spark):
    inner = sorted(set(re.findall(r'"(_\w+)"', Path(host_rules.__file__).read_text())) | {"host", "host_rejected", "h", "i"})
    good = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(i, good if i % 3 else "bad", f"h{i % 2}", 0, "") for i in range(12)], SCHEMA)
    wide = rows.withColumns({n: F.lit("x") for n in inner})
    out = host_rules.quality_rules(wide)
    assert out.where(" or ".join(f"{n} <> 'x'" for n in inner)).count() == 0
    plain = host_rules.quality_rules(rows)
    assert sorted(map(tuple, out.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_a_failing_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short" if i % 10 else good, "bad", 0, "") for i in range(200)]
    rows += [(1000 + i, good, f"h{i % 20}", 0, "") for i in range(400)]
    out = host_rules.quality_rules(spark.createDataFrame(rows, SCHEMA), keep_text=False)
    kept = {r["source"]: r["kept"] for r in out.where("NOT base_failed").select("source", "kept").distinct().collect()}
    assert kept.pop("bad") is False
    assert all(kept.values())
    assert "text" not in out.columns


def test_a_small_host_is_pulled_to_the_rest(spark):
    # One failing document of one says little about a host among many that pass.
    hosts = spark.createDataFrame([(100, 2)] * 30 + [(100, 9)] * 10 + [(1, 1)], "n BIGINT, failed BIGINT")
    prior = host_rules.BetaPrior.fit(hosts)
    assert prior.rate == pytest.approx((60 + 90 + 1) / 4001)
    assert (1 + prior.rate * prior.strength) / (1 + prior.strength) < 0.5


def test_empty_table(spark):
    assert host_rules.quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0
    assert host_rules.BetaPrior.fit(spark.createDataFrame([], "n BIGINT, failed BIGINT")).rate == 0.0


def test_only_built_in_functions(spark, documents, capsys):
    host_rules.quality_rules(documents.withColumn("x", F.lit(1))).explain()
    assert "Python" not in capsys.readouterr().out
