import itertools
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swipelens.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced character makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    form, found = {}, []
    neighbours = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)] for w in n}
    for w, others in neighbours.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n[w], len(neighbours[w]), form[w] and n[form[w]]))
    return sorted(found, key=str)


def variants(df):
    return sorted((tuple(r) for r in spelling.variants(df).collect()), key=str)


def test_documents_equal_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = variants(documents)
    assert found == brute(rows) and any(r[1] for r in found)


def test_cases_equal_brute_force(spark):
    chain = " ".join(["common"] * 150 + ["commun"] * 30 + ["commum"] * 6 + ["aaaaaa"] * 40 + ["aaaaaaa"] * 200 + ["aaaaaaaa"] * 8)
    rows = [
        (1, chain), (1, chain), (None, "ÉCOLEMAIS " * 5 + "écolemais " * 30 + "Écolemais " * 6), (2, None), (3, ""), (4, "....  12"),
        (5, "œuvreuse “naïveté” " * 6 + "naïvetà " * 31 + "na×vetà÷ " * 5), (6, "x" * 50_000), (7, "don't zzzzzz\x00zzzzzzŸzzzzzz " * 5),
        *[(100 + i, f"variants varients variante {chain[:400]}") for i in range(400)],
    ]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    more = df.withColumns({c: F.lit("x") for c in ("word", "n", "id", "key", "form", "root", "last")})
    found = variants(df)
    assert found == brute(rows) == variants(more)
    assert ("commum", "commun", "common") in {r[:3] for r in found}


def test_empty_table(spark):
    assert variants(spark.createDataFrame([], "doc_id BIGINT, text STRING")) == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab", min_size=6, max_size=9) | st.text("abcdé", min_size=6, max_size=8), min_size=2, max_size=40))
def test_keys_lose_no_pair(words):
    """The keys of index and probe meet for every two words at one edit."""
    frequency = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
    rank = {g: r for r, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}
    signed = {w: spelling.signature(w, rank, frequency) for w in words}
    for a, b in itertools.permutations(words, 2):
        (last_a, prefix, _), (last_b, _, pivots) = signed[a], signed[b]
        if near(a, b) and last_a >= last_b:
            assert set(spelling.probe_keys(a, prefix)) & set(spelling.index_keys(b, pivots)), (a, b)


@pytest.mark.parametrize("places,costs,chosen", [
    ([0, 1, 2], [1, 1, 1], [0, 2]), ([0, 1, 3], [9, 1, 1], [1, 3]), ([0, 1, 2, 3, 4], [5, 1, 5, 5, 1], [1, 4]),
    ([0, 1, 2, 3], [1, 0, 3, 1], [1, 3]),
])
def test_pivots_are_the_cheapest_disjoint_two(places, costs, chosen):
    assert spelling.disjoint(places, costs) == chosen


def test_keys_are_never_broadcast(spark):
    # Spark sizes the keys of words as the words themselves, so any number of them may look small.
    rows = [(i, f"variants varients variante {'common ' * 8}") for i in range(10)]
    words = spelling.word_counts(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    plan = spelling.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
