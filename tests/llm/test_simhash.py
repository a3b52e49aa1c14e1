import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from swipelens.llm import simhash

SCHEMA = "doc_id BIGINT, text STRING, fingerprint INT"


def brute_print(text):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(parts[i:i + 4]) for i in range(max(1, len(parts) - 3))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, prints, radius):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    low = {r: min((m for m in members if m is not None), default=None) for r, members in groups.items()}
    return [low[find(i)] for i in range(len(ids))]


def test_equals_brute_force_on_documents(spark, documents):
    rows = documents.orderBy("doc_id").collect()
    prints = [brute_print(r["text"]) for r in rows]
    want = brute_groups([r["doc_id"] for r in rows], prints, 4)
    found = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    assert len(found) == len(rows)
    for row, fp, low in zip(rows, prints, want):
        assert found[row["doc_id"]]["fingerprint"] == f"{fp:016x}"
        assert found[row["doc_id"]]["component_id"] == low


@pytest.mark.parametrize("extra,block_rows", [(1, 2048), (1, 8), (2, 2048), (3, 16)])
def test_groups_of_planted_fingerprints(spark, extra, block_rows):
    # Chains and dense clusters of near fingerprints, pairs exactly at and just over the radius.
    draw = random.Random(7)
    prints = []
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(25):
            for bit in draw.sample(range(64), draw.choice([0, 1, 2, 4, 5, 6])):
                base ^= 1 << bit
            prints.append(base)
    prints += [0, 0, (1 << 64) - 1, 0b11111, 0b1111 << 60]
    ids = list(range(len(prints)))
    draw.shuffle(ids)
    frame = spark.createDataFrame(
        [(i, p - (1 << 64) if p >> 63 else p) for i, p in zip(ids, prints)], "doc_id BIGINT, _fp BIGINT"
    )
    got = frame.join(simhash.group_ids(frame, "doc_id", 4, block_rows, extra), "_fp")
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(zip(ids, brute_groups(ids, prints, 4)))


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 12])
def test_bit_sliced_distances(radius):
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 63, 90, dtype=np.uint64) * np.uint64(2) + draw.integers(0, 2, 90, dtype=np.uint64)
    base[40:] = base[:50] ^ (np.uint64(1) << draw.integers(0, 64, 50, dtype=np.uint64))
    base[60:] ^= np.uint64(0xF0F)
    padded = np.concatenate([base, np.zeros(38, np.uint64)])
    valid = np.array([~np.uint64(0), np.uint64((1 << 26) - 1)])
    cells = [x.ravel() for x in np.meshgrid(np.arange(90), np.arange(2), indexing="ij")]
    got = set()
    for at, mask in simhash.near_lanes(simhash.bit_planes(padded), base, *cells, valid, radius):
        for (q, w), m in zip(at.T.tolist(), mask.tolist()):
            got |= {(q, 64 * w + lane) for lane in range(64) if m >> lane & 1}
    want = {(i, j) for i in range(90) for j in range(90) if bin(int(base[i] ^ base[j])).count("1") <= radius}
    assert got == want


def test_odd_rows(spark):
    long = "w " * 50_000
    rows = [(5, None, 1), (4, "", 1), (7, " \n", 1), (None, "A b\x0bc", 1), (9, "a B C", 1), (9, "a B C", 1), (1, long, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    marked = simhash.near_duplicates(frame, keep_text=True)
    got = {(r["doc_id"], r["text"]): r["component_id"] for r in marked.collect()}
    assert got[(5, None)] == got[(4, "")] == got[(7, " \n")] == 4
    assert got[(None, "A b\x0bc")] == got[(9, "a B C")] == 9
    kept = simhash.keep_one(marked)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 9]
    once = simhash.deduplicate(frame)
    assert once.columns == frame.columns and sorted(r["doc_id"] for r in once.collect()) == [1, 4, 9]


def test_empty_table_and_only_null_ids(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    frame = spark.createDataFrame([(None, "a", 1), (None, "a", 1)], SCHEMA)
    marked = simhash.near_duplicates(frame, keep_text=True)
    assert [r["component_id"] for r in marked.collect()] == [None, None]
    assert simhash.keep_one(marked).count() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = simhash.components(edges).collect()
    assert len(got) == 300 and {r["root"] for r in got} == {0}
