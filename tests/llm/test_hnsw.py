import numpy as np
import pytest

from swipelens.llm import hnsw

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, score STRING"


def brute(rows, k=5, every=50):
    """Exact ranks of (id, vector) rows."""
    good = [
        (i, np.array(v, np.float32).astype(float)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, v in good:
        if q % every == 0:
            near = sorted((-hnsw.cosines(v, [w])[0], i) for i, w in good if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


@pytest.mark.parametrize("small", [1e-300, 1e-200, 1e-160, 1.0, 1e160, 1e200, 1e300])
def test_cosines_of_tiny_and_huge_vectors(small):
    query, row = np.array([small, 0.0]), np.array([1.0, 1.0])
    assert hnsw.cosines(query, row[None])[0] == pytest.approx(0.5 ** 0.5, rel=1e-15)
    assert hnsw.cosines(row, query[None])[0] == pytest.approx(0.5 ** 0.5, rel=1e-15)
    assert hnsw.cosines(query, np.array([[small, small], [0.0, small]])).tolist() == pytest.approx([0.5 ** 0.5, 0.0])


def listed(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 2048), (100, 3)])
def test_recall_on_embeddings(spark, shard_rows, block_rows):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in frame.collect()])
    got = listed(hnsw.nearest(frame, shard_rows=shard_rows, block_rows=block_rows))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(exact.get((q, i), s) == s for q in got for i, s in got[q])


def test_copies_ties_and_unusable_vectors(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(12, 6)).astype(np.float32)
    # One vector holds most of the rows; another comes in two lengths; the rest cannot be used.
    rows = [(i, base[0].tolist()) for i in range(0, 400)]
    rows += [(400 + i, base[i % 12].tolist()) for i in range(60)] + [(500, (2 * base[1]).tolist()), (550, base[2].tolist())]
    rows += [(600, None), (650, []), (700, [0.0] * 6), (750, [None] + [1.0] * 5), (800, [float("nan")] * 6)]
    rows += [(850, [float("inf")] * 6), (None, base[3].tolist()), (900, [1.0, 2.0]), (901, [2.0, 1.0]), (950, [1.0, 2.0, 3.0])]
    rows += [(100, base[0].tolist())]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got, want = listed(hnsw.nearest(frame)), brute(sorted(set((i, tuple(v) if v else None) for i, v in rows), key=repr))
    want.pop(950)
    assert got == want
    assert got[900] == want[900] and len(got[900]) == 1


def test_empty_table(spark):
    assert hnsw.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(0, [1.0], "x")], SCHEMA)
    assert hnsw.nearest(alone).count() == 0


def test_graph_is_flat_and_reaches_all():
    draw = np.random.default_rng(8)
    unit = hnsw._unit(draw.normal(size=(700, 16)))
    graph = hnsw.Graph.build(unit, list(range(700)))
    assert graph.graph[0].shape == (700, 32) and graph.graph[0].dtype == np.int32
    seen, todo = {0}, [0]
    while todo:
        for other in graph.graph[0][todo.pop()].tolist():
            if other >= 0 and other not in seen:
                seen.add(other)
                todo.append(other)
    assert len(seen) == 700
    for level, rows in enumerate(graph.graph):
        used = rows[rows >= 0]
        assert (graph.levels[used] >= level).all()
        assert all(len(set(r[r >= 0])) == (r >= 0).sum() and i not in r for i, r in enumerate(rows))


@pytest.mark.parametrize("noise", [1e-3, 1e-5])
def test_recall_with_a_group_of_near_copies_over_full_shards(spark, noise):
    draw = np.random.default_rng(5)
    size = 3 * hnsw.SHARD_ROWS
    vectors = draw.normal(size=(size, 12))
    near = draw.permutation(size)[:size // 3]
    vectors[near] = vectors[near[0]] + noise * draw.normal(size=(len(near), 12))
    vectors = vectors.astype(np.float32)
    # Multiples of one vector: exact ties, or one unit of the last place apart.
    line = np.setdiff1d(np.arange(size), near)[:600:3]
    vectors[line] = vectors[line[0]] * np.arange(1, len(line) + 1, dtype=np.float32)[:, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = listed(hnsw.nearest(frame))
    exact = vectors.astype(float)
    unit = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    hits = {True: [], False: []}
    for q, found in got.items():
        rough = unit @ unit[q]
        rough[q] = -np.inf
        least = np.partition(rough, -5)[-5] - 1e-12
        want = sorted((-hnsw.cosines(exact[q], exact[[i]])[0], int(i)) for i in np.flatnonzero(rough >= least))[:5]
        hits[q in near or q in line] += [(-s, i) in want for i, s in found]
    assert len(got) == -(-size // 50) and all(len(f) == 5 for f in got.values())
    assert np.mean(hits[True]) == 1 and np.mean(hits[False]) >= 0.97


def test_parts_of_the_queries_give_what_one_part_gives(spark):
    rows = hnsw.usable(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), "vec_id", "embedding")
    index = hnsw.materialize(hnsw.build_index(rows, 3, 200))
    asked = rows.where("vec_id % 9 = 0").distinct()
    want = listed(hnsw.search_index(index, asked, 3))
    assert len(want) == asked.count() > 0
    for part_queries, block_rows in [(16, 5), (40, 1)]:
        assert listed(hnsw.search_index(index, asked, 3, block_rows=block_rows, part_queries=part_queries)) == want
