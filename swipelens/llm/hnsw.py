"""Approximate nearest neighbours by cosine: one navigable small-world graph per shard.

Equal vectors are one point of the graph; a point keeps the smallest ids of its rows, as many
as a result can need, so a vector with many copies costs no more than any other. Points are
dealt to shards by hash. Each shard is a hierarchical graph, stored as flat arrays: neighbour
numbers level by level, with a fixed number of places per point, padded with -1.

Points are inserted in batches: a batch searches the graph as it stands, then links to what it
found and to its own members, by the usual rule that a neighbour must be nearer to the point
than to a neighbour already chosen. Searches advance many queries at once, one step each.

Queries are written to the shared folder once. The task that holds a shard reads them from there
block by block, so neither queries nor graphs are copied by a shuffle: what moves is each shard
once, and the ``k`` best of every query and shard. Beyond ``PART_QUERIES`` queries a shard goes to
several tasks, each of which reads a part of the files.

The best of all shards are merged by the exact score: the cosine of the original vectors in double
precision. The graph is searched in single precision; all that a search finds is scored exactly,
and where what it finds is too alike for single precision to tell, all points of the shard are.
Shards, blocks and so the memory of tasks have a bounded size; more rows mean more of them.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no
part, as query or candidate. Vectors of different lengths are never compared. Rows without an
id take no part. Rows that share an id count once per vector. Fewer candidates than ``k`` give
fewer rows. An empty table gives an empty result. Columns other than id and vector are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipelens.llm.common import ship
from swipelens.llm.files import rows_of
from swipelens.session import materialize, new_path

#: Neighbours per point on the upper levels; the lowest has twice as many.
LINKS = 16
BUILD_BEAM = 96
SEARCH_BEAM = 128
SHARD_ROWS = 16384
BLOCK_ROWS = 2048
#: Queries that one task asks one shard.
PART_QUERIES = 1 << 18
#: Points that are inserted, or queries that are advanced, together.
BATCH = 256

#: Single-precision cosines within ``ALIKE`` may be in any order; double ones within ``CLOSE`` too.
ALIKE = 4e-6
CLOSE = 1e-12

INDEX = "dim INT, shard BIGINT, n INT, vectors BINARY, ids BINARY, id_ends BINARY, levels BINARY, graph BINARY"
FOUND = "query_id BIGINT, vec_id BIGINT, score DOUBLE"


class Graph:
    """Unit vectors and their neighbours; ``graph[level]`` is (points, places) with -1 for none."""

    def __init__(self, unit: np.ndarray, levels: np.ndarray, graph: list[np.ndarray]):
        self.unit, self.levels, self.graph = unit, levels, graph

    @staticmethod
    def draw_levels(keys: list[int]) -> np.ndarray:
        """Level of each point: geometric, from a hash of its key, so that it never changes."""
        u = np.array([xxhash.xxh64_intdigest(k.to_bytes(8, "little", signed=True), 7) for k in keys], np.float64)
        return np.minimum(12, -np.log((u + 1) / 2.0**64) / math.log(LINKS)).astype(np.int8)

    @classmethod
    def build(cls, unit: np.ndarray, keys: list[int]) -> "Graph":
        levels = cls.draw_levels(keys)
        # Higher points first: a point then finds every level that it needs already there.
        order = np.lexsort((np.array(keys), -levels))
        unit, levels = unit[order], levels[order]
        top = int(levels[0]) if len(levels) else 0
        self = cls(unit, levels, [
            np.full((len(unit), LINKS * (2 if level == 0 else 1)), -1, np.int32) for level in range(top + 1)
        ])
        self.order = order
        done = 0
        while done < len(unit):
            # The first batches are small, so that there is a graph to search.
            size = min(BATCH, max(1, done // 2), len(unit) - done)
            self._insert(np.arange(done, done + size))
            done += size
        return self

    def _insert(self, batch: np.ndarray) -> None:
        first, vectors = int(batch[0]), self.unit[batch]
        own = vectors @ vectors.T
        np.fill_diagonal(own, -np.inf)
        for level in range(int(self.levels[batch].max()), -1, -1):
            here = np.flatnonzero(self.levels[batch] >= level)
            reach = int((self.levels[:first] >= level).sum())
            # Batch members are candidates of each other.
            near = min(LINKS * 2, len(here) - 1)
            sub = own[np.ix_(here, here)]
            peers = np.argsort(-sub, axis=1, kind="stable")[:, :near]
            ids, sims = batch[here][peers], np.take_along_axis(sub, peers, 1)
            if reach:
                found, scores = self.search(vectors[here], BUILD_BEAM, level, limit=first)
                ids, sims = np.concatenate([found, ids], axis=1), np.concatenate([scores, sims], axis=1)
            if not ids.shape[1]:
                continue
            places = self.graph[level].shape[1]
            chosen = self._choose(vectors[here], ids, sims, LINKS)
            self.graph[level][batch[here], :LINKS] = chosen
            self._link_back(level, batch[here], chosen, places)

    def _choose(self, vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each row the diverse nearest candidates; places left are filled with the nearest rest."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        ids = np.where(np.isfinite(sims), ids, -1)
        again = np.zeros(ids.shape, bool)
        sorted_at = np.argsort(ids, axis=1, kind="stable")
        in_order = np.take_along_axis(ids, sorted_at, 1)
        np.put_along_axis(again, sorted_at[:, 1:], in_order[:, 1:] == in_order[:, :-1], 1)
        ids = np.where(again, -1, ids)
        rows = self.unit[np.maximum(ids, 0)]
        between = rows @ rows.transpose(0, 2, 1)
        picked = np.zeros(ids.shape, bool)
        for c in range(ids.shape[1]):
            shadowed = (picked & (between[:, c, :] > sims[:, c, None])).any(axis=1)
            picked[:, c] = (ids[:, c] >= 0) & ~shadowed & (picked.sum(axis=1) < most)
        rank = np.where(picked, 0, np.where(ids >= 0, 1, 2))
        best = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(ids, best, 1)
        if out.shape[1] < most:
            out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
        return out

    def _link_back(self, level: int, points: np.ndarray, chosen: np.ndarray, places: int) -> None:
        to, source = chosen.ravel(), np.repeat(points, chosen.shape[1])
        keep = to >= 0
        to, source = to[keep], source[keep]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        targets, begins, counts = np.unique(to, return_index=True, return_counts=True)
        width = int(counts.max(initial=0))
        if not width:
            return
        new = np.full((len(targets), width), -1, np.int64)
        new[np.repeat(np.arange(len(targets)), counts), np.arange(len(to)) - np.repeat(begins, counts)] = source
        ids = np.concatenate([self.graph[level][targets].astype(np.int64), new], axis=1)
        for at in range(0, len(targets), BATCH // 4):
            some = slice(at, at + BATCH // 4)
            vectors = self.unit[targets[some]]
            sims = np.einsum("qd,qcd->qc", vectors, self.unit[np.maximum(ids[some], 0)])
            sims[ids[some] < 0] = -np.inf
            self.graph[level][targets[some]] = self._choose(vectors, ids[some], sims, places)

    def search(self, queries: np.ndarray, beam: int, level: int = 0, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Nearest points found per query, nearest first: numbers and cosines (-inf for none).

        ``limit``: points from there on do not exist yet.
        """
        known = len(self.unit) if limit is None else limit
        entry = np.zeros((len(queries), 1), np.int64)
        scores = np.einsum("qd,qcd->qc", queries, self.unit[entry])
        for upper in range(int(self.levels[0]), level, -1):
            entry, scores = self._walk(queries, entry, scores, 1, upper, known)
        return self._walk(queries, entry, scores, beam, level, known)

    def _walk(self, queries, entry, scores, beam, level, known):
        """Best-first search of many queries: in each step each expands its nearest unexpanded point."""
        n, graph = len(queries), self.graph[level]
        ids = np.full((n, beam), -1, np.int64)
        sims = np.full((n, beam), -np.inf)
        ids[:, :entry.shape[1]], sims[:, :entry.shape[1]] = entry, scores
        expanded = ids < 0
        # One place more, for the neighbours that a point does not have.
        seen = np.zeros((n, known + 1), bool)
        np.put_along_axis(seen, entry, True, 1)
        active = np.arange(n)
        while len(active):
            at = np.argmax(np.where(expanded[active], -np.inf, sims[active]), axis=1)
            open_ = ~expanded[active, at]
            active, at = active[open_], at[open_]
            if not len(active):
                break
            expanded[active, at] = True
            near = graph[ids[active, at]].astype(np.int64)
            near = np.where((near >= 0) & (near < known), near, known)
            fresh = (near < known) & ~seen[active[:, None], near]
            seen[active[:, None], near] = True
            found = np.einsum("qd,qcd->qc", queries[active], self.unit[np.where(fresh, near, 0)])
            found[~fresh] = -np.inf
            all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
            all_sims = np.concatenate([sims[active], found], axis=1)
            all_done = np.concatenate([expanded[active], ~fresh], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, 1)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            expanded[active] = np.take_along_axis(all_done, best, 1)
        return ids, sims


#: Vectors with components between 2 to the minus this and 2 to this are taken as they are.
SAFE_POWER = 400


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Dot product over the product of the norms, in double precision, one row at a time.

    A vector whose squares may overflow or vanish is scaled by a power of two first, which changes
    no other score.
    """
    def safe(vector: np.ndarray) -> np.ndarray:
        power = int(np.frexp(np.abs(vector).max())[1])
        return vector if abs(power) < SAFE_POWER else np.ldexp(vector, -power)

    query = safe(query)
    norm = math.sqrt(float(np.dot(query, query)))
    return np.array([float(np.dot(query, r)) / (norm * math.sqrt(float(np.dot(r, r)))) for r in map(safe, rows)])


def _unit(vectors: np.ndarray, kind: type = np.float32) -> np.ndarray:
    # Scaled first, so that no square overflows or vanishes.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(kind)


def _best(query: np.ndarray, units: np.ndarray, found: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` points nearest to a unit vector in double precision, and all that tie with the last.

    ``found`` and ``scores`` are what the graph gave. If the last of them is as near as the one at
    place ``most``, others in the shard may be as well.
    """
    if np.isfinite(scores[-1]) and len(scores) < len(units) and scores[-1] >= scores[most - 1] - ALIKE:
        found, exact = np.arange(len(units)), units @ query
    else:
        found = found[np.isfinite(scores)]
        exact = units[found] @ query
    if len(found) > most:
        found = found[exact >= np.partition(exact, -most)[-most] - CLOSE]
    return found


def usable(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    )


def points(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: its ``k`` + 1 smallest ids.

    A query's own id may be among them. Ranks are cut on the map side, so of a vector with
    many copies each task sends no more than that.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.distinct().withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k + 1)
    return least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard with the graph in flat arrays. ``rows``: what ``usable`` returns."""
    ship(rows.sparkSession)
    found = materialize(points(rows, k))
    shards = max(1, -(-found.count() // shard_rows))
    dealt = found.withColumns({
        "dim": F.size("vector"), "shard": F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)),
    })

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(frame["vector"].to_list()).astype("<f8")
        graph = Graph.build(_unit(vectors), [int(i[0]) for i in frame["ids"]])
        ids = [frame["ids"].iloc[i] for i in graph.order]
        flat = np.concatenate([np.concatenate([[level.shape[1]], level.ravel()]) for level in graph.graph]).astype("<i4")
        return pd.DataFrame([(
            key[0], key[1], len(vectors), vectors[graph.order].tobytes(), np.concatenate(ids).astype("<i8").tobytes(),
            np.cumsum([len(i) for i in ids]).astype("<i4").tobytes(), graph.levels.tobytes(), flat.tobytes(),
        )], columns=[c.split()[0] for c in INDEX.split(", ")])

    return dealt.groupBy("dim", "shard").applyInPandas(build, INDEX)


def _load(row) -> tuple[Graph, np.ndarray, list[np.ndarray]]:
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], -1)
    ids = np.split(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["id_ends"], "<i4")[:-1])
    flat, levels, at = np.frombuffer(row["graph"], "<i4"), [], 0
    while at < len(flat):
        places = int(flat[at])
        levels.append(flat[at + 1:at + 1 + row["n"] * places].reshape(row["n"], places))
        at += 1 + row["n"] * places
    return Graph(_unit(vectors), np.frombuffer(row["levels"], np.int8), levels), vectors, ids


def _blocks(folder: str, dim: int, part: int, parts: int, block_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the written queries with ``dim`` components, ``block_rows`` at a time."""
    ids: list[int] = []
    vectors: list[list[float]] = []
    for batch in rows_of(folder, part, parts, block_rows):
        for query, vector in zip(batch.column("query_id").to_pylist(), batch.column("vector").to_numpy(zero_copy_only=False)):
            if len(vector) == dim:
                ids.append(query)
                vectors.append(vector)
            if len(ids) == block_rows:
                yield np.array(ids), np.stack(vectors)
                ids, vectors = [], []
    if ids:
        yield np.array(ids), np.stack(vectors)


def search_index(
    index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, block_rows: int = BLOCK_ROWS,
    part_queries: int = PART_QUERIES,
) -> DataFrame:
    """The ``k`` nearest of all shards for each query (vec_id, vector), ranked from 1."""
    spark = index.sparkSession
    ship(spark)
    folder = new_path(spark)
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector")
    asked.write.option("maxRecordsPerFile", max(1, part_queries // 16)).parquet(folder)
    parts = max(1, -(-spark.read.schema("query_id BIGINT, vector ARRAY<DOUBLE>").parquet(folder).count() // part_queries))
    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    tasks = max(1, index.count() * parts)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(len(frame)):
                row = frame.iloc[at]
                graph, vectors, ids = _load(row)
                units = _unit(vectors, np.float64)
                for wanted_ids, wanted in _blocks(folder, int(row["dim"]), int(row["part"]), parts, block_rows):
                    out = []
                    for first in range(0, len(wanted), BATCH):
                        some = wanted[first:first + BATCH]
                        found, scores = graph.search(_unit(some), max(beam, k + 1))
                        for query, vector, unit, near, score in zip(
                            wanted_ids[first:first + BATCH], some, _unit(some, np.float64), found, scores
                        ):
                            near = _best(unit, units, near, score, k + 1)
                            exact = cosines(vector, vectors[near])
                            pairs = [(-s, int(i)) for s, p in zip(exact, near) for i in ids[p] if i != query]
                            out += [(int(query), i, -s) for s, i in sorted(pairs)[:k]]
                    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
                        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
                    )

    found = spread.repartition(tasks, "dim", "shard", "part").mapInPandas(ask, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest(df: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", every: int = 50,
            beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest other rows of every row whose id is divisible by ``every``."""
    rows = usable(df, id_col, vector)
    index = materialize(build_index(rows, k, shard_rows))
    return search_index(index, rows.where(F.col("vec_id") % every == 0).distinct(), k, beam, block_rows)
