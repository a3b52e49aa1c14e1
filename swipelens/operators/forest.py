"""Random forests on one-byte bins, grown tree by tree in tasks and kept in files.

A tree is grown by one task over all rows, so tasks exchange nothing. The rows are the table of bins
that boosted trees use; a task reads it from the shared folder and orders it by key, so draws do not
depend on how rows are dealt out. A row counts as often in a tree as a Poisson draw says, every node
looks at its own draw of features, and the split with the largest decrease of the weighted Gini
impurity is taken, down to pure nodes or ``maxDepth``. Two leaves that predict alike become one.

Nodes of many rows are split one by one by their histograms. Smaller ones are taken together in
blocks whose rows are copied side by side, and split level by level: by histograms while nodes have
more rows than bins, by sorting after that.

Trees have a node for every few rows, so they never reach the driver: a row of the model's table is
a packed tree, and a task that scores reads it tree by tree, for up to ``SCORED_ROWS`` rows at a time.
A task needs about (2 * features + 40) bytes a row; a missing value goes right at every split.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens.operators.boosting import MOST_BYTES, ROW_OVERHEAD, Binned
from swipelens.session import new_path, ship

#: Parameters that trees grown here know; a fit with others is left to Spark.
KNOWN = {"numTrees", "maxDepth", "featureSubsetStrategy", "minInstancesPerNode", "cacheNodeIds", "maxMemoryInMB"}
#: Nodes below so many rows are split together, in blocks of about so many.
FEW_ROWS, BLOCK_ROWS = 2048, 1 << 17
#: Rows that a task scores at a time, those that walk a tree at a time, and tasks per slot that grow trees.
SCORED_ROWS, WALKED_ROWS, GROWING_TASKS = 1 << 18, 1 << 13, 3
#: Levels that rows go down before those in leaves are left out.
LEVELS_WALKED = 4
#: A row counts at most so often in a tree: one of 10**14 draws is larger.
MOST_DRAWN = 15
BINS = 256
SHARE = float(1 << 40)

_TREE = np.dtype([("feature", "<i2"), ("left", "<i4"), ("threshold", "<f8"), ("share", "<f8")])
_SCHEMA = "tree INT, nodes BINARY, n_nodes INT, importances ARRAY<DOUBLE>"


def features_drawn(strategy: str, features: int) -> int | None:
    """How many features a node looks at, by Spark's names of it; none if it is another."""
    named = {
        "auto": math.ceil(math.sqrt(features)), "sqrt": math.ceil(math.sqrt(features)), "all": features,
        "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3),
    }
    if strategy.lower() in named:
        return named[strategy.lower()]
    if re.fullmatch(r"\d+", strategy) and int(strategy):
        return min(int(strategy), features)
    if re.fullmatch(r"\d*\.\d+", strategy) and 0 < float(strategy) <= 1:
        return math.ceil(float(strategy) * features)
    return None


def fits_here(df: DataFrame, rows: int, features: int, params: dict) -> bool:
    """Whether every slot can hold the rows, and the parameters are known."""
    return (
        set(params) <= KNOWN and rows * (2 * features + ROW_OVERHEAD) <= MOST_BYTES
        and features_drawn(str(params["featureSubsetStrategy"]), features) is not None
    )


# --- inside a task ------------------------------------------------------------------------


class Grower:
    """Grows trees over bins (rows, features), best held by feature, labels 0 or 1, and the weights of the two."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, weights: tuple[float, float], drawn: int, depth: int, least: int = 1):
        self.columns, self.label = np.ascontiguousarray(bins.T), label.astype(np.uint8)
        self.weights, self.drawn, self.depth, self.least = weights, drawn, depth, max(1, least)

    def _score(self, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
        a, b = pos * self.weights[1], neg * self.weights[0]
        total = a + b
        return (a * a + b * b) / np.where(total > 0, total, 1.0)

    def _choose(self, nodes: int) -> np.ndarray:
        """The features that each node looks at, in ascending order."""
        width = len(self.columns)
        if self.drawn >= width:
            return np.broadcast_to(np.arange(width), (nodes, width))
        order = self.rng.random((nodes, width), dtype=np.float32)
        return np.sort(np.argpartition(order, self.drawn - 1, axis=1)[:, :self.drawn], axis=1)

    def _add(self, depth: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> int:
        """New nodes, leaves so far; the number of the first."""
        first = self.size
        self.size += len(pos)
        self.parts.append((depth, pos, neg))
        return first

    def _split(self, node: np.ndarray, feature: np.ndarray, at: np.ndarray, left: int | np.ndarray) -> None:
        self.splits.append((np.atleast_1d(node), np.atleast_1d(feature), np.atleast_1d(at), np.atleast_1d(left)))

    def _sides(self, lp: np.ndarray, ln: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
        """The score of a split, which is to exceed that of the node; -inf where a side is too small."""
        rp, rn = pos - lp, neg - ln
        found = self._score(lp, ln) + self._score(rp, rn)
        return np.where(np.minimum(lp + ln, rp + rn) >= self.least, found, -np.inf)

    def _gains(self, best: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
        """Whether a split lowers the impurity by more than rounding."""
        return best > self._score(pos, neg) + 1e-9 * (pos * self.weights[1] + neg * self.weights[0])

    def _large(self, node: int, depth: int, rows: tuple[np.ndarray, np.ndarray], pos: float, neg: float) -> list[tuple]:
        """Split one node, whose rows are parted by label; its children that can be split."""
        drawn = [self.times.take(r).astype(np.float64) for r in rows]
        best, feature, at = -np.inf, -1, -1
        for f in self._choose(1)[0]:
            ln, lp = (
                np.cumsum(np.bincount(self.columns[f].take(r), w, BINS))[:-1] for r, w in zip(rows, drawn)
            )
            found = self._sides(lp, ln, pos, neg)
            b = int(np.argmax(found))
            if found[b] > best:
                best, feature, at, sides = found[b], int(f), b, (lp[b], ln[b])
        if feature < 0 or not self._gains(best, pos, neg):
            return []
        goes = [self.columns[feature].take(r) <= at for r in rows]
        pair = np.array([sides[0], pos - sides[0]]), np.array([sides[1], neg - sides[1]])
        first = self._add(np.full(2, depth + 1, np.uint8), *pair)
        self._split(np.array(node), np.array(feature), np.array(at), first)
        return [
            (first + k, depth + 1, tuple(r[~g] if k else r[g] for r, g in zip(rows, goes)), pair[0][k], pair[1][k])
            for k in (0, 1) if pair[0][k] and pair[1][k] and depth + 1 < self.depth
        ]

    def _block(self, nodes: list[tuple]) -> None:
        """Grow all that is below some nodes, level by level."""
        rows = np.concatenate([r for n in nodes for r in n[2]])
        flat, width = self.columns[:, rows].T.ravel(), len(self.columns)
        code = self.label[rows].astype(np.int64) << 4 | self.times[rows]
        own = np.repeat(np.arange(len(nodes)), [sum(map(len, n[2])) for n in nodes])
        begin = np.arange(len(rows)) * width
        number, depth = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes], np.uint8)
        pos, neg = (np.array([n[k] for n in nodes], np.float64) for k in (3, 4))
        while len(number):
            count, chosen = len(number), self._choose(len(number))
            best, feature, at = np.full(count, -np.inf), np.zeros(count, np.int64), np.zeros(count, np.int64)
            left_pos, left_neg = np.zeros(count), np.zeros(count)
            dense = count * BINS <= 2 * len(own)
            for j in range(chosen.shape[1]):
                place = begin + chosen[:, j].take(own)
                value = flat.take(place)
                found = (self._by_bins if dense else self._by_order)(own, value, code, pos, neg)
                better = found[0] > best
                for kept, new in zip((best, at, left_pos, left_neg), found):
                    kept[better] = new[better]
                feature[better] = chosen[better, j]
            open_ = np.flatnonzero(self._gains(best, pos, neg))
            if not len(open_):
                return
            lp, ln = left_pos[open_], left_neg[open_]
            pair_pos = np.stack([lp, pos[open_] - lp], axis=1).ravel()
            pair_neg = np.stack([ln, neg[open_] - ln], axis=1).ravel()
            below = np.repeat(depth[open_] + np.uint8(1), 2)
            first = self._add(below, pair_pos, pair_neg)
            self._split(number[open_], feature[open_], at[open_], first + 2 * np.arange(len(open_)))
            # Children that can be split are numbered anew, rows of all others leave.
            again = np.flatnonzero((pair_pos > 0) & (pair_neg > 0) & (below < self.depth))
            child = np.full(2 * len(open_), -1)
            child[again] = np.arange(len(again))
            rank = np.full(count, -1)
            rank[open_] = np.arange(len(open_))
            stays = np.flatnonzero(rank.take(own) >= 0)
            own, begin, code = own[stays], begin[stays], code[stays]
            right = flat.take(begin + feature.take(own)) > at.take(own)
            own = child.take(2 * rank.take(own) + right)
            stays = np.flatnonzero(own >= 0)
            own, begin, code = own[stays], begin[stays], code[stays]
            number, depth, pos, neg = first + again, below[again], pair_pos[again], pair_neg[again]

    def _by_bins(self, own, value, code, pos, neg) -> tuple[np.ndarray, ...]:
        """Best score per node, its bin, and the positives and negatives left of it."""
        cells = own * (2 * BINS) + (code >> 4) * BINS + value
        counted = np.bincount(cells, code & MOST_DRAWN, len(pos) * 2 * BINS).reshape(len(pos), 2, BINS)
        along = np.cumsum(counted, axis=2)[:, :, :-1]
        found = self._sides(along[:, 1], along[:, 0], pos[:, None], neg[:, None])
        b, every = np.argmax(found, axis=1), np.arange(len(pos))
        return found[every, b], b, along[every, 1, b], along[every, 0, b]

    def _by_order(self, own, value, code, pos, neg) -> tuple[np.ndarray, ...]:
        """The same from the rows in order of node and bin."""
        key = np.sort((own << 13 | value.astype(np.int64) << 5 | code).astype(np.uint32))
        group, times = key >> 5, (key & MOST_DRAWN).astype(np.int64)
        ends = np.flatnonzero(np.append(group[1:] != group[:-1], True))
        all_, ones = np.cumsum(times)[ends], np.cumsum(times * (key >> 4 & 1))[ends]
        node = (group[ends] >> 8).astype(np.int64)
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        before = np.maximum(starts - 1, 0)
        base_all, base_ones = np.where(starts > 0, all_[before], 0), np.where(starts > 0, ones[before], 0)
        lp = (ones - base_ones[node]).astype(np.float64)
        ln = (all_ - base_all[node]) - lp
        found = self._sides(lp, ln, pos[node], neg[node])
        best = np.maximum.reduceat(found, starts)
        hits = np.flatnonzero(found == best[node])
        hits = hits[np.unique(node[hits], return_index=True)[1]]
        return best, (group[ends[hits]] & 255).astype(np.int64), lp[hits], ln[hits]

    def tree(self, seed: list[int]) -> tuple[np.ndarray, ...]:
        """Arrays of a tree, root first: feature (-1 in leaves), bin, left child (the right one is
        next to it), positives and negatives."""
        self.rng = np.random.default_rng(seed)
        self.times = np.minimum(self.rng.poisson(1.0, len(self.label)), MOST_DRAWN).astype(np.uint8)
        rows = tuple(np.flatnonzero((self.times > 0) & (self.label == k)) for k in (0, 1))
        pos = float(self.times[self.label == 1].sum(dtype=np.int64))
        neg = float(self.times.sum(dtype=np.int64)) - pos
        self.size, self.parts, self.splits = 0, [], []
        self._add(np.zeros(1, np.uint8), np.array([pos]), np.array([neg]))
        large, small, held = [(0, 0, rows, pos, neg)] if pos and neg and self.depth else [], [], 0
        while large or small:
            if large:
                node = large.pop()
                size = sum(map(len, node[2]))
                if size >= FEW_ROWS:
                    large += self._large(*node)
                    continue
                small.append(node)
                held += size
            if held >= BLOCK_ROWS or not large:
                self._block(small)
                small, held = [], 0
        return self._pruned()

    def _pruned(self) -> tuple[np.ndarray, ...]:
        depth, pos, neg = (np.concatenate(x) for x in zip(*self.parts))
        feature, at, left = np.full(self.size, -1), np.zeros(self.size, np.int64), np.full(self.size, -1)
        for node, f, b, first in self.splits:
            feature[node], at[node], left[node] = f, b, first
        says = pos * self.weights[1] > neg * self.weights[0]
        levels = [np.flatnonzero((depth == d) & (feature >= 0)) for d in range(int(depth.max()) + 1)]
        for inner in reversed(levels):
            a, b = left[inner], left[inner] + 1
            feature[inner[(feature[a] < 0) & (feature[b] < 0) & (says[a] == says[b])]] = -1
        kept = np.zeros(self.size, bool)
        kept[0] = True
        for inner in levels:
            inner = inner[kept[inner] & (feature[inner] >= 0)]
            kept[left[inner]] = kept[left[inner] + 1] = True
        place = np.cumsum(kept) - 1
        left = np.where(feature >= 0, place[left], -1)
        return tuple(x[kept] for x in (feature, at, left, pos, neg))

    def importances(self, feature, at, left, pos, neg) -> np.ndarray:
        """Weighted decrease of impurity by feature, as shares."""
        inner = np.flatnonzero(feature >= 0)
        score = self._score(pos, neg)
        gain = score[left[inner]] + score[left[inner] + 1] - score[inner]
        total = np.bincount(feature[inner], gain, len(self.columns))
        return total / total.sum() if total.sum() > 0 else total


def _files(folder: str) -> tuple[fs.FileSystem, list[str]]:
    uri = re.sub(r"^file:/(?!/)", "file:///", folder) if ":" in folder else f"file://{folder}"
    files, path = fs.FileSystem.from_uri(uri)
    found = [i.path for i in files.get_file_info(fs.FileSelector(path)) if i.base_name.endswith(".parquet")]
    return files, sorted(found)


def _read_bins(folder: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows of a table of bins in order of their keys: bins, held by feature, and labels."""
    files, paths = _files(folder)
    counts = []
    for path in paths:
        with files.open_input_file(path) as source:
            counts.append(pq.ParquetFile(source).metadata.num_rows)
    size, at = sum(counts), 0
    bins, labels, keys = np.empty((size, width), np.uint8), np.empty(size, np.uint8), np.empty(size, np.int64)
    for path in paths:
        with files.open_input_file(path) as source:
            for batch in pq.ParquetFile(source).iter_batches(1 << 16, columns=["key", "label", "bins"]):
                here = slice(at, at + batch.num_rows)
                bins[here] = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
                labels[here], keys[here] = batch.column("label").to_numpy(), batch.column("key").to_numpy()
                at += batch.num_rows
    order = np.argsort(keys, kind="stable")
    columns = np.empty((width, size), np.uint8)
    for feature in range(width):
        columns[feature] = bins[:, feature].take(order)
    return columns.T, labels.take(order)


def _grow(folder: str, edges: list[list[float]], weights: tuple[float, float], params: dict, seed: int):
    width = len(edges)
    sizes = [len(e) for e in edges]
    cuts = np.concatenate([*map(np.array, edges), [np.nan]])
    starts = np.concatenate([[0], np.cumsum(sizes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grower = None
        for batch in batches:
            for tree in batch.column("id").to_pylist():
                grower = grower or Grower(
                    *_read_bins(folder, width), weights, features_drawn(str(params["featureSubsetStrategy"]), width),
                    params["maxDepth"], params.get("minInstancesPerNode", 1),
                )
                found = grower.tree([seed, tree])
                feature, at, left, pos, neg = found
                nodes = np.empty(len(feature), _TREE)
                nodes["feature"], nodes["left"] = feature, left
                nodes["threshold"] = cuts[np.where(feature >= 0, starts[feature] + at, len(cuts) - 1)]
                total = pos * weights[1] + neg * weights[0]
                # Whole parts of 2**-40: their sums are exact, whatever the order of the trees.
                nodes["share"] = np.rint(pos * weights[1] / np.where(total > 0, total, 1.0) * SHARE) / SHARE
                yield pa.RecordBatch.from_arrays([
                    pa.array([tree], pa.int32()), pa.array([nodes.tobytes()], pa.binary()),
                    pa.array([len(nodes)], pa.int32()), pa.array([grower.importances(*found).tolist()], pa.list_(pa.float64())),
                ], ["tree", "nodes", "n_nodes", "importances"])

    return run


def shares(values: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The share of class 1 in the leaf of every row; a missing value lies above all splits."""
    inner = nodes["feature"] >= 0
    # Child and feature side by side; a leaf leads to itself.
    steps = np.where(inner, nodes["left"], np.arange(len(nodes))).astype(np.int64) << 16 | np.where(inner, nodes["feature"], 0)
    limits, result = np.where(inner, nodes["threshold"], np.inf), np.empty(len(values))
    leaf_shares = np.ascontiguousarray(nodes["share"])
    # Few rows at a time, which stay in the processor's cache from level to level.
    for begin in range(0, len(values), WALKED_ROWS):
        part = values[begin:begin + WALKED_ROWS]
        flat, at, rows = np.where(np.isnan(part), np.inf, part).ravel(), np.zeros(len(part), np.int64), np.arange(len(part))
        place, here = rows * values.shape[1], at
        while len(rows):
            for _ in range(LEVELS_WALKED):
                step = steps.take(here)
                here = (step >> 16) + (flat.take(place + (step & 0xFFFF)) > limits.take(here))
            at[rows] = here
            below = np.flatnonzero(inner.take(here))
            rows, place, here = rows.take(below), place.take(below), here.take(below)
        result[begin:begin + WALKED_ROWS] = leaf_shares.take(at)
    return result


# --- the model ----------------------------------------------------------------------------


class StoredForestModel(Model):
    """Trees as a table in the shared folder, one packed tree a row; the driver holds its sums only."""

    def __init__(self, path: str, n_features: int, trees: int, n_nodes: int, importances: list[float]):
        super().__init__()
        self.path, self.numFeatures, self.getNumTrees, self.totalNumNodes = path, n_features, trees, n_nodes
        self.importances = importances

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances)

    def _transform(self, df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        path, trees, width = self.path, self.getNumTrees, self.numFeatures

        def score(held: list[np.ndarray]) -> np.ndarray:
            values = np.concatenate(held)
            total, (files, paths) = np.zeros(len(values)), _files(path)
            for one in paths:
                with files.open_input_file(one) as source:
                    for batch in pq.ParquetFile(source).iter_batches(1, columns=["nodes"]):
                        for packed in batch.column("nodes"):
                            total += shares(values, np.frombuffer(packed.as_buffer(), _TREE))
            return total / trees

        @F.pandas_udf("double")
        def share(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held, rows = [], 0

            def scored() -> Iterator[pd.Series]:
                found, begin = score(held) if rows else np.empty(0), 0
                for v in held:
                    yield pd.Series(found[begin:begin + len(v)])
                    begin += len(v)

            for v in vectors:
                held.append(np.stack(v.to_numpy()) if len(v) else np.empty((0, width)))
                rows += len(v)
                if rows >= SCORED_ROWS:
                    yield from scored()
                    held, rows = [], 0
            yield from scored()

        p = F.col("_share")
        return df.withColumn("_share", share(vector_to_array("features"))).withColumns({
            "rawPrediction": array_to_vector(F.array((1 - p) * trees, p * trees)),
            "probability": array_to_vector(F.array(1 - p, p)),
            "prediction": F.when(p > 0.5, 1.0).otherwise(0.0),
        }).drop("_share")

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        spark.read.schema(_SCHEMA).parquet(self.path).write.mode("overwrite").parquet(f"{path}/forest")
        state = json.dumps([self.numFeatures, self.getNumTrees, self.totalNumNodes, self.importances])
        spark.createDataFrame([(state,)], "state STRING").write.mode("overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "StoredForestModel":
        return cls(f"{path}/forest", *json.loads(spark.read.parquet(f"{path}/state").first()["state"]))


def fit(binned: Binned, weights: tuple[float, float], params: dict, seed: int) -> StoredForestModel:
    """Grow a forest on a written table of bins; ``weights`` are those of a negative and of a positive row."""
    spark = binned.table.sparkSession
    folder = binned.table.inputFiles()[0].rpartition("/")[0]
    ship(spark)
    slots, trees = max(1, spark.sparkContext.defaultParallelism), params["numTrees"]
    numbers = spark.range(0, trees, 1, min(trees, GROWING_TASKS * slots))
    path = new_path(spark)
    numbers.mapInArrow(_grow(folder, binned.edges, weights, params, seed), _SCHEMA).write.parquet(path)
    # A short row per tree.
    found = spark.read.schema(_SCHEMA).parquet(path).select("tree", "n_nodes", "importances").orderBy("tree").collect()
    total = np.sum([r["importances"] for r in found], axis=0)
    total = total / total.sum() if total.sum() > 0 else total
    return StoredForestModel(path, len(binned.edges), trees, sum(r["n_nodes"] for r in found), total.tolist())
