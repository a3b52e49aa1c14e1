"""Boosted trees on one-byte bins, grown leaf by leaf.

The matrix is binned once into a table of one byte per feature, which all fits over it share. A
fit is one barrier stage: every task holds the bins of its rows and their margins, builds the
gradient histograms of the leaves that may be split next, and the tasks add these up among
themselves (``Exchange``: files in the shared folder, since ``allGather`` takes a second whatever
it carries, and a fit has thousands of sums); from equal sums every task takes equal decisions, so nothing but
histograms is exchanged. Of two children only the smaller one is counted, the other is the
difference. Features of few bins are counted together, as one column of joint codes whose sums
give theirs. The open leaf with the largest gain is split first, up to ``numLeaves`` and
``maxDepth``; with enough leaves for its depth a tree is one grown by levels.

Gradients are rounded to 2**-20 and summed as whole numbers, so trees do not depend on how rows
are dealt out or in which order they come, and a stage that is run again gives the same trees.

A task needs about (2 * features + 40) bytes a row. Tasks are as many as the counted bytes ask for,
and they must run at once, so a table is limited by the memory of the slots; beyond it
``too_large`` says so before anything is fitted. A missing value goes right at every split.
"""

from __future__ import annotations

import heapq
import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import BarrierTaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens.session import materialize, new_path, ship

#: Bytes of bins per task, and of all that a task holds.
TASK_BYTES = 16 << 20
MOST_BYTES = 1 << 30
#: Leaves whose children are counted ahead in one exchange, where tasks have to wait for each other.
AHEAD = 8
#: Joint codes of features that are counted together, and rows that are counted at a time.
JOINT_CODES = 2048
COUNT_ROWS = 1 << 16
#: Leaves of fewer rows are counted row by row: joint codes would cost more than they save.
FEW_ROWS = 2048
UNIT = float(1 << 20)
ROW_OVERHEAD = 40

_TREES = (
    "tree INT, node INT, feature INT, bin INT, left INT, right INT, value DOUBLE, gain DOUBLE, "
    "hessian DOUBLE, rows BIGINT"
)


@dataclass(frozen=True)
class BoostParams:
    """Parameters of a fit; names follow Spark's where it has them."""

    maxIter: int = 100
    stepSize: float = 0.1
    numLeaves: int = 31
    maxDepth: int = 0
    minInstancesPerNode: int = 20
    minHessian: float = 1e-3
    regAlpha: float = 0.0
    regLambda: float = 0.0
    minGain: float = 0.0
    subsamplingRate: float = 1.0
    baggingFreq: int = 1
    featureFraction: float = 1.0
    seed: int = 42

    @classmethod
    def of(cls, params: dict, seed: int) -> "BoostParams":
        known = {f.name for f in fields(cls)}
        unknown = set(params) - known
        if unknown:
            raise ValueError(f"unknown parameters {sorted(unknown)}; choose from {sorted(known)}")
        made = cls(**{"seed": seed, **params})
        # A tree of bounded depth has at most so many leaves.
        return replace(made, numLeaves=1 << made.maxDepth) if made.maxDepth and "numLeaves" not in params else made


@dataclass(frozen=True)
class Binned:
    """The table (key, label, bins) and the upper edges of each feature's bins."""

    table: DataFrame
    edges: list[list[float]]
    label: str
    rows: int

    def tasks(self) -> int:
        return max(1, -(-self.rows * len(self.edges) // TASK_BYTES))


def bin_edges(df: DataFrame, features: str = "features", bins: int = 255) -> list[list[float]]:
    """Smallest value and quantiles of every feature; at most ``bins`` - 1 edges each. One pass."""
    first = df.select(features).first()
    if first is None:
        raise ValueError("no rows to fit on")
    size = len(first[0])
    values = df.select(vector_to_array(features).alias("v"))
    shares = [k / (bins - 1) for k in range(1, bins - 1)]
    known = [F.when(~F.isnan(F.col("v")[i]), F.col("v")[i]) for i in range(size)]
    row = values.agg(*[
        F.struct(F.min(c).alias("lo"), F.percentile_approx(c, shares, 10_000).alias("q")).alias(f"f{i}")
        for i, c in enumerate(known)
    ]).first()
    return [sorted({v for v in [row[f"f{i}"]["lo"], *(row[f"f{i}"]["q"] or [])] if v is not None}) for i in range(size)]


def bin_rows(df: DataFrame, edges: list[list[float]], label: str, features: str = "features") -> Binned:
    """Write the table of bins: a value's bin is the number of edges below it."""
    ship(df.sparkSession)
    cuts = [np.array(e) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            bins = np.empty(values.shape, np.uint8)
            for i, cut in enumerate(cuts):
                bins[:, i] = np.searchsorted(cut, values[:, i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([r.tobytes() for r in bins], pa.binary())],
                ["key", "label", "bins"],
            )

    rows = df.select(
        F.xxhash64(vector_to_array(features), label).alias("key"),
        F.col(label).cast("int").alias("label"), vector_to_array(features).alias("v"),
    ).where("label is not null")
    table = materialize(rows.mapInArrow(run, "key BIGINT, label INT, bins BINARY"))
    return Binned(table, edges, label, table.count())


# --- inside a task ------------------------------------------------------------------------


def _hash_share(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per key and salt (a 64-bit finalizer)."""
    x = keys + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0 ** 64


class Columns:
    """Bins by row, and by column: a feature of many bins alone, others together in mixed-radix codes."""

    def __init__(self, bins: np.ndarray, sizes: list[int]):
        groups: list[list[int]] = []
        for feature in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
            for group in groups:
                if np.prod([sizes[f] for f in group]) * sizes[feature] <= JOINT_CODES:
                    group.append(feature)
                    break
            else:
                groups.append([feature])
        self.bins, self.starts = bins, np.concatenate([[0], np.cumsum(sizes)])
        self.groups, self.shapes, self.codes = groups, [tuple(sizes[f] for f in g) for g in groups], []
        self.place: dict[int, tuple[int, int, int]] = {}
        for number, (group, shape) in enumerate(zip(groups, self.shapes)):
            code, step = np.zeros(len(bins), np.uint8 if len(group) == 1 else np.uint16), 1
            for feature, size in zip(reversed(group), reversed(shape)):
                code += bins[:, feature] * code.dtype.type(step)
                self.place[feature] = number, step, size
                step *= size
            self.codes.append(code)

    def of(self, feature: int, rows: np.ndarray) -> np.ndarray:
        """Bins of one feature."""
        number, step, size = self.place[feature]
        code = self.codes[number].take(rows)
        return code if len(self.groups[number]) == 1 else code // code.dtype.type(step) % code.dtype.type(size)

    def count(self, rows: np.ndarray, *weights: np.ndarray) -> np.ndarray:
        """Sums of the weights, and rows, per bin; all features side by side in their order."""
        if len(rows) < FEW_ROWS:
            size, repeat = self.starts[-1], self.bins.shape[1]
            places = (self.bins[rows] + self.starts[:-1]).ravel()
            found = [np.bincount(places, np.repeat(w.take(rows), repeat), size) for w in weights]
            return np.stack([*found, np.bincount(places, minlength=size)]).astype(np.float64, copy=False)
        sums = [np.zeros((len(weights) + 1, int(np.prod(shape)))) for shape in self.shapes]
        for begin in range(0, len(rows), COUNT_ROWS):
            part = rows[begin:begin + COUNT_ROWS]
            values = [w.take(part) for w in weights]
            for codes, found in zip(self.codes, sums):
                code = codes.take(part).astype(np.intp)
                for at, value in enumerate(values):
                    found[at] += np.bincount(code, value, found.shape[1])
                found[-1] += np.bincount(code, minlength=found.shape[1])
        counted = np.empty((len(weights) + 1, self.starts[-1]))
        for group, shape, found in zip(self.groups, self.shapes, sums):
            joint = found.reshape(-1, *shape)
            for axis, feature in enumerate(group, start=1):
                others = tuple(a for a in range(1, joint.ndim) if a != axis)
                counted[:, self.starts[feature]:self.starts[feature + 1]] = joint.sum(axis=others) if others else joint
        return counted


@dataclass
class Leaf:
    """An open or closed leaf: its sums, its rows here, and the best split found."""

    depth: int
    sums: np.ndarray
    rows: np.ndarray
    bagged: np.ndarray
    histogram: np.ndarray | None = None
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    left_sums: np.ndarray | None = None
    children: "tuple[Leaf, Leaf] | None" = None


class Booster:
    """Grows trees over the bins of one task's rows; ``total`` adds arrays up over all tasks."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, keys: np.ndarray, sizes: list[int],
                 weights: tuple[float, float], params: BoostParams, total: Callable, ahead: int):
        self.columns, self.features = Columns(bins, sizes), len(sizes)
        self.label, self.keys, self.params, self.total, self.ahead = label, keys, params, total, ahead
        self.weight = np.where(label == 1, weights[1], weights[0])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.feature_of = np.repeat(np.arange(len(sizes)), sizes)
        # The last bin of a feature has nothing to its right.
        self.can_split = np.ones(self.starts[-1], bool)
        self.can_split[self.starts[1:] - 1] = False
        both = self.total(np.array([self._units(self.weight).sum(), self._units(self.weight * label).sum()]))
        share = min(max(both[1] / both[0] if both[0] else 0.5, 1e-12), 1 - 1e-12)
        self.start = float(np.log(share / (1 - share)))
        self.margin = np.full(len(label), self.start)

    @staticmethod
    def _units(values: np.ndarray) -> np.ndarray:
        return np.rint(values * UNIT)

    def _soft(self, g: np.ndarray) -> np.ndarray:
        return np.sign(g) * np.maximum(np.abs(g) - self.params.regAlpha, 0.0)

    def _score(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return self._soft(g) ** 2 / np.maximum(h + self.params.regLambda, 1e-15)

    def value(self, leaf: Leaf) -> float:
        g, h = leaf.sums[0] / UNIT, leaf.sums[1] / UNIT
        return float(-self.params.stepSize * self._soft(g) / max(h + self.params.regLambda, 1e-15))

    def _count(self, rows: np.ndarray) -> np.ndarray:
        """Gradient, hessian and rows per bin, all features side by side."""
        return self.columns.count(rows, self.g, self.h)

    def _search(self, leaf: Leaf, allowed: np.ndarray) -> None:
        """The split with the largest gain; the first bin of the first feature among equals."""
        p = self.params
        if p.maxDepth and leaf.depth >= p.maxDepth or leaf.sums[2] < 2 * p.minInstancesPerNode:
            return
        along = np.cumsum(leaf.histogram, axis=1)
        before = np.concatenate([np.zeros((3, 1)), along], axis=1)[:, self.starts[:-1]]
        left = along - before[:, self.feature_of]
        right = leaf.sums[:, None] - left
        gain = self._score(left[0] / UNIT, left[1] / UNIT) + self._score(right[0] / UNIT, right[1] / UNIT)
        gain -= self._score(leaf.sums[0] / UNIT, leaf.sums[1] / UNIT)
        fit = (
            self.can_split & allowed[self.feature_of]
            & (np.minimum(left[2], right[2]) >= max(1, p.minInstancesPerNode))
            & (np.minimum(left[1], right[1]) >= p.minHessian * UNIT)
        )
        gain = np.where(fit, gain, -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > max(p.minGain, 1e-12):
            leaf.gain, leaf.feature = float(gain[at]), int(self.feature_of[at])
            leaf.bin, leaf.left_sums = at - int(self.starts[leaf.feature]), left[:, at].copy()

    def _part(self, leaf: Leaf) -> tuple[Leaf, Leaf]:
        def halves(rows):
            left = self.columns.of(leaf.feature, rows) <= leaf.bin
            return rows[left], rows[~left]

        (rows_l, rows_r) = halves(leaf.rows)
        bag_l, bag_r = (rows_l, rows_r) if leaf.bagged is leaf.rows else halves(leaf.bagged)
        return (
            Leaf(leaf.depth + 1, leaf.left_sums, rows_l, bag_l),
            Leaf(leaf.depth + 1, leaf.sums - leaf.left_sums, rows_r, bag_r),
        )

    def _expand(self, leaves: list[Leaf], allowed: np.ndarray) -> None:
        """Children of the leaves with their histograms and best splits; one exchange for all."""
        small = []
        for leaf in leaves:
            leaf.children = self._part(leaf)
            small.append(int(leaf.children[0].sums[2] > leaf.children[1].sums[2]))
        counted = self.total(np.stack([self._count(x.children[s].bagged) for x, s in zip(leaves, small)]))
        for leaf, s, histogram in zip(leaves, small, counted):
            leaf.children[s].histogram = histogram
            leaf.children[1 - s].histogram = leaf.histogram - histogram
            leaf.histogram = None
            for child in leaf.children:
                self._search(child, allowed)

    def tree(self, number: int) -> list[tuple]:
        """Grow one tree, add it to the margins, and return its nodes, root first."""
        p, n = self.params, len(self.label)
        probability = 1 / (1 + np.exp(-self.margin))
        self.g = self._units(self.weight * (probability - self.label))
        self.h = self._units(self.weight * probability * (1 - probability))
        every = np.arange(n)
        bagged = every
        if p.subsamplingRate < 1 and p.baggingFreq:
            salt = p.seed * 1_000_003 + number // p.baggingFreq
            bagged = every[_hash_share(self.keys, salt) < p.subsamplingRate]
        count = self.features
        allowed = np.ones(count, bool)
        if p.featureFraction < 1:
            chosen = np.random.default_rng([p.seed, number]).permutation(count)[:max(1, round(p.featureFraction * count))]
            allowed = np.isin(np.arange(count), chosen)
        histogram = self.total(self._count(bagged)[None])[0]
        # Any feature's bins add up to the sums of the node.
        root = Leaf(0, histogram[:, :self.starts[1]].sum(axis=1), every, bagged, histogram)
        self._search(root, allowed)
        open_leaves, order = [(-root.gain, 0, root)] if root.gain else [], 1
        leaves, split = 1, []
        while open_leaves and leaves < p.numLeaves:
            if open_leaves[0][2].children is None:
                # The best ones are counted together; which of them are split is decided below.
                best = heapq.nsmallest(min(self.ahead, p.numLeaves - leaves), open_leaves)
                self._expand([x for _, _, x in best if x.children is None], allowed)
            _, _, leaf = heapq.heappop(open_leaves)
            leaves += 1
            split.append(leaf)
            for child in leaf.children:
                if child.gain:
                    heapq.heappush(open_leaves, (-child.gain, order, child))
                order += 1
        chosen = {id(x) for x in split}
        nodes: list[tuple] = []

        def walk(leaf: Leaf) -> int:
            at = len(nodes)
            nodes.append(())
            value, known = self.value(leaf), (leaf.sums[1] / UNIT, int(leaf.sums[2]))
            if id(leaf) in chosen:
                left, right = walk(leaf.children[0]), walk(leaf.children[1])
                nodes[at] = (number, at, leaf.feature, leaf.bin, left, right, value, leaf.gain, *known)
            else:
                self.margin[leaf.rows] += value
                nodes[at] = (number, at, -1, -1, -1, -1, value, 0.0, *known)
            return at

        walk(root)
        return nodes


def packed(part: np.ndarray) -> bytes:
    """Whole numbers as bytes: small ones leave high bytes of zeros, which compress to nothing."""
    whole = part.astype("<i8").ravel()
    high_first = ((whole << 1) ^ (whole >> 63)).view(np.uint8).reshape(-1, 8).T
    return pa.compress(high_first.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, shape: tuple[int, ...]) -> np.ndarray:
    size = int(np.prod(shape))
    raw = pa.decompress(data, size * 8, codec="zstd", asbytes=True)
    coded = np.frombuffer(raw, np.uint8).reshape(8, size).T.copy().view("<u8")
    return ((coded >> np.uint64(1)).astype("<i8") ^ -(coded & np.uint64(1)).astype("<i8")).astype(np.float64).reshape(shape)


class Exchange:
    """Sums over the tasks of a barrier stage: each writes its part of a round, all read all parts.

    A file appears under its name when it is whole. Who writes a round has read the one before, so
    a task that has read a round deletes its own part of the previous one. Barrier tasks run at
    once and end together if one fails, so nobody waits for a task that is gone.
    """

    def __init__(self, folder: str, own: int, peers: int):
        uri = re.sub(r"^file:/(?!/)", "file:///", folder) if ":" in folder else f"file://{folder}"
        self.files, path = fs.FileSystem.from_uri(uri)
        self.path, self.own, self.peers, self.round = path.rstrip("/"), own, peers, 0
        self.files.create_dir(self.path, recursive=True)

    def _name(self, number: int, task: int) -> str:
        return f"{self.path}/{number}-{task}"

    def total(self, part: np.ndarray) -> np.ndarray:
        name = self._name(self.round, self.own)
        with self.files.open_output_stream(f"{name}.part") as out:
            out.write(packed(part))
        self.files.move(f"{name}.part", name)
        result, missing, wait = part.astype(np.float64), set(range(self.peers)) - {self.own}, 1e-4
        while missing:
            found = [i.path for i in self.files.get_file_info([self._name(self.round, t) for t in missing]) if i.type == fs.FileType.File]
            for path in found:
                with self.files.open_input_stream(path) as data:
                    result = result + unpacked(data.read(), part.shape)
                missing.discard(int(path.rsplit("-", 1)[1]))
            if not found:
                time.sleep(wait)
                wait = min(2 * wait, 0.02)
        if self.round:
            self.files.delete_file(self._name(self.round - 1, self.own))
        self.round += 1
        return result


def _task(sizes: list[int], weights: tuple[float, float], params: BoostParams, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        peers = len(context.getTaskInfos())

        total: Callable = np.asarray
        if peers > 1:
            # A stage that is run again starts in a folder of its own.
            attempt = min(context.allGather(uuid.uuid4().hex))
            total = Exchange(f"{folder}/{attempt}", context.partitionId(), peers).total

        bins, labels, keys = [np.empty((0, len(sizes)), np.uint8)], [np.empty(0)], [np.empty(0, np.int64)]
        for batch in batches:
            if batch.num_rows:
                raw = b"".join(x.as_buffer().to_pybytes() for x in batch.column("bins"))
                bins.append(np.frombuffer(raw, np.uint8).reshape(batch.num_rows, len(sizes)))
                labels.append(batch.column("label").to_numpy().astype(np.float64))
                keys.append(batch.column("key").to_numpy())
        # More are counted ahead only where an exchange costs time.
        booster = Booster(
            np.concatenate(bins), np.concatenate(labels), np.concatenate(keys).view(np.uint64), sizes, weights, params,
            total, 1 if peers == 1 else AHEAD,
        )
        if context.partitionId() == 0:
            yield _record([(-1, 0, -1, -1, -1, -1, booster.start, 0.0, 0.0, 0)])
        for number in range(params.maxIter):
            nodes = booster.tree(number)
            if context.partitionId() == 0:
                yield _record(nodes)

    return run


def _record(nodes: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 6 + [pa.float64()] * 3 + [pa.int64()]
    names = [part.split()[0] for part in _TREES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*nodes), kinds)], names)


# --- the model ----------------------------------------------------------------------------


class BoostedTreesModel(Model):
    """Trees as a table of nodes (one row each, children by number), and the margin before them."""

    def __init__(self, nodes: pd.DataFrame, start: float, n_features: int, settings: BoostParams):
        super().__init__()
        self.nodes, self.start, self.n_features, self.settings = nodes, start, n_features, settings

    def getMaxIter(self) -> int:
        return self.settings.maxIter

    @property
    def featureImportances(self) -> DenseVector:
        """Gain of the splits on each feature, as shares."""
        inner = self.nodes[self.nodes["feature"] >= 0]
        gains = np.bincount(inner["feature"], inner["gain"], self.n_features)
        return DenseVector(gains / gains.sum() if gains.sum() else gains)

    def cut(self, rounds: int) -> "BoostedTreesModel":
        """The model after its first rounds, equal to a fit of so many."""
        nodes = self.nodes[self.nodes["tree"] < rounds].reset_index(drop=True)
        return BoostedTreesModel(nodes, self.start, self.n_features, replace(self.settings, maxIter=rounds))

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Root of every tree, and per node: feature, threshold, left, right, value."""
        nodes = self.nodes
        node = nodes["node"].to_numpy()
        roots = np.flatnonzero(node == 0)
        base = np.arange(len(node)) - node
        feature = nodes["feature"].to_numpy()
        left, right = (np.where(feature >= 0, nodes[c].to_numpy() + base, np.arange(len(node))) for c in ("left", "right"))
        return roots, feature, nodes["threshold"].to_numpy(), left, right, nodes["value"].to_numpy()

    def _transform(self, df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast((self.arrays(), self.start))

        @F.pandas_udf("double")
        def margin(vectors: pd.Series) -> pd.Series:
            trees, start = shared.value
            values = np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, 0))
            return pd.Series(margins(values, trees, start))

        scored = df.withColumn("rawPrediction", margin(vector_to_array("features")))
        p = 1 / (1 + F.exp(-F.col("rawPrediction")))
        return scored.withColumns({
            "probability": array_to_vector(F.array(1 - p, p)),
            "prediction": F.when(p > 0.5, 1.0).otherwise(0.0),
        }).withColumn("rawPrediction", array_to_vector(F.array(-F.col("rawPrediction"), F.col("rawPrediction"))))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(self.nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        state = json.dumps({"start": self.start, "n_features": self.n_features, "params": asdict(self.settings)})
        spark.createDataFrame([(state,)], "state STRING").write.mode("overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTreesModel":
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        nodes = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"], ignore_index=True)
        return cls(nodes, state["start"], state["n_features"], BoostParams(**state["params"]))


def margins(values: np.ndarray, trees: tuple[np.ndarray, ...], start: float) -> np.ndarray:
    """Margins of rows: all trees step down together until every row is in a leaf."""
    roots, feature, threshold, left, right, value = trees
    result = np.full(len(values), start)
    rows = np.arange(len(values))
    for root in roots:
        at = np.full(len(values), root)
        open_rows = rows
        while len(open_rows):
            here = at[open_rows]
            open_rows, here = open_rows[feature[here] >= 0], here[feature[here] >= 0]
            # A missing value compares as false and goes right.
            goes = values[open_rows, feature[here]] <= threshold[here]
            at[open_rows] = np.where(goes, left[here], right[here])
        result += value[at]
    return result


def too_large(binned: Binned) -> str | None:
    """Why a table cannot be fitted on the slots of this session, if so."""
    slots = max(1, binned.table.sparkSession.sparkContext.defaultParallelism)
    need = binned.rows * (2 * len(binned.edges) + ROW_OVERHEAD)
    if need > slots * MOST_BYTES:
        return f"{need} bytes of bins and margins, but {slots} slots hold {slots * MOST_BYTES}: use more executors"
    return None


def fit(binned: Binned, params: BoostParams, weights: tuple[float, float] = (1.0, 1.0)) -> BoostedTreesModel:
    """Fit trees on a table of bins; ``weights`` are those of a negative and of a positive row.

    The trees reach the driver: a row per node, so their number follows from the parameters.
    """
    reason = too_large(binned)
    if reason:
        raise ValueError(reason)
    spark = binned.table.sparkSession
    ship(spark)
    sizes = [len(e) + 1 for e in binned.edges]
    tasks = min(binned.tasks(), max(1, spark.sparkContext.defaultParallelism))
    # A barrier stage begins at a shuffle: its tasks are those of the stage.
    rows = binned.table.repartition(tasks)
    nodes = rows.mapInArrow(_task(sizes, weights, params, new_path(spark)), _TREES, barrier=True).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    start = float(nodes["value"].iat[0])
    nodes = nodes[nodes["tree"] >= 0].reset_index(drop=True)
    # A split at a feature's last edge is possible where values lie above all edges.
    edges = binned.edges
    nodes["threshold"] = [edges[f][b] if f >= 0 else np.nan for f, b in zip(nodes["feature"], nodes["bin"])]
    return BoostedTreesModel(nodes, start, len(edges), params)
