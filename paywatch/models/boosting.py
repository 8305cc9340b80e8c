"""Boosted trees of `pyspark.ml`, fitted in one job instead of one job per level of every tree.

`GBTClassifier` runs a job per level, over rows that are objects. Here every task of one barrier stage keeps the bins of
its rows in arrays, and the tasks add up their histograms level by level. The trees are those of `pyspark.ml` (gradients
of the logistic loss, variance, weighted rows, 32 bins, features drawn per node) and come back as its own model.
"""

from __future__ import annotations

import base64
import json
import sys
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from paywatch.session import delete_path, scratch_path

#: Bins of a feature, as in `pyspark.ml`.
BINS = 32

#: Points that stand for the values of a feature while its bins are sought; with fewer different values all are kept.
POINTS = 1024

#: Cells of a joint histogram of several features, each of which is a sum over it.
CELLS = 2048

#: Rows worked on at a time, so that what is read and written stays in the caches of a core.
BLOCK = 1 << 16

#: Rows sorted at a time while bins are sought.
STRETCH = 1 << 18

#: A gain below this share of a node's squared mean is rounding.
ROUNDING = 1e-12

#: Levels below the root at most, as the node of a row is kept in a byte.
DEEPEST = 6

POINT_SCHEMA = "feature int, value double, weight double, smallest double"
NODE_SCHEMA = (
    "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
    "leftChild int, rightChild int, featureIndex int, threshold array<double>"
)

# Workers receive the functions of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def condensed(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values and their weights; of more than `POINTS`, those that end equal shares of the weight."""
    found, place = np.unique(values, return_inverse=True)
    total = np.bincount(place, weights=weights, minlength=len(found))
    if len(found) <= POINTS:
        return found, total
    reached = np.cumsum(total)
    ends = np.searchsorted(reached, reached[-1] * np.arange(1, POINTS + 1) / POINTS * (1 - 1e-12))
    ends = np.unique(np.append(ends, len(found) - 1))
    return found[ends], np.diff(reached[ends], prepend=0.0)


def in_stretches(batches: Iterator[pa.RecordBatch], weight: str, features: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Weights and feature columns of some `STRETCH` rows at a time, as sorting few rows often costs more."""
    waiting: list[pa.RecordBatch] = []

    def joined() -> tuple[np.ndarray, list[np.ndarray]]:
        table = pa.Table.from_batches(waiting)
        return table[weight].to_numpy(), [table[name].to_numpy() for name in features]

    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= STRETCH:
            yield joined()
            waiting.clear()
    if sum(b.num_rows for b in waiting):
        yield joined()


def thresholds_of(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Upper bounds of all bins but the last: between all values, or where the weight comes closest to equal shares."""
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) < bins:
        return middles
    reached, stride, chosen = np.cumsum(weights), weights.sum() / bins, []
    target = stride
    for index in range(1, len(values)):
        if abs(reached[index - 1] - target) < abs(reached[index] - target):
            chosen.append(middles[index - 1])
            target += stride
    return np.array(chosen)


def packed(sizes: list[int], cells: int = CELLS) -> list[list[int]]:
    """Features in groups that have at most `cells` combinations of bins; a feature of one bin is in none."""
    groups: list[tuple[int, list[int]]] = []
    for feature in sorted((f for f, size in enumerate(sizes) if size > 1), key=lambda f: -sizes[f]):
        for at, (used, members) in enumerate(groups):
            if used * sizes[feature] <= cells:
                groups[at] = (used * sizes[feature], [*members, feature])
                break
        else:
            groups.append((sizes[feature], [feature]))
    return [members for _, members in groups]


class Cut:
    """How rows are cut into bins, and how bins are laid out in groups and histograms."""

    def __init__(self, thresholds: list[np.ndarray]) -> None:
        self.thresholds = thresholds
        self.sizes = [len(t) + 1 for t in thresholds]
        self.groups = packed(self.sizes)
        self.group_of = np.zeros(len(thresholds), dtype=np.int64)
        self.cells = []
        for group, members in enumerate(self.groups):
            self.group_of[members] = group
            self.cells.append(int(np.prod([self.sizes[f] for f in members])))
        self.widest = max(self.cells, default=1)
        #: bin of a feature by the cell of its group
        self.bin_of = {}
        for group, members in enumerate(self.groups):
            for axis, feature in enumerate(members):
                shape = [self.sizes[f] for f in members]
                self.bin_of[feature] = np.indices(shape)[axis].ravel()
        #: place of a feature's first bin in a histogram
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def codes(self, matrix: np.ndarray) -> np.ndarray:
        """The cell of each row in each group."""
        out = np.zeros((len(matrix), len(self.groups)), dtype=np.int16)
        for group, members in enumerate(self.groups):
            cell = np.zeros(len(matrix), dtype=np.int64)
            for feature in members:
                cell = cell * self.sizes[feature] + np.searchsorted(self.thresholds[feature], matrix[:, feature], side="left")
            out[:, group] = cell
        return out

    def by_feature(self, joint: list[np.ndarray], slots: int) -> np.ndarray:
        """Histograms of all features side by side, from those of the groups; one row per slot."""
        out = np.zeros((slots, self.starts[-1]))
        for members, sums in zip(self.groups, joint):
            cube = sums.reshape([slots, *[self.sizes[f] for f in members]])
            for axis, feature in enumerate(members):
                others = tuple(a for a in range(1, len(members) + 1) if a != axis + 1)
                out[:, self.starts[feature] : self.starts[feature + 1]] = cube.sum(axis=others)
        return out


class Meeting:
    """How the tasks of a stage add up what they know.

    `allGather` looks once a second for what the others sent, and a fit meets some 2,000 times. So the tasks put their
    numbers into the shared folder, where each reads those of all; if not all tasks see it, they use `allGather`.
    """

    def __init__(self, folder: str) -> None:
        context = BarrierTaskContext.get()
        self.task, self.tasks, self.number = context.partitionId(), len(context.getTaskInfos()), 0
        attempt = min(context.allGather(uuid.uuid4().hex))  # one name for all tasks, another one if the stage is repeated
        self.folder = ""
        try:
            self.files, self.folder = FileSystem.from_uri(f"{folder}/{attempt}")
            self.files.create_dir(self.folder, recursive=True)
            self._put(self._path(self.task), b"")
        except (OSError, ValueError, pa.ArrowException):
            self.folder = ""
        context.barrier()
        seen = self.folder and all(self._there(self._path(task)) for task in range(self.tasks))
        self.by_files = "no" not in context.allGather("yes" if seen else "no")

    def _path(self, task: int) -> str:
        return f"{self.folder}/{self.number}-{task}"

    def _there(self, path: str) -> bool:
        return self.files.get_file_info(path).type == FileType.File

    def _put(self, path: str, content: bytes) -> None:
        """A file is there as a whole or not at all."""
        with self.files.open_output_stream(f"{path}.part") as stream:
            stream.write(content)
        self.files.move(f"{path}.part", path)

    def _get(self, path: str) -> bytes:
        pause = 0.0002
        while not self._there(path):  # a task that fails ends the whole stage
            time.sleep(pause)
            pause = min(2 * pause, 0.01)
        with self.files.open_input_stream(path) as stream:
            return stream.read()

    def total(self, own: np.ndarray) -> np.ndarray:
        """The sum of what all tasks bring, in the order of tasks, so that all of them hold the same numbers."""
        content = np.ascontiguousarray(own, dtype=np.float64).tobytes()
        if not self.by_files:
            sent = (base64.b64decode(text) for text in BarrierTaskContext.get().allGather(base64.b64encode(content).decode()))
        else:
            before, self.number = self._path(self.task), self.number + 1
            self._put(self._path(self.task), content)
            sent = (self._get(self._path(task)) if task != self.task else content for task in range(self.tasks))
        total = np.zeros(own.size)
        for brought in sent:
            total += np.frombuffer(brought)
        if self.by_files:  # who brought something to this meeting has read all of the last one
            self.files.delete_file(before)
        return total.reshape(own.shape)


#: By node, the group whose cell says where a row goes, and by node and cell the node it goes to.
Moves = tuple[np.ndarray, np.ndarray]


class Rows:
    """The rows of a task: bins, labels, weights and what the trees so far say."""

    def __init__(self, cut: Cut, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        self.cut = cut
        self.columns = np.ascontiguousarray(codes.T)
        self.sign = labels * np.int8(2) - np.int8(1)
        self.weights = weights
        self.margin = np.zeros(len(labels))
        self.residual = self.sign.astype(np.float64)
        self.node = np.zeros(len(labels), dtype=np.uint8)
        self.numbers = np.arange(min(BLOCK, len(labels)), dtype=np.int64)
        self.drawn_weight, self.drawn_residual = weights, weights * self.residual

    def blocks(self) -> Iterator[slice]:
        for start in range(0, len(self.sign), BLOCK):
            yield slice(start, start + BLOCK)

    def draw(self, rng: np.random.Generator, share: float) -> None:
        """Begin a tree with a share of the rows; the others go along without weight."""
        self.node[:] = 0
        self.drawn_weight = self.weights
        if share < 1.0:
            self.drawn_weight = self.weights * (rng.random(len(self.weights), dtype=np.float32) < share)
        self.drawn_residual = self.drawn_weight * self.residual

    def histograms(self, moves: Moves | None, slot_of: np.ndarray, slots: int) -> np.ndarray:
        """Move rows to their children, if so wanted; sums of residuals and of weights per slot, feature and bin."""
        cut = self.cut
        sums = [[np.zeros(slots * cells) for cells in cut.cells] for _ in range(2)]
        everyone = slots == 1 and slot_of[0] == 0
        for block in self.blocks():
            self._move(block, moves)
            if everyone:
                residual, weight = self.drawn_residual[block], self.drawn_weight[block]
            else:
                slot = slot_of.take(self.node[block])
                inside = np.flatnonzero(slot >= 0)
                slot = slot.take(inside)
                residual, weight = self.drawn_residual[block].take(inside), self.drawn_weight[block].take(inside)
            for group, cells in enumerate(cut.cells):
                cell = self.columns[group, block]
                if not everyone:
                    cell = slot * cells + cell.take(inside)
                else:
                    cell = cell.astype(np.int64)
                sums[0][group] += np.bincount(cell, weights=residual, minlength=slots * cells)
                sums[1][group] += np.bincount(cell, weights=weight, minlength=slots * cells)
        return np.stack([cut.by_feature(joint, slots) for joint in sums])

    def _move(self, block: slice, moves: Moves | None) -> None:
        """Rows of a block go to the children of their nodes."""
        if moves is None:
            return
        group_of, child_of = moves
        node, rows = self.node[block], len(self.sign)
        at = (group_of * rows).take(node)
        at += self.numbers[: len(node)]
        at += block.start
        cell = self.columns.reshape(-1).take(at)
        self.node[block] = child_of.take(node * np.int64(self.cut.widest) + cell)

    def finish(self, moves: Moves | None, values: np.ndarray, rate: float) -> np.ndarray:
        """End a tree: rows, residuals and squared residuals per node; then the residuals of the next one."""
        seen = np.zeros((2, len(values)))
        for block in self.blocks():
            self._move(block, moves)
            node, sign = self.node[block], self.sign[block]
            seen[0] += np.bincount(node, weights=self.drawn_weight[block] > 0, minlength=len(values))
            seen[1] += np.bincount(node, weights=self.drawn_residual[block] * self.residual[block], minlength=len(values))
            self.margin[block] += rate * values.take(node)
            with np.errstate(over="ignore"):
                self.residual[block] = 4.0 * sign / (1.0 + np.exp((2.0 * sign) * self.margin[block]))
        return seen


def best_cuts(found: np.ndarray, allowed: np.ndarray, cut: Cut, smallest: float) -> tuple[np.ndarray, ...]:
    """Of each node: gain, feature and last bin to the left of the best cut, and the sums on both its sides.

    `found` has sums of residuals and weights by node and bin, `allowed` which features each node may use. A side
    without rows has a weight that is zero but for rounding, which the weight of the lightest row tells apart.
    """
    nodes = found.shape[1]
    gain, feature, last = np.full(nodes, -np.inf), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    left = np.zeros((2, nodes))
    total = found[:, :, : cut.sizes[0]].sum(axis=2)
    own = total[0] ** 2 / np.maximum(total[1], smallest / 2)
    for f, size in enumerate(cut.sizes):
        if size == 1:
            continue
        running = np.cumsum(found[:, :, cut.starts[f] : cut.starts[f + 1] - 1], axis=2)
        rest = total[:, :, None] - running
        valid = (running[1] > smallest / 2) & (rest[1] > smallest / 2) & allowed[:, f, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = np.where(valid, running[0] ** 2 / running[1] + rest[0] ** 2 / rest[1] - own[:, None], -np.inf)
        at = gains.argmax(axis=1)
        better = gains[np.arange(nodes), at] > gain
        gain[better], feature[better], last[better] = gains[better, at[better]], f, at[better]
        left[:, better] = running[:, better, at[better]]
    gain[gain <= ROUNDING * own] = -np.inf
    return gain / np.maximum(total[1], smallest / 2), feature, last, left, total


def grow(rows: Rows, meeting: Meeting, tree: int, depth: int, per_node: int, seed: int, smallest: float) -> dict[int, dict]:
    """The nodes of one tree by number (children of i are 2 i + 1 and 2 i + 2); all tasks come to the same ones."""
    cut, features, size = rows.cut, len(rows.cut.sizes), 2 ** (depth + 1) - 1
    nodes: dict[int, dict] = {}
    known: dict[int, np.ndarray] = {}
    built, derived, moves = [0], [], None
    for _ in range(depth):
        slot_of = np.full(256, -1, dtype=np.int64)
        slot_of[built] = np.arange(len(built))
        fresh = meeting.total(rows.histograms(moves, slot_of, len(built)))
        above, known = known, {node: fresh[:, at] for at, node in enumerate(built)}
        for node, sibling in derived:
            known[node] = above[(node - 1) // 2] - known[sibling]
        level = sorted(known)
        allowed = np.zeros((len(level), features), dtype=bool)
        for at, node in enumerate(level):
            allowed[at, np.random.default_rng([seed, tree, node]).permutation(features)[:per_node]] = True
        gain, feature, last, left, total = best_cuts(np.stack([known[n] for n in level], axis=1), allowed, cut, smallest)
        built, derived, moves, group_of = [], [], None, np.zeros(256, dtype=np.int64)
        child_of = np.repeat(np.arange(256, dtype=np.uint8)[:, None], cut.widest, axis=1)
        for at, node in enumerate(level):
            nodes.setdefault(node, {"sums": total[:, at]})
            if not np.isfinite(gain[at]):
                continue
            f, low, high = int(feature[at]), 2 * node + 1, 2 * node + 2
            nodes[node].update(gain=float(gain[at]), feature=f, threshold=float(cut.thresholds[f][last[at]]))
            nodes[low], nodes[high] = {"sums": left[:, at]}, {"sums": total[:, at] - left[:, at]}
            group_of[node] = cut.group_of[f]
            child_of[node, : len(cut.bin_of[f])] = np.where(cut.bin_of[f] <= last[at], low, high)
            lighter, heavier = (low, high) if left[1, at] <= total[1, at] / 2 else (high, low)
            built.append(lighter)
            derived.append((heavier, lighter))
        if not built:
            break
        moves = group_of, child_of.reshape(-1)
    values = np.zeros(size)
    for number, node in nodes.items():
        values[number] = node["sums"][0] / max(node["sums"][1], smallest / 2)
    seen = meeting.total(rows.finish(moves, values, 1.0 if tree == 0 else rows.rate))
    for number in sorted(nodes, reverse=True):
        if "feature" in nodes[number]:
            seen[:, number] = seen[:, 2 * number + 1] + seen[:, 2 * number + 2]
        nodes[number].update(prediction=values[number], rows=int(seen[0, number]), squares=float(seen[1, number]))
    return nodes


def node_rows(tree: int, nodes: dict[int, dict]) -> list[dict]:
    """The nodes of a tree as `pyspark.ml` stores them, numbered in the order of their levels."""
    place = {number: at for at, number in enumerate(sorted(nodes))}
    out = []
    for number, at in place.items():
        node = nodes[number]
        inner, (residuals, weight) = "feature" in node, node["sums"]
        out.append(
            {
                "treeID": tree,
                "id": at,
                "prediction": float(node["prediction"]),
                "impurity": float(node["squares"] / weight - node["prediction"] ** 2) if weight else 0.0,
                "impurityStats": [float(weight), float(residuals), node["squares"]],
                "rawCount": node["rows"],
                "gain": node["gain"] if inner else -1.0,
                "leftChild": place[2 * number + 1] if inner else -1,
                "rightChild": place[2 * number + 2] if inner else -1,
                "featureIndex": node["feature"] if inner else -1,
                "threshold": [node["threshold"]] if inner else [],
            }
        )
    return out


class BoostedTrees(Estimator):
    """Boosted trees over plain columns, with the results of `GBTClassifier`."""

    def __init__(self, features, trees, depth, rate, subsample, feature_share, seed, label="_label", weight="_weight") -> None:
        super().__init__()
        if not 1 <= depth <= DEEPEST:
            raise ValueError(f"The depth of a tree is 1 to {DEEPEST}.")
        self.features, self.label, self.weight = list(features), label, weight
        self.trees, self.depth, self.rate, self.seed = trees, depth, rate, seed
        self.subsample, self.feature_share = subsample, feature_share

    def _cut(self, rows: DataFrame) -> tuple[Cut, float]:
        """Bins from all rows, and the weight of the lightest row."""
        features, weight = self.features, self.weight

        def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, smallest = {f: (np.zeros(0), np.zeros(0)) for f in range(len(features))}, np.inf
            for weights, columns in in_stretches(batches, weight, features):
                smallest = min(smallest, weights.min())
                for f, values in enumerate(columns):
                    met = condensed(values, weights)
                    found[f] = condensed(np.append(found[f][0], met[0]), np.append(found[f][1], met[1]))
            for f, (values, total) in found.items():
                one = [np.full(len(values), f, dtype=np.int32), values, total, np.full(len(values), smallest)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in one], names=["feature", "value", "weight", "smallest"])

        # a task sends `POINTS` points a feature at most, and there is one task per core
        met = rows.mapInArrow(points, POINT_SCHEMA).toPandas()
        thresholds = []
        for f in range(len(features)):
            own = met[met["feature"] == f]
            values, place = np.unique(own["value"].to_numpy(), return_inverse=True)
            thresholds.append(thresholds_of(values, np.bincount(place, weights=own["weight"].to_numpy(), minlength=len(values))))
        return Cut(thresholds), float(met["smallest"].min())

    def _nodes(self, rows: DataFrame, cut: Cut, smallest: float, folder: str) -> DataFrame:
        """The nodes of all trees, from the first task; the stage runs as a whole or not at all."""
        features, label, weight, trees, depth = self.features, self.label, self.weight, self.trees, self.depth
        rate, share, seed = self.rate, self.subsample, self.seed
        per_node = int(np.ceil(self.feature_share * len(features)))

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = BarrierTaskContext.get().partitionId()
            codes, labels, weights = [np.zeros((0, len(cut.groups)), dtype=np.int16)], [np.zeros(0, dtype=np.int8)], [np.zeros(0)]
            for batch in batches:
                columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in features]
                codes.append(cut.codes(np.column_stack(columns)))
                labels.append(batch.column(label).to_numpy(zero_copy_only=False).astype(np.int8))
                weights.append(batch.column(weight).to_numpy(zero_copy_only=False).astype(np.float64))
            own = Rows(cut, np.concatenate(codes), np.concatenate(labels), np.concatenate(weights))
            own.rate = rate
            codes, labels, weights = [], [], []
            meeting = Meeting(folder)
            for tree in range(trees):
                own.draw(np.random.default_rng([seed, tree, task, 1]), share)
                nodes = grow(own, meeting, tree, depth, per_node, seed, smallest)
                if task == 0:
                    stored = pa.Table.from_pylist(node_rows(tree, nodes), schema=arrow_schema())
                    yield from stored.to_batches()

        return rows.mapInArrow(fit, NODE_SCHEMA, barrier=True)

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        rows = dataset.select(self.label, F.col(self.weight).cast("double").alias(self.weight), *self.features)
        cut, smallest = self._cut(rows)
        path = scratch_path(dataset.sparkSession, "boosted")
        try:
            folder = qualified(dataset.sparkSession, f"{path}/meeting")
            return as_model(self, self._nodes(rows, cut, smallest, folder), path)
        finally:
            delete_path(dataset.sparkSession, path)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, in the way that others than Hadoop spell it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split(" ") for column in NODE_SCHEMA.split(", "))])


def as_model(fitted: BoostedTrees, nodes: DataFrame, path: str) -> GBTClassificationModel:
    """A `pyspark.ml` model with these nodes, by way of the files in which it stores one."""
    spark = nodes.sparkSession
    options = {"maxDepth": fitted.depth, "maxBins": BINS, "subsamplingRate": fitted.subsample, "seed": fitted.seed}
    share = str(fitted.feature_share)
    whole = GBTClassifier(
        labelCol=fitted.label, weightCol=fitted.weight, maxIter=fitted.trees, stepSize=fitted.rate, featureSubsetStrategy=share, **options
    )
    tree = DecisionTreeRegressor(labelCol=fitted.label, weightCol=fitted.weight, maxDepth=fitted.depth, maxBins=BINS, seed=fitted.seed)
    described = [_described(spark, stage, f"{path}/{name}") for name, stage in (("whole", whole), ("tree", tree))]
    described[0].update(numFeatures=len(fitted.features), numTrees=fitted.trees)
    described[0]["class"] = "org.apache.spark.ml.classification.GBTClassificationModel"
    described[1]["class"] = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    weights = [(n, json.dumps(described[1]), 1.0 if n == 0 else fitted.rate) for n in range(fitted.trees)]
    split = F.struct("featureIndex", F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    plain = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild"]
    nodes.select("treeID", F.struct(*plain, split.alias("split")).alias("nodeData")).write.parquet(f"{path}/model/data")
    spark.createDataFrame(weights, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    spark.createDataFrame([(json.dumps(described[0]),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    return GBTClassificationModel.load(f"{path}/model")


def _described(spark: SparkSession, stage, path: str) -> dict:
    """What `pyspark.ml` writes about a stage."""
    stage.write().overwrite().save(path)
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])
