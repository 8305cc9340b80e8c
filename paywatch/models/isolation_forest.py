"""Isolation forest: trees grown in parallel on small subsamples, scoring in Arrow batches (Liu et al., 2008).

The fitted forest is a table of at most trees * (2 * 256 - 1) nodes whatever the size of the training
data; that bound is what makes it fit for broadcasting to the scoring tasks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paywatch.operators.features import schema_guard
from paywatch.operators.history import feature_matrix
from paywatch.session import Scratch
from paywatch.settings import FEATURE_COLUMNS

SUBSAMPLE = 256
DEPTH = 8  # log2 of the subsample
COPIES_AT_ONCE = 1_000_000
EULER_GAMMA = 0.5772156649015329

TREE_SCHEMA = "tree_id int, node_id int, feature int, threshold double, path double, drawn int"
SCORE_SCHEMA = T.StructType(
    [T.StructField("anomaly_score", T.DoubleType()), T.StructField("is_anomaly", T.IntegerType())]
)

# Workers receive the functions of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def average_path(n):
    """Mean depth of an unsuccessful search among n points; the scale of path lengths."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    harmonic = np.log(np.maximum(safe - 1.0, 1.0)) + EULER_GAMMA
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * harmonic - 2.0 * (safe - 1.0) / safe))


def grow_tree(tree_id: int, points: np.ndarray, seed: int) -> pd.DataFrame:
    """One tree over at most 256 points: random feature, random cut, until depth log2(n) or one point is left.

    The children of node i are 2 i + 1 and 2 i + 2; a leaf has feature -1 and its path length.
    """
    rng = np.random.default_rng([seed, tree_id])
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes = []
    waiting = [(0, 0, points)]
    while waiting:
        node_id, depth, inside = waiting.pop()
        varying = np.flatnonzero(np.ptp(inside, axis=0) > 0) if depth < limit else []
        if len(varying) == 0:
            nodes.append((tree_id, node_id, -1, 0.0, depth + float(average_path(len(inside))), len(points)))
            continue
        feature = int(rng.choice(varying))
        column = inside[:, feature]
        cut = float(rng.uniform(column.min(), column.max()))
        if cut >= column.max():  # rounding; both sides must keep a point
            cut = float(column.min())
        nodes.append((tree_id, node_id, feature, cut, 0.0, len(points)))
        waiting.append((2 * node_id + 2, depth + 1, inside[column > cut]))
        waiting.append((2 * node_id + 1, depth + 1, inside[column <= cut]))
    return pd.DataFrame(nodes, columns=["tree_id", "node_id", "feature", "threshold", "path", "drawn"])


def forest_arrays(nodes: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, cut and path tables, one row per tree, all leaves moved down to the last level.

    Below a leaf every cut is infinite, so a row that reaches it keeps turning left.
    """
    tree = nodes["tree_id"].rank(method="dense").to_numpy().astype(int) - 1
    trees, inner = tree.max() + 1, 2**DEPTH - 1
    feature, cut = np.zeros((trees, inner), dtype=np.int32), np.full((trees, inner), np.inf)
    path = np.zeros((trees, inner + 1))
    at = nodes["node_id"].to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    feature[tree[~leaf], at[~leaf]] = nodes["feature"].to_numpy()[~leaf]
    cut[tree[~leaf], at[~leaf]] = nodes["threshold"].to_numpy()[~leaf]
    down = DEPTH - np.floor(np.log2(at[leaf] + 1)).astype(int)
    path[tree[leaf], (at[leaf] + 1) * 2**down - 1 - inner] = nodes["path"].to_numpy()[leaf]
    return feature, cut, path


def forest_scores(forest: tuple, points: np.ndarray, scale: float) -> np.ndarray:
    """Score in (0, 1], larger for rows that are easier to isolate."""
    feature, cut, path = forest
    total = np.zeros(len(points))
    values, start = np.ascontiguousarray(points).ravel(), np.arange(len(points)) * points.shape[1]
    for tree in range(len(feature)):
        at = np.zeros(len(points), dtype=np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (values[start + feature[tree][at]] > cut[tree][at])
        total += path[tree][at - (2**DEPTH - 1)]
    return np.power(2.0, -total / len(feature) / scale)


def _subsamples(rows: DataFrame, features, trees: int, size: int, total: int, seed: int) -> DataFrame:
    """`size` rows per tree without repeats: those whose hash for the tree is smallest.

    The hash is of the row's number, so rows that share an id, or are equal, are drawn on their own. A
    bound on it leaves a few more rows than needed; a row is repeated only for trees that may draw it.
    """
    bound = min(1.0, (size + 8 * size**0.5 + 16) / total)
    every = F.sequence(F.lit(0), F.lit(trees - 1))
    rank = F.shiftrightunsigned(F.xxhash64("_row", "tree_id", F.lit(seed)), 11) / F.lit(float(2**53))
    # one row per tree and a filter are compiled into one loop; functions over an array would be interpreted
    tried = rows.select("_row", *features, F.explode(every).alias("tree_id"))
    return tried.where(rank <= bound).select("tree_id", rank.alias("_rank"), *features)


def train_isolation_forest(
    sample: DataFrame,
    id_column: str,
    features=FEATURE_COLUMNS,
    trees: int = 200,
    contamination: float = 0.02,
    seed: int = 42,
    accuracy: int = 100_000,
) -> tuple[DataFrame, dict]:
    """Grow the forest on any number of rows; the node table and the offset that flags `contamination` of them.

    Each tree draws its rows from the whole table. The offset is a distributed quantile whose rank is off by
    at most 1 / `accuracy` of the rows. Rows are numbered in the order of their features and id, so the
    draw does not depend on how the table is partitioned.
    """
    features = list(features)
    scratch = Scratch(sample.sparkSession, "forest")
    matrix = feature_matrix(sample, tuple(features)).select(F.col(id_column).alias("_id"), *features)
    # the number of a row is its place: a hash of all it has, and a count within rows that are equal
    keyed = matrix.groupBy("_id", *features).agg(F.count(F.lit(1)).alias("_copies"))
    data, seen = scratch.write_with(keyed, "rows", total=F.sum("_copies"), most=F.max("_copies"))
    total = seen["total"] or 0
    if total == 0:
        raise ValueError("There is nothing to train on: the table is empty.")
    runs = data.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), "_copies", F.lit(COPIES_AT_ONCE).cast("long"))))
    if seen["most"] > COPIES_AT_ONCE:  # copies of one row for many tasks
        runs = runs.repartition(F.col("_from"), F.xxhash64("_id", *features))
    upto = F.least("_copies", F.col("_from") + COPIES_AT_ONCE - 1)
    numbered = runs.withColumn("_copy", F.explode(F.sequence("_from", upto))).withColumn(
        "_row", F.xxhash64("_id", *features, "_copy")
    )
    size = min(SUBSAMPLE, total)

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # at most a few hundred rows per tree, whatever the size of the table
        chosen = group.sort_values(["_rank", *features]).head(size)
        return grow_tree(int(key[0]), chosen[features].to_numpy(dtype=float), seed)

    picked = _subsamples(numbered, features, trees, size, total, seed)
    # the driver holds the forest only: trees * (2 * 256 - 1) nodes at most
    nodes = picked.groupBy("tree_id").applyInPandas(grow, TREE_SCHEMA).toPandas()
    table = sample.sparkSession.createDataFrame(nodes, TREE_SCHEMA)
    details = {
        "model_type": "isolation_forest",
        "feature_columns": features,
        "contamination": contamination,
        "subsample": float(nodes.groupby("tree_id")["drawn"].first().mean()),
        "offset": 0.0,
    }
    quantile = F.percentile_approx("anomaly_score", F.lit(1.0 - contamination), F.lit(accuracy))
    details["offset"] = float(score_anomaly(numbered, table, details).agg(quantile).first()[0])
    return table, details


def score_anomaly(df: DataFrame, nodes: DataFrame, details: dict) -> DataFrame:
    """Add anomaly_score (larger is odder, 0 at the flagging limit) and is_anomaly; works on streams too."""
    features = list(details["feature_columns"])
    schema_guard(df.columns, features, "anomaly scoring", identity=False)
    spark: SparkSession = df.sparkSession
    forest = spark.sparkContext.broadcast(forest_arrays(nodes.toPandas()))
    offset = float(details["offset"])
    scale = max(float(average_path(details["subsample"])), 1e-12)

    @F.pandas_udf(SCORE_SCHEMA)
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odd = forest_scores(forest.value, batch.to_numpy(dtype=float), scale) - offset
            yield pd.DataFrame({"anomaly_score": odd, "is_anomaly": (odd > 0).astype("int32")})

    numbers = {c: F.col(c).try_cast("double") for c in features}
    inputs = F.struct(*[F.when(n.isNull() | F.isnan(n), 0.0).otherwise(n).alias(c) for c, n in numbers.items()])
    return (
        df.withColumn("_scored", score(inputs))
        .withColumns({"anomaly_score": F.col("_scored.anomaly_score"), "is_anomaly": F.col("_scored.is_anomaly")})
        .drop("_scored")
    )
