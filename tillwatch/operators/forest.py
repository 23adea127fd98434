"""Isolation forest (Liu, Ting and Zhou 2008) over a distributed table.

A deterministic hash picks each tree's sample, so the same rows are drawn at any
partition count and the sample does not grow with the table.  Trees are grown
one group per tree; the finished forest (at most 511 nodes a tree) is broadcast
and rows are scored in Arrow batches without any shuffle.

Every draw is the beginning of an md5 of a short text (``unit``) and path lengths are
whole multiples of ``1 / UNIT``, so any engine with md5 grows the same trees and adds up
the same lengths.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.draws import unit
from ..schema import q, require_columns, require_list
from ..session import materialize
from .quantiles import as_number, exact_quantiles

# Executors get this module's functions with the task, so they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NODE_SCHEMA = "tree int, node int, feature int, cut double, length long"
_OVERSAMPLE = 1.5  # draws beyond the sample size, cut back to it exactly per tree
_EULER = 0.5772156649015329
UNIT = 1 << 20


def average_path(n):
    """Expected depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    deep = 2.0 * (np.log(safe - 1.0) + _EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, deep))


def tree_samples(df: DataFrame, features: list[str], id_columns: list[str], rows: int,
                 trees: int, sample: int, seed: int) -> DataFrame:
    """``tree, x0, x1, ...``: at most ``sample`` rows per tree, chosen by hash.

    A row's number of trees follows from its hash and the wanted share, and it goes
    to that many different trees: from a hashed first one on with a hashed stride.
    The scheme is the same at every size, and about ``1.5 * trees * sample`` rows
    leave the scan.
    """
    ids = [F.col(q(c)) for c in id_columns]
    points = df.select(*ids, *[as_number(df, c).alias(f"x{i}") for i, c in enumerate(features)])
    share = min(1.0, _OVERSAMPLE * sample / rows)  # of all rows, in each tree
    strides = F.array(*[F.lit(i) for i in range(1, trees + 1) if math.gcd(i, trees) == 1])
    number = (F.floor(F.lit(trees * share)) + (unit(F.lit(seed), *ids) < F.lit(trees * share % 1)).cast("int")).cast("int")
    first = F.floor(unit(F.lit(seed + 1), *ids) * trees).cast("int")
    stride = F.element_at(strides, (F.floor(unit(F.lit(seed + 3), *ids) * F.size(strides)) + 1).cast("int"))
    drawn = (points.withColumn("__number", number).filter(F.col("__number") > 0)
             .withColumn("__turn", F.explode(F.sequence(F.lit(0), F.col("__number") - 1)))
             .withColumn("tree", F.pmod(first + F.col("__turn") * stride, F.lit(trees)).cast("int")))
    lot = F.md5(F.concat_ws(":", F.lit(str(seed + 2)), F.col("tree").cast("string"), *[i.cast("string") for i in ids]).cast("binary"))
    place = Window.partitionBy("tree").orderBy(lot, *ids)
    return (drawn.withColumn("__place", F.row_number().over(place)).filter(F.col("__place") <= sample)
            .select("tree", *[f"x{i}" for i in range(len(features))]))


def grow_tree(points: np.ndarray, seed: int, tree: int, max_depth: int) -> list[tuple]:
    """Random axis splits down to single points; rows ``node, feature, cut, length``.

    The root is node 1, the children of node n are 2n and 2n + 1.  The node's md5 gives
    its feature, among those that vary, and the cut's place in its range.
    """
    extra = np.rint(average_path(np.arange(len(points) + 1)) * UNIT).astype(np.int64).tolist()
    nodes, todo = [], [(1, points, 0)]
    while todo:
        number, part, depth = todo.pop()
        low, high = part.min(axis=0).tolist(), part.max(axis=0).tolist()
        able = [f for f, (a, b) in enumerate(zip(low, high)) if a < b]
        if depth >= max_depth or not able:
            nodes.append((number, -1, 0.0, depth * UNIT + extra[len(part)]))
            continue
        text = hashlib.md5(f"{seed}:{tree}:{number}".encode()).hexdigest()
        pick, place = int(text[:8], 16) / 2 ** 32, int(text[8:16], 16) / 2 ** 32
        feature = able[int(pick * len(able))]
        cut = low[feature] + (high[feature] - low[feature]) * place
        if not low[feature] <= cut < high[feature]:  # rounding, or an infinite range
            cut = low[feature]
        goes_left = part[:, feature] <= cut
        nodes.append((number, feature, cut, 0))
        todo += [(2 * number, part[goes_left], depth + 1), (2 * number + 1, part[~goes_left], depth + 1)]
    return nodes


def depth_of(sample: int) -> int:
    return max(1, math.ceil(math.log2(max(sample, 2))))


def fit_forest(samples: DataFrame, features: int, sample: int, seed: int) -> pd.DataFrame:
    """All trees' nodes; bounded by trees times twice the sample size."""
    names = [f"x{i}" for i in range(features)]
    max_depth = depth_of(sample)

    def grow(key, frame):
        tree = int(key[0])
        nodes = grow_tree(frame[names].to_numpy(dtype=float), seed, tree, max_depth)
        return pd.DataFrame([(tree, *n) for n in nodes], columns=["tree", "node", "feature", "cut", "length"])

    # An explicit count keeps AQE from coalescing the few sampled rows into one task.
    tasks = max(1, samples.sparkSession.sparkContext.defaultParallelism)
    return samples.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()


def pack_forest(nodes: pd.DataFrame, max_depth: int) -> tuple:
    """All trees as complete binary trees side by side: ``feature, cut, length, depth``.

    One row per tree, node n at place n - 1; ``length`` belongs to the places of the last
    level.  A leaf above it is repeated down its left side with an infinite cut, so every
    point takes the same number of steps without branching.
    """
    trees = int(nodes["tree"].nunique())
    inner, width = (1 << max_depth) - 1, 1 << max_depth
    feature = np.zeros((trees, inner), dtype=np.int32)
    cut = np.full((trees, inner), np.inf)
    length = np.zeros((trees, width), dtype=np.int64)
    for t, (_, tree) in enumerate(nodes.sort_values(["tree", "node"]).groupby("tree")):
        for node, f, c, whole in tree[["node", "feature", "cut", "length"]].itertuples(index=False):
            place = int(node) - 1
            if f >= 0:
                feature[t, place], cut[t, place] = f, c
                continue
            while place < inner:
                place = 2 * place + 1
            length[t, place - inner] = whole
    return feature, cut, length, max_depth


def path_lengths(forest: tuple, points: np.ndarray, chunk: int = 2048) -> np.ndarray:
    """Path length of each point in units, summed over all trees: all trees step down together."""
    feature, cut, length, depth = forest
    trees, inner = feature.shape
    feature, cut, length = feature.ravel(), cut.ravel(), length.ravel()
    base = np.arange(trees, dtype=np.int32) * np.int32(inner)
    out = np.empty(len(points), dtype=np.int64)
    for start in range(0, len(points), chunk):
        part = points[start:start + chunk]
        row = (np.arange(len(part), dtype=np.int32) * np.int32(part.shape[1]))[:, None]
        flat = np.ascontiguousarray(part).ravel()
        at = np.zeros((len(part), trees), dtype=np.int32)
        for _ in range(depth):
            place = at + base
            right = flat[row + feature[place]] > cut[place]
            at = 2 * at + 1 + right
        leaf = at - inner + np.arange(trees, dtype=np.int32) * np.int32(inner + 1)
        out[start:start + chunk] = length[leaf].sum(axis=1)
    return out


def isolation_forest(
    df: DataFrame,
    feature_columns: list[str],
    id_columns: list[str],
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Add ``isolation_forest_anomaly`` and ``anomaly_score`` (low = anomalous).

    The score is the negated anomaly function less its ``contamination``
    quantile over all complete rows; below zero is flagged.  Incomplete rows get
    false and 0.0; a table without complete rows is returned unchanged.
    ``id_columns`` must identify a row.
    """
    features = require_list(feature_columns, "feature_columns")
    ids = require_list(id_columns, "id_columns")
    require_columns(df, [*features, *ids])
    complete = F.lit(True)
    for c in features:
        complete = complete & as_number(df, c).isNotNull()
    whole = df.filter(complete)
    rows = whole.count()
    if rows == 0:
        return df
    sample = min(sample, rows)
    nodes = fit_forest(tree_samples(whole, features, ids, rows, trees, sample, seed), len(features), sample, seed)
    forest = df.sparkSession.sparkContext.broadcast(
        pack_forest(nodes, depth_of(sample)))
    grown = int(nodes["tree"].nunique())
    scale = max(float(average_path(sample)), 1e-12)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            points = batch.to_numpy(dtype=float)
            known = ~np.isnan(points).any(axis=1)
            out = np.full(len(points), np.nan)
            if known.any():
                out[known] = -np.exp2(-(path_lengths(forest.value, points[known]) / (UNIT * grown)) / scale)
            yield pd.Series(out)  # NaN becomes null on the way back

    point = F.struct(*[as_number(df, c).alias(f"x{i}") for i, c in enumerate(features)])
    # Written once: the quantile passes below read only the score column of the result.
    scored = materialize(df.withColumn("__score", score(point)), "scored")
    offset = exact_quantiles(scored, ["__score"], [contamination])["__score"][0]
    margin = F.col("__score") - F.lit(offset)
    return scored.withColumns({
        "isolation_forest_anomaly": F.coalesce(margin < 0, F.lit(False)),
        "anomaly_score": F.coalesce(margin, F.lit(0.0)),
    }).drop("__score")
