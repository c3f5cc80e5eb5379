"""Isolation forest (Liu, Ting and Zhou, 2008) over sparse or dense features.

A forest is a function of its rows' ids and features alone. The rows of a tree are drawn by the md5 of their ids, before
their features are made; a node's feature and cut are drawn by the md5 of (seed, tree, node), where a node's children are
numbered 2n and 2n + 1. So a forest is the same on any partitioning and in any engine that has md5. Each tree is grown in
its own task from the stored entries of its rows; a feature that a row does not store is 0. The nodes are a table of bounded
size, which scoring tasks hold in memory and walk in Arrow batches of entries.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.operators.lookups import lookup
from loomlog.operators.numbering import with_numbers
from loomlog.operators.quantiles import exact_quantiles
from loomlog.operators.sampling import borders, digest_of
from loomlog.options import ForestOptions

NODE_SCHEMA = "tree int, node int, feature int, cut double, path double"
#: Digits that scores and features are rounded to, so that sums in another order give the same trees and scores.
DIGITS, FEATURE_DIGITS = 12, 9
#: Cells of a scoring batch's matrix.
CELLS = 1 << 22


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + float(np.euler_gamma)) - 2.0 * (n - 1.0) / n


def draw(seed: int, tree: int, node: int, what: str) -> float:
    """A number in [0, 1) that belongs to a node: the first 32 bits of an md5."""
    return int(hashlib.md5(f"{seed}:{tree}:{node}:{what}".encode()).hexdigest()[:8], 16) / 2.0**32


def entries(df: DataFrame, features: str) -> list[Column]:
    """Indices (null for a dense row) and values of the feature column: a vector, an array, or a struct of the two."""
    if dict(df.dtypes)[features].startswith("struct<indices"):
        return [F.col(features)["indices"].alias("indices"), F.col(features)["values"].cast("array<double>").alias("values")]
    if "udt" not in str(df.schema[features].dataType.typeName()) and dict(df.dtypes)[features] != "vector":
        return [F.lit(None).cast("array<int>").alias("indices"), F.col(features).cast("array<double>").alias("values")]
    raw = F.unwrap_udt(F.col(features))
    return [raw["indices"].alias("indices"), raw["values"].alias("values")]


class Entries:
    """Stored entries of rows: row, feature and value, ordered by feature."""

    def __init__(self, indices: pd.Series, values: pd.Series):
        stored = [np.asarray(v, dtype=np.float64) for v in values]
        places = [np.arange(len(v)) if i is None else np.asarray(i) for i, v in zip(indices, stored)]
        self.rows = len(stored)
        row = np.repeat(np.arange(self.rows), [len(v) for v in stored])
        feature = np.concatenate([*places, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        order = np.lexsort((row, feature))
        self.row, self.feature = row[order], feature[order]
        self.value = np.round(np.concatenate([*stored, np.zeros(0)])[order], FEATURE_DIGITS)

    def ranges(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features that differ among the rows of the mask, their least and greatest values; absent entries are 0."""
        mine = inside[self.row]
        feature, value = self.feature[mine], self.value[mine]
        if not len(feature):
            return feature, value, value
        at = np.flatnonzero(np.concatenate([[True], feature[1:] != feature[:-1]]))
        low, high = np.minimum.reduceat(value, at), np.maximum.reduceat(value, at)
        some_absent = np.diff(np.append(at, len(feature))) < inside.sum()
        low, high = np.where(some_absent, np.minimum(low, 0.0), low), np.where(some_absent, np.maximum(high, 0.0), high)
        usable = high > low
        return feature[at][usable], low[usable], high[usable]

    def column(self, feature: int) -> np.ndarray:
        a, b = np.searchsorted(self.feature, [feature, feature + 1])
        out = np.zeros(self.rows)
        out[self.row[a:b]] = self.value[a:b]
        return out


def grow_tree(rows: Entries, seed: int, tree: int, psi: int) -> list[tuple]:
    """Nodes of one tree: tree, node, feature (-1: a leaf), cut and, for leaves, the path length they stand for."""
    limit = max(1, math.ceil(math.log2(max(psi, 2))))
    nodes, todo = [], [(1, 0, np.ones(rows.rows, dtype=bool))]
    while todo:
        node, depth, inside = todo.pop()
        features, low, high = rows.ranges(inside) if depth < limit else ((), (), ())
        if not len(features):
            nodes.append((tree, node, -1, 0.0, depth + average_path(int(inside.sum()))))
            continue
        k = math.floor(draw(seed, tree, node, "feature") * len(features))
        cut = low[k] + draw(seed, tree, node, "cut") * (high[k] - low[k])
        cut = float(cut if cut < high[k] else low[k])
        nodes.append((tree, node, int(features[k]), cut, 0.0))
        left = rows.column(features[k]) <= cut
        todo += [(2 * node, depth + 1, inside & left), (2 * node + 1, depth + 1, inside & ~left)]
    return nodes


def _walker(nodes: pd.DataFrame, trees: int, psi: int):
    """Scores of a batch of rows: all rows at once, tree by tree, one step per level."""
    used = np.unique(nodes["feature"][nodes["feature"] >= 0]).astype(np.int64)
    shape = (trees, int(nodes["node"].max()) + 1)
    feature, cut, path = np.full(shape, -1, dtype=np.int64), np.zeros(shape), np.zeros(shape)
    t, n = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feature[t, n] = np.where(nodes["feature"] >= 0, np.searchsorted(used, nodes["feature"]), -1)
    cut[t, n], path[t, n] = nodes["cut"], nodes["path"]
    norm = average_path(psi) or 1.0

    def walk(x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for k in range(trees):
            at = np.ones(len(x), dtype=np.int64)
            while True:
                f = feature[k][at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > cut[k][at]
                at = np.where(inner, 2 * at + right, at)
            total += path[k][at]
        return np.round(np.power(2.0, -(total / trees) / norm), DIGITS)

    def score(indices: pd.Series, values: pd.Series) -> pd.Series:
        out, step = [], max(1, CELLS // (len(used) + 1))
        for a in range(0, len(values), step):
            some = Entries(indices.iloc[a:a + step], values.iloc[a:a + step])
            x = np.zeros((some.rows, len(used) + 1))
            if len(used):
                at = np.minimum(np.searchsorted(used, some.feature), len(used) - 1)
                known = used[at] == some.feature
                x[some.row[known], at[known]] = some.value[known]
            out.append(walk(x))
        return pd.Series(np.concatenate([*out, np.zeros(0)]))
    return score


@dataclass
class ForestModel:
    """Node table plus what scoring needs: ``decision = offset - anomaly score``, an anomaly when below 0."""

    nodes: pd.DataFrame
    trees: int
    psi: int
    contamination: float
    offset: float | None = None

    def with_scores(self, df: DataFrame, features: str = "features", name: str = "iso_score") -> DataFrame:
        """Add the isolation score in (0, 1), higher for more isolated rows; only stored entries travel to Python."""
        walk = F.pandas_udf(_walker(self.nodes, self.trees, self.psi), "double")
        return df.withColumn(name, walk(*entries(df, features)))

    def calibrated(self, train: DataFrame, features: str = "features", contamination: float | None = None) -> "ForestModel":
        """Place the cut so that the given share of the training rows falls below it."""
        share = self.contamination if contamination is None else contamination
        return self.with_offset(offsets_for(self, train, [share], features)[share], share)

    def with_offset(self, offset: float, contamination: float) -> "ForestModel":
        return ForestModel(self.nodes, self.trees, self.psi, contamination, offset)

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add anomaly_score (the decision value) and is_anomaly."""
        offset = -0.5 if self.offset is None else self.offset
        out = self.with_scores(df, features).withColumn("anomaly_score", -F.col("iso_score") - F.lit(offset))
        return out.withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("int")).drop("iso_score")

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as Parquet, parameters as one JSON row."""
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {"trees": self.trees, "psi": self.psi, "contamination": self.contamination, "offset": self.offset}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").toPandas()  # trees x (2 psi - 1) rows at most
        return cls(nodes.sort_values(["tree", "node"]).reset_index(drop=True), meta["trees"], meta["psi"],
                   meta["contamination"], meta["offset"])


def drawn_rows(df: DataFrame, ids: list[str], opts: ForestOptions, by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(by, ids, tree) of the rows each tree is grown from, and (by, psi); with ``by`` a forest for each of its values.

    The pool holds the ``trees x sample_size`` rows with the smallest digests (all rows when there are fewer). Numbered in
    that order, tree t takes the ``psi`` rows from ``t * psi`` on, wrapping round, so every tree has psi different rows.
    """
    key = by or "_forest"
    digests = df.select(F.lit(0).alias("_forest") if by is None else F.col(by), *ids, digest_of(ids, opts.seed).alias("_d"))
    groups = digests.select(key).distinct().withColumn("quota", F.lit(opts.trees * opts.sample_size).cast("long"))
    found = written(borders(digests.select(key, "_d"), key, groups), "borders")
    pool = lookup(digests, found, [key], "inner").filter(F.col("_d") <= F.col("border")).select(key, *ids, "_d").distinct()
    numbered = with_numbers(pool, [key, "_d", *ids], "_n")
    sizes = written(numbered.groupBy(key).agg(F.count(F.lit(1)).alias("_size"), F.min("_n").alias("_first")).withColumn(
        "psi", F.least(F.lit(opts.sample_size), F.col("_size")).cast("int")), "sizes")
    place, psi, size = F.col("_n") - F.col("_first"), F.col("psi"), F.col("_size")
    trees = F.filter(F.sequence(F.lit(0), F.lit(opts.trees - 1)), lambda t: F.pmod(place - t * psi, size) < psi)
    return (lookup(numbered, sizes, [key], "inner").select(key, *ids, F.explode(trees).alias("tree")), sizes.select(key, "psi"))


def grow_forests(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Nodes of every (key, tree) of ``rows`` (key, tree, psi, indices, values), each tree in a task of its own."""
    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        nodes = grow_tree(Entries(part["indices"], part["values"]), seed, tree, int(part["psi"].iloc[0]))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "path"]).assign(**{key: part[key].iloc[0]})
    return rows.groupBy(key, "tree").applyInPandas(grow, f"{NODE_SCHEMA}, {key} {dict(rows.dtypes)[key]}")


def fit_forest(df: DataFrame, ids: list[str], features: str = "features", opts: ForestOptions = ForestOptions(),
               calibrate: bool = True, transform: Callable[[DataFrame], DataFrame] | None = None) -> ForestModel:
    """Grow a forest on rows drawn by their ids; with ``calibrate`` also set the cut from the scores of all rows.

    ``ids`` name a row. ``transform`` adds the features; only the drawn rows pass through it before the trees are grown.
    """
    drawn, sizes = drawn_rows(df, ids, opts)
    psi = [r["psi"] for r in sizes.collect()]  # one row
    if not psi:
        raise ValueError("no rows to train on")
    chosen = drawn.groupBy(*ids).agg(F.collect_list("tree").alias("_trees"))
    rows = lookup(df, chosen, ids, "inner")
    rows = transform(rows) if transform else rows
    grown = grow_forests(rows.select(
        F.lit(0).alias("_forest"), F.explode("_trees").alias("tree"), F.lit(psi[0]).alias("psi"), *entries(rows, features)), "_forest", opts.seed)
    nodes = grown.drop("_forest").toPandas().sort_values(["tree", "node"]).reset_index(drop=True)  # trees x (2 psi - 1) rows at most
    model = ForestModel(nodes, opts.trees, psi[0], opts.contamination)
    return model.calibrated(transform(df) if transform else df, features) if calibrate else model


def offsets_for(model: ForestModel, train: DataFrame, contaminations: list[float], features: str = "features") -> dict[float, float]:
    """The cut for several contaminations from one scoring pass."""
    scored = written(model.with_scores(train, features).select((-F.col("iso_score")).alias("s")), "scores")
    return dict(zip(contaminations, exact_quantiles(scored, "s", list(contaminations))))
