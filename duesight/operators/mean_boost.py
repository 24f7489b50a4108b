"""Gradient boosting with squared loss: the mean.

The method is that of Spark ML's ``GBTRegressor``: the first tree fits the label, every later one twice
the residual and counts with the learning rate; splits maximise what the variance loses, a leaf's
value is the mean in it. Rows are held as in ``quantile_boost``, binned by all rows' quantiles, in
blocks of numpy columns beside the residuals so far. A pass over a level adds up counts and residuals by
(node, feature, bin) with one numpy call a block and feature, where Spark ML walks row objects; the
last level's sums also give the leaves. ``2^depth * features * bins`` numbers reach the driver a pass,
summed in a tree where there are many tasks. Every ``store_every`` trees the blocks are written with
their residuals, until then passes take off the few trees since.

A missing or NaN feature counts as lower than all others, rows without a label take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import ModelParams
from ..schemas import FEATURE_COLS
from ..session import materialize, new_folder, package_for_workers
from .quantile_boost import BINS, BLOCK, LABEL, Trees

PREDICTION = "days_late_pred"
STORE_EVERY = 5
FEW_TASKS = 64  # whose sums the driver adds up by itself
TASK_BLOCKS = 16


@dataclass
class BoostedMean:
    """Adds ``days_late_pred``. ``gains`` are the summed gains of all splits by feature."""

    trees: Trees | None
    gains: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        package_for_workers(df.sparkSession)
        trees = self.trees
        if trees is None:
            return df.withColumn(PREDICTION, F.lit(None).cast("double"))

        @F.pandas_udf("double")
        def predicted(frame: pd.DataFrame) -> pd.Series:
            return pd.Series(trees.predict(frame)[0])

        return df.withColumn(PREDICTION, predicted(F.struct(*[F.col(c).cast("double").alias(c) for c in trees.columns])))

    def cells(self) -> Column:
        """The features of a row as the bytes of their bins."""
        trees = self.trees

        @F.pandas_udf("binary")
        def binned(frame: pd.DataFrame) -> pd.Series:
            return pd.Series([x.tobytes() for x in np.ascontiguousarray(trees.binned(frame).T)], dtype=object)

        return binned(F.struct(*[F.col(c).cast("double").alias(c) for c in trees.columns]))

    def swapped_errors(self, pairs: DataFrame, columns: list[str]) -> DataFrame:
        """``repeat feature error n``: absolute errors over ``pairs(repeat, y, own, other)`` of cells with one feature
        taken from the other row, and with none (a null feature). Only trees that ask for the feature are walked again."""
        trees = self.trees
        asked = [trees.feature[:, 0], trees.cut[:, 0] < 1 << 30]
        features = [None, *columns]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, repeat = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "repeat"))
                kind = np.uint8 if len(batch.column("own")[0].as_py()) == len(trees.columns) else np.uint16
                own, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(len(y), -1).T.copy() for c in ("own", "other"))
                each = np.stack([trees.value[t, 0, trees.leaf(own, t, 0, trees.depth)] for t in range(len(trees.value))])
                known, base = ~np.isnan(y), each.sum(axis=0) + trees.start[0]
                for name in features:
                    now = base
                    if name is not None:
                        f = trees.columns.index(name)
                        keep, now = own[f].copy(), base.copy()
                        own[f] = other[f]
                        for t in np.flatnonzero(((asked[0] == f) & asked[1]).any(axis=1)):
                            now += trees.value[t, 0, trees.leaf(own, t, 0, trees.depth)] - each[t]
                        own[f] = keep
                    error = np.bincount(repeat[known], np.abs(y - now)[known])
                    cells = [pa.array(range(len(error)), pa.int32()), pa.array([name] * len(error), pa.string()), pa.array(error)]
                    yield pa.RecordBatch.from_arrays([*cells, pa.array(np.bincount(repeat[known]))], ["repeat", "feature", "error", "n"])

        sums = pairs.select("repeat", "y", "own", "other").mapInArrow(run, "repeat int, feature string, error double, n long")
        return sums.groupBy("repeat", "feature").agg(F.sum("error").alias("error"), F.sum("n").alias("n"))

    def importances(self) -> np.ndarray:
        """Share of every feature in the gains."""
        return self.gains / (self.gains.sum() or 1.0)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row, a few thousand numbers; none for a model without rows."""
        t = self.trees
        row = t and {
            "columns": list(t.columns),
            "edges": [list(map(float, e)) for e in t.edges],
            "depth": t.depth,
            "feature": t.feature.ravel().tolist(),
            "cut": t.cut.ravel().tolist(),
            "value": t.value.ravel().tolist(),
            "gains": self.gains.tolist(),
        }
        schema = "columns array<string>, edges array<array<double>>, depth int, feature array<int>, cut array<int>, value array<double>, gains array<double>"
        spark.createDataFrame([row] if row else [], schema).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedMean:
        r = spark.read.parquet(path).first()
        if r is None:
            return BoostedMean(None, np.zeros(0))
        inner = (1 << r.depth) - 1
        feature, cut = (np.array(x, np.int64).reshape(-1, 1, inner) for x in (r.feature, r.cut))
        value = np.array(r.value, float).reshape(-1, 1, inner + 1)
        trees = Trees(tuple(r.columns), tuple(map(tuple, r.edges)), (), (0.0,), r.depth, feature, cut, value)
        return BoostedMean(trees, np.array(r.gains, float))


def _now(block: tuple[bytes, bytes], trees: list[Trees], features: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins by feature, and residuals after ``trees``."""
    r = np.frombuffer(block[1], float)
    kind = np.uint8 if len(block[0]) == features * len(r) else np.uint16
    bins = np.frombuffer(block[0], kind).reshape(features, -1)
    for tree in trees:
        r = r - tree.value[0, 0, tree.leaf(bins, 0, 0, tree.depth)]
    return bins, r


def _level(blocks: RDD, trees: list[Trees], tree: Trees, level: int, bins: int, tasks: int) -> np.ndarray:
    """Counts and residuals ``[2, node, feature, bin]`` of a level of ``tree``, which follows ``trees``."""
    cells = (1 << level) * bins

    def run(held: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((2, len(tree.columns), cells))
        for b, r in (_now(x, trees, len(tree.columns)) for x in held):
            base, cell = tree.leaf(b, 0, 0, level) * bins, np.empty(len(r), np.int64)
            for f in range(len(b)):
                np.add(base, b[f], out=cell)
                total[0, f] += np.bincount(cell, minlength=cells)
                total[1, f] += np.bincount(cell, r, minlength=cells)
        yield total

    found = blocks.mapPartitions(run).treeReduce(np.add, depth=1 if tasks <= FEW_TASKS else 2)
    return found.reshape(2, len(tree.columns), -1, bins).swapaxes(1, 2)


def _splits(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, last left bin and gain of the best split of every node, and the children's means; a
    node that no split improves hands its rows to the left."""
    left = sums.cumsum(axis=-1)
    whole = left[..., -1:]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
        # What rounding alone may give is no gain.
        gain = np.where((left[0] > 0) & (right[0] > 0) & (gain > 1e-12 * (1 + whole[1] ** 2 / whole[0])), gain, 0.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=-1)  # the first of equal ones
    gains, nodes = flat[np.arange(len(flat)), best], np.arange(len(flat))
    feature, cut = np.divmod(best, sums.shape[-1])
    feature, cut = np.where(gains > 0, feature, 0), np.where(gains > 0, cut, 1 << 30)
    at = np.minimum(cut, sums.shape[-1] - 1)
    n, total = (np.stack([s[..., k, nodes, feature, at] for s in (left, right)], axis=-1) for k in (0, 1))
    return feature, cut, gains, np.where(n > 0, total / np.maximum(n, 1), 0.0)


def fit_boosted_mean(
    train: DataFrame,
    p: ModelParams = ModelParams(),
    columns: list[str] = FEATURE_COLS,
    bins: int = BINS,
    store_every: int = STORE_EVERY,
) -> BoostedMean:
    spark = train.sparkSession
    package_for_workers(spark)
    known = train.filter(F.col(LABEL).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(LABEL).cast("double").alias("y"))
    found = known.approxQuantile(columns, [i / bins for i in range(1, bins)], 0.001)
    edges = tuple(tuple(sorted(set(e))) for e in found)
    empty = np.zeros((0, 1, (1 << p.depth) - 1), np.int64)
    first = Trees(tuple(columns), edges, (), (0.0,), p.depth, empty, empty, np.zeros((0, 1, 1 << p.depth)))

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            frame = pd.concat(held, ignore_index=True)
            cells = first.binned(frame).tobytes(), frame["y"].to_numpy(float).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in cells], ["bins", "r"])

        for batch in batches:
            held, size = [*held, batch.to_pandas()], size + batch.num_rows
            if size >= BLOCK:
                yield block()
                held, size = [], 0
        if size:
            yield block()

    stored = materialize(known.mapInArrow(cut_blocks, "bins binary, r binary"), "boost-bins")
    count, features = stored.count(), len(columns)
    if not count:
        return BoostedMean(None, np.zeros(features))
    tasks = min(count, max(spark.sparkContext.defaultParallelism, count // TASK_BLOCKS))
    # Whole blocks are dealt out evenly, whatever the files' sizes.
    blocks = stored.repartition(tasks).rdd.map(lambda x: (bytes(x.bins), bytes(x.r))).persist(StorageLevel.MEMORY_AND_DISK)
    grown, pending, gains = [], [], np.zeros(features)
    for number in range(p.trees):
        tree = first.grown()
        for level in range(p.depth):
            feature, last, gain, means = _splits(_level(blocks, pending, tree, level, bins + 1, tasks))
            nodes = slice((1 << level) - 1, (2 << level) - 1)
            tree.feature[0, 0, nodes], tree.cut[0, 0, nodes] = feature, last
            np.add.at(gains, feature, gain * (4 if number else 1))  # of twice the residual
        tree.value[0, 0] = means.ravel() * (2 * p.learning_rate if number else 1)
        grown.append(tree)
        pending = [*pending, tree]
        if len(pending) == store_every and number + 1 < p.trees:
            path, done, before = new_folder(spark, "boost-state"), pending, blocks
            blocks.map(lambda x: (x[0], _now(x, done, features)[1].tobytes())).saveAsPickleFile(path, 1)
            blocks, pending = spark.sparkContext.pickleFile(path).persist(StorageLevel.MEMORY_AND_DISK), []
            before.unpersist()
    blocks.unpersist()
    parts = {name: np.concatenate([getattr(t, name) for t in grown]) for name in ("feature", "cut", "value")}
    return BoostedMean(Trees(tuple(columns), edges, (), (0.0,), p.depth, **parts), gains)
