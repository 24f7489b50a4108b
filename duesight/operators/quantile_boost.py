"""Gradient boosting with pinball loss: intervals from boosted quantiles.

Spark ML boosts squared and absolute error only, so the trees are grown here, all quantiles at
once. Features are cut into at most ``bins`` bins by their quantiles; the binned matrix is written
once, in blocks of ``BLOCK`` rows whose columns are numpy buffers. Then, for every tree and level, tasks
count rows above and below their prediction by (quantile, node, feature, bin) and their counts are
summed: at most ``2 * quantiles * 2^(depth-1) * features * bins`` numbers reach the driver, whatever the number of
rows. A pass over a level reads the bins and a bit a quantile, no more. Gradients (``q`` above, ``q - 1`` below)
follow from the counts; splits maximise their squared sums. A leaf's value is the exact quantile of the residuals in
it, shrunk by the learning rate: one pass counts them on a grid, one fetches the distinct ones in the cell
that holds the quantile. Predictions so far stand beside the bins: every tree adds itself to the
cached blocks, and every ``store_every`` trees they are written, so that lineage and work stay short
and a lost executor repeats few trees of its blocks.

Rows without a label take no part in fitting. A missing or NaN feature counts as lower than all
others, in fitting and scoring. Without any row the quantiles are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import ModelParams
from ..schemas import FEATURE_COLS
from ..session import materialize, new_folder, package_for_workers

LABEL = "days_late"
BINS = 32
LEAST_ROWS = 20  # of a leaf
STORE_EVERY = 10
BLOCK = 1 << 15  # rows
FEW_TASKS = 64  # whose sums the driver adds up by itself
TASK_BLOCKS = 16
GRID = 2046  # cells for the residuals of a leaf, without one for those beyond either end
WHOLE_LEVELS = 6  # of a tree, up to 8


@dataclass(frozen=True)
class Trees:
    """Complete binary trees for every quantile: inner nodes by level, then leaves from left."""

    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]  # upper edges of bins, by feature
    quantiles: tuple[float, ...]  # none for a mean
    start: tuple[float, ...]  # first prediction of each quantile, or of the mean
    depth: int
    feature: np.ndarray  # [tree, quantile, inner node]
    cut: np.ndarray  # last bin that goes left
    value: np.ndarray  # [tree, quantile, leaf], shrunk

    def binned(self, frame: pd.DataFrame) -> np.ndarray:
        columns = []
        for name, edges in zip(self.columns, self.edges):
            x = frame[name].to_numpy(dtype=float, na_value=np.nan)
            # Bin 0 is for missing values.
            columns.append(np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(edges), x, side="left")))
        kind = np.uint8 if all(len(e) < 255 for e in self.edges) else np.uint16
        return np.stack(columns).astype(kind) if columns else np.zeros((0, len(frame)), kind)

    def leaf(self, bins: np.ndarray, tree: int, quantile: int, levels: int) -> np.ndarray:
        """Node of every row after so many levels, counted from left in its level; ``bins`` by feature.

        The upper levels compare whole columns for each node, which costs a fraction of looking up
        every row's feature and cut; below, where nodes are many, rows are looked up."""
        size, most = bins.shape[1], np.iinfo(bins.dtype).max
        feature, cut = self.feature[tree, quantile], self.cut[tree, quantile]
        node, held = np.zeros(size, np.uint8), [np.ones(size, bool)]
        for level in range(min(levels, WHOLE_LEVELS)):
            went, below = np.zeros(size, bool), []
            for at, rows in enumerate(held, (1 << level) - 1):
                right = rows & (bins[feature[at]] > min(int(cut[at]), most))
                went |= right
                below += [rows ^ right, right]
            node, held = 2 * node + went, below
        node = node.astype(np.int64)
        if levels > WHOLE_LEVELS:
            flat, rows = bins.ravel(), np.arange(size)
            for level in range(WHOLE_LEVELS, levels):
                at = node + ((1 << level) - 1)
                node = 2 * node + (flat[feature[at] * size + rows] > cut[at])
        return node

    def advance(self, predictions: np.ndarray, bins: np.ndarray, first: int) -> np.ndarray:
        """Add the trees from number ``first`` on."""
        for tree in range(first, len(self.value)):
            for q in range(len(self.start)):
                predictions[q] += self.value[tree, q, self.leaf(bins, tree, q, self.depth)]
        return predictions

    def predict(self, frame: pd.DataFrame) -> np.ndarray:
        bins = self.binned(frame)
        return self.advance(np.tile(np.array(self.start)[:, None], (1, len(frame))), bins, 0)

    def grown(self) -> Trees:
        """With one more tree that does not split yet."""
        q, inner = len(self.start), (1 << self.depth) - 1
        shape = (1, q, inner)
        return replace(
            self,
            feature=np.concatenate([self.feature, np.zeros(shape, np.int64)]),
            cut=np.concatenate([self.cut, np.full(shape, 1 << 30, np.int64)]),
            value=np.concatenate([self.value, np.zeros((1, q, inner + 1))]),
        )


_BLOCKS = "n int, bins binary, y binary, p binary"


def _packed(bins: np.ndarray, y: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([len(y)], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (bins, y, p)]]
    return pa.RecordBatch.from_arrays(cells, ["n", "bins", "y", "p"])


class Block(NamedTuple):
    """Rows, bins by feature, labels, and predictions by quantile."""

    n: int
    bins: bytes
    y: bytes
    p: bytes


def _bins(cells: bytes, n: int, trees: Trees) -> np.ndarray:
    kind = np.uint8 if len(cells) == n * len(trees.columns) else np.uint16
    return np.frombuffer(cells, kind).reshape(-1, n)


def _opened(block: Block, trees: Trees) -> tuple[np.ndarray, ...]:
    return _bins(block.bins, block.n, trees), np.frombuffer(block.y, float), np.frombuffer(block.p, float).reshape(-1, block.n)


def _sided(block: Block) -> tuple[bytes, bytes]:
    """Bins, and in a byte a row, whether its label is above each prediction."""
    y, p = np.frombuffer(block.y, float), np.frombuffer(block.p, float).reshape(-1, block.n)
    return block.bins, np.packbits(y > p, axis=0, bitorder="little")[0].tobytes()


def _summed(parts: RDD, tasks: int) -> np.ndarray:
    return parts.treeReduce(np.add, depth=1 if tasks <= FEW_TASKS else 2)


def _level(sided: RDD, trees: Trees, level: int, bins: int, tasks: int) -> np.ndarray:
    """Counts and gradients ``[2, quantile, node, feature, bin]`` of a level of the last tree."""
    last, nodes, features = len(trees.value) - 1, 1 << level, len(trees.columns)
    cells = 2 * nodes * bins

    def run(held: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((len(trees.quantiles), features, cells), np.int64)
        for packed, sides in held:
            above = np.frombuffer(sides, np.uint8)
            b, cell = _bins(packed, len(above), trees), np.empty(len(above), np.int64)
            for q in range(len(trees.quantiles)):
                base = (2 * trees.leaf(b, last, q, level) + (above >> q & 1)) * bins
                for f in range(features):
                    total[q, f] += np.bincount(np.add(base, b[f], out=cell), minlength=cells)
        yield total

    found = _summed(sided.mapPartitions(run), tasks).reshape(-1, features, nodes, 2, bins).swapaxes(1, 2)
    below, above = found[..., 0, :], found[..., 1, :]
    share = np.array(trees.quantiles)[:, None, None, None]
    return np.stack([below + above, share * above + (share - 1) * below])


def _best_splits(sums: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature and last left bin of the best split of every (quantile, node); no split where
    none leaves enough rows on both sides and gains anything."""
    left = sums.cumsum(axis=-1)
    whole = left[..., -1:]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
    gain = np.where((left[0] >= least) & (right[0] >= least), gain, -np.inf)
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(axis=-1)  # the first of equal ones
    gains = np.take_along_axis(flat, best[..., None], axis=-1)[..., 0]
    feature, cut = np.divmod(best, sums.shape[-1])
    return np.where(gains > 1e-12, feature, 0), np.where(gains > 1e-12, cut, 1 << 30)


def _leaf_values(rows: RDD, trees: Trees, reach: float, tasks: int) -> np.ndarray:
    """The exact quantile of the residuals in every leaf of the last tree. Few of them should be
    beyond ``reach`` on either side, or many are fetched."""
    last, leaves = len(trees.value) - 1, trees.value.shape[2]
    shares = range(len(trees.quantiles))

    def placed(block: Block, q: int) -> tuple[np.ndarray, ...]:
        """Residuals, and their places in the grids of their leaves."""
        b, y, predictions = _opened(block, trees)
        r = y - predictions[q]
        cell = np.clip(np.floor((r + reach) * (GRID / (2 * reach))) + 1, 0, GRID + 1)
        cell[np.isnan(cell)] = GRID + 1
        return r, trees.leaf(b, last, q, trees.depth) * (GRID + 2) + cell.astype(np.int64)

    def count(held: Iterator[Block]) -> Iterator[np.ndarray]:
        total = np.zeros((len(trees.quantiles), leaves * (GRID + 2)), np.int64)
        for block in held:
            for q in shares:
                total[q] += np.bincount(placed(block, q)[1], minlength=total.shape[1])
        yield total

    counted = _summed(rows.mapPartitions(count), tasks).reshape(-1, leaves, GRID + 2).cumsum(axis=-1)
    n = counted[..., -1]
    # Not a rank more where the product is rounded up.
    rank = np.maximum(np.ceil(np.array(trees.quantiles)[:, None] * n - 1e-9).astype(np.int64), 1)
    at = (counted < rank[..., None]).sum(axis=-1)  # beyond the grid where a leaf is empty
    before = np.where(at > 0, np.take_along_axis(counted, np.maximum(at - 1, 0)[..., None], axis=-1)[..., 0], 0)
    wanted = np.zeros((len(trees.quantiles), leaves, GRID + 3), bool)
    np.put_along_axis(wanted, at[..., None], True, axis=-1)
    wanted = wanted[..., : GRID + 2].reshape(len(trees.quantiles), -1)

    def fetch(held: Iterator[Block]) -> Iterator[tuple]:
        kept: list[list] = [[] for _ in shares]
        for block in held:
            for q in shares:
                r, cell = placed(block, q)
                some = wanted[q][cell]
                kept[q].append(np.stack([cell[some] // (GRID + 2), r[some]]))
        for q in shares:
            if kept[q]:
                yield q, *np.unique(np.concatenate(kept[q], axis=1), axis=1, return_counts=True)

    found = rows.mapPartitions(fetch).collect()  # distinct values of one cell a leaf
    out = np.zeros(trees.value.shape[1:])
    for q in shares:
        parts = [(x, m) for at_q, x, m in found if at_q == q]
        if not parts:
            continue
        leaf, r = np.concatenate([x for x, _ in parts], axis=1)
        m = np.concatenate([m for _, m in parts])
        order = np.lexsort((r, leaf))
        leaf, r, m = leaf[order].astype(np.int64), r[order], m[order]
        for k in np.unique(leaf):
            own = slice(*np.searchsorted(leaf, [k, k + 1]))
            out[q, k] = r[own][np.searchsorted(m[own].cumsum(), rank[q, k] - before[q, k])]
    return out


def _advanced(rows: RDD, trees: Trees) -> RDD:
    """The same blocks with the last tree added to their predictions."""

    def run(block: Block) -> Block:
        b, _, predictions = _opened(block, trees)
        return block._replace(p=trees.advance(predictions.copy(), b, len(trees.value) - 1).tobytes())

    return rows.map(run)


@dataclass
class BoostedInterval:
    """Adds ``days_late_lower`` and ``days_late_upper``, the first and the last quantile."""

    trees: Trees | None

    def transform(self, df: DataFrame) -> DataFrame:
        package_for_workers(df.sparkSession)
        trees = self.trees
        if trees is None:
            null = F.lit(None).cast("double")
            return df.withColumns({"days_late_lower": null, "days_late_upper": null})

        @F.pandas_udf("array<double>")
        def predicted(frame: pd.DataFrame) -> pd.Series:
            return pd.Series(list(trees.predict(frame).T))

        cells = F.struct(*[F.col(c).cast("double").alias(c) for c in trees.columns])
        out = df.withColumn("boost__q", predicted(cells))
        ends = {"days_late_lower": F.get("boost__q", F.lit(0)), "days_late_upper": F.get("boost__q", F.lit(len(trees.quantiles) - 1))}
        return out.withColumns(ends).drop("boost__q")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row, a few thousand numbers."""
        t = self.trees
        row = {
            "columns": list(t.columns),
            "edges": [list(map(float, e)) for e in t.edges],
            "quantiles": list(t.quantiles),
            "start": [float(x) for x in t.start],
            "depth": t.depth,
            "trees": len(t.value),
            "feature": t.feature.ravel().tolist(),
            "cut": t.cut.ravel().tolist(),
            "value": t.value.ravel().tolist(),
        }
        schema = (
            "columns array<string>, edges array<array<double>>, quantiles array<double>, start array<double>, "
            "depth int, trees int, feature array<int>, cut array<int>, value array<double>"
        )
        spark.createDataFrame([row], schema).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedInterval:
        r = spark.read.parquet(path).first()
        shape = (r.trees, len(r.quantiles), -1)
        arrays = (np.array(r.feature, np.int64), np.array(r.cut, np.int64), np.array(r.value, float))
        feature, cut, value = (a.reshape(shape) for a in arrays)
        edges = tuple(map(tuple, r.edges))
        return BoostedInterval(Trees(tuple(r.columns), edges, tuple(r.quantiles), tuple(r.start), r.depth, feature, cut, value))


def fit_boosted_interval(
    train: DataFrame,
    p: ModelParams = ModelParams(),
    columns: list[str] = FEATURE_COLS,
    bins: int = BINS,
    least: int = LEAST_ROWS,
    store_every: int = STORE_EVERY,
) -> BoostedInterval:
    package_for_workers(train.sparkSession)
    quantiles = (p.lower_quantile, p.upper_quantile)
    known = train.filter(F.col(LABEL).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(LABEL).cast("double").alias("y"))
    probs = [i / bins for i in range(1, bins)]
    found = known.approxQuantile([*columns, "y"], [*probs, *quantiles], 0.001)
    if not found[-1]:
        return BoostedInterval(None)
    edges = tuple(tuple(sorted(set(e[: len(probs)]))) for e in found[:-1])
    start = tuple(found[-1][len(probs) :])
    empty = np.zeros((0, len(quantiles), (1 << p.depth) - 1), np.int64)
    trees = Trees(tuple(columns), edges, quantiles, start, p.depth, empty, empty, np.zeros((0, len(quantiles), 1 << p.depth)))
    first, kind = trees, np.uint8 if bins < 256 else np.uint16

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            frame = pd.concat(held, ignore_index=True)
            p0 = np.tile(np.array(start)[:, None], (1, len(frame)))
            return _packed(first.binned(frame).astype(kind), frame["y"].to_numpy(float), p0)

        for batch in batches:
            held, size = [*held, batch.to_pandas()], size + batch.num_rows
            if size >= BLOCK:
                yield block()
                held, size = [], 0
        if size:
            yield block()

    spark = train.sparkSession
    stored = materialize(known.mapInArrow(cut, _BLOCKS), "boost-bins")
    count = stored.count()
    tasks = max(1, min(count, max(spark.sparkContext.defaultParallelism, count // TASK_BLOCKS)))
    # Whole blocks are dealt out evenly, whatever the files' sizes.
    dealt = stored.repartition(tasks).rdd.map(lambda x: Block(x.n, bytes(x.bins), bytes(x.y), bytes(x.p)))
    rows = dealt.persist(StorageLevel.MEMORY_AND_DISK)
    spread = found[-1][len(probs) - 1] - found[-1][0]
    reach = spread if spread > 0 else 1.0
    behind: list[RDD] = []
    for number in range(p.trees):
        trees = trees.grown()
        sided = rows.map(_sided).persist(StorageLevel.MEMORY_AND_DISK)
        for level in range(p.depth):
            feature, last = _best_splits(_level(sided, trees, level, bins + 1, tasks), least)
            while behind:  # the blocks of the tree before are no longer needed
                behind.pop().unpersist()
            nodes = slice((1 << level) - 1, (2 << level) - 1)
            trees.feature[-1, :, nodes], trees.cut[-1, :, nodes] = feature, last
        sided.unpersist()
        trees.value[-1] = p.learning_rate * _leaf_values(rows, trees, reach, tasks)
        if number + 1 == p.trees:
            break
        behind.append(rows)
        rows = _advanced(rows, trees)
        if (number + 1) % store_every == 0:
            path = new_folder(spark, "boost-state")
            rows.saveAsPickleFile(path, 1)
            rows = spark.sparkContext.pickleFile(path)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    rows.unpersist()
    return BoostedInterval(trees)
