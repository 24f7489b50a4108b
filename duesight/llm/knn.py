"""Exact top-k search by a Voronoi kNN join.

Queries and data are grouped by their nearest pivot. Summaries of the groups (radius, the k
smallest distances of different ids to the pivot) bound, for every query group, the k-th best score
from below;
the distance of a data row to its pivot bounds its score with any query of a group from above.
A row is replicated only to query groups that it may still serve, and cells of bounded size are
solved locally by one product.

Scores are integer inner products and exact; bounds are widened by their rounding error. Vectors
that are null or hold null or non-finite components take no part; a query is answered by vectors of
its own length. Rows with the same id and vector count once and are made one first; a query is never
its own answer. Ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import table


@dataclass(frozen=True)
class KnnParams:
    k: int = 5
    pivots: int = 48
    cell_rows: int = 20_000  # data rows of a cell
    cell_queries: int = 1_000


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` with whole components floor(256 x), invalid vectors left out."""
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col(embedding).isNotNull() & ~bad & (F.size(embedding) > 0) & F.col(vec_id).isNotNull()
    # The dtype is fixed first: integer vectors have no NaN to ask for.
    typed = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias(embedding))
    return typed.filter(F.coalesce(valid, F.lit(False))).select("vec_id", scaled.alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles as long as all sums stay below 2^53."""
    top = max(1.0, float(np.abs(a).max(initial=0))) * max(1.0, float(np.abs(b).max(initial=0))) * a.shape[1]
    if top < 2**53:
        return (a @ b.T).astype(np.int64)
    return np.array(
        [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], dtype=object
    ).reshape(len(a), len(b))


def _assigned(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot ``g`` and the distance ``d`` to it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("g int, d double")
    def run(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"g": np.zeros(0, np.int32), "d": np.zeros(0)})
        x, p = _matrix(column), shared.value
        g = ((p * p).sum(1) - 2 * x @ p.T).argmin(axis=1)
        return pd.DataFrame({"g": g.astype(np.int32), "d": np.sqrt(((x - p[g]) ** 2).sum(1))})

    return rows.withColumn("a", run("v")).select("*", "a.g", "a.d").drop("a")


def _bounds(pivots: np.ndarray, query_groups: list, data_groups: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower bound of the k-th best score for each query group, and radius of each (-1: empty)."""
    n = len(pivots)
    radius = np.full(n, -1.0)
    for r in query_groups:
        radius[r["g"]] = r["radius"]
    cross, norm = pivots @ pivots.T, np.sqrt((pivots * pivots).sum(1))
    lowest = np.full(n, -np.inf)
    for i in range(n):
        if radius[i] < 0:
            continue
        # One more than k: the query itself may be among them.
        # An id counts once, whatever its number of vectors: all those of the query's own id go.
        best: dict = {}
        for r in data_groups:
            for x in r["near"]:
                score = cross[i, r["g"]] - radius[i] * norm[r["g"]] - (norm[i] + radius[i]) * x["d"]
                best[x["vec_id"]] = max(score, best.get(x["vec_id"], -np.inf))
        found = list(best.values())
        if len(found) > k:
            lowest[i] = np.partition(found, len(found) - k - 1)[len(found) - k - 1]
    return lowest - 1e-6 * (1 + np.abs(np.where(np.isfinite(lowest), lowest, 0))), radius


def top_k(data: DataFrame, queries: DataFrame, p: KnnParams = KnnParams()) -> DataFrame:
    """Rows ``query_id rank vec_id score``; both inputs are ``(vec_id, v)``."""
    # Written once: all that follows sees each row once.
    data = materialize(data.select("vec_id", "v").dropDuplicates(), "knn-data")
    queries = materialize(queries.select("vec_id", "v").dropDuplicates(), "knn-queries")
    sizes = [r["n"] for r in queries.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    local = data.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for size in sizes:
        local = local.union(_of_one_size(*(x.filter(F.size("v") == size) for x in (data, queries)), p))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")


def _of_one_size(data: DataFrame, queries: DataFrame, p: KnnParams) -> DataFrame:
    """Best rows ``query_id vec_id score`` of each cell, for distinct vectors of one length."""
    spark = data.sparkSession
    # Pivots: a few rows by a hash of their values, the same in every run.
    chosen = data.select("v").orderBy(F.xxhash64("v"), "v").limit(p.pivots).collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, vec_id long, score long")
    pivots = np.unique(np.array([r["v"] for r in chosen]), axis=0)
    data, queries = _assigned(data, pivots), _assigned(queries, pivots)
    ranked = Window.partitionBy("g").orderBy("d", "vec_id")
    near = data.groupBy("g", "vec_id").agg(F.min("d").alias("d"))
    near = near.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= p.k + 1)
    data_groups = near.groupBy("g").agg(F.collect_list(F.struct("vec_id", "d")).alias("near")).collect()
    query_groups = queries.groupBy("g").agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    lowest, radius = _bounds(pivots, query_groups, data_groups, p.k)
    blocks = {r["g"]: -(-r["n"] // p.cell_queries) for r in query_groups}
    rows_in_all = data.count()
    slices = max(1, -(-rows_in_all // p.cell_rows))
    shared = spark.sparkContext.broadcast((pivots, lowest, radius, blocks))

    @F.pandas_udf("array<struct<i:int,b:int>>")
    def serves(g: pd.Series, d: pd.Series) -> pd.Series:
        pivots, lowest, radius, blocks = shared.value
        norm = np.sqrt((pivots * pivots).sum(1))
        out = []
        for j, dist in zip(g, d):
            best = pivots @ pivots[j] + np.maximum(radius, 0) * norm[j] + (norm + np.maximum(radius, 0)) * dist
            keep = (radius >= 0) & (best + 1e-6 * (1 + np.abs(best)) >= lowest)
            out.append([{"i": int(i), "b": b} for i in np.flatnonzero(keep) for b in range(blocks[int(i)])])
        return pd.Series(out, dtype=object)

    part = F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int")
    sent = data.select("vec_id", "v", part.alias("s"), F.explode(serves("g", "d")).alias("c")).select("c.i", "c.b", "s", "vec_id", "v")
    block_of = F.create_map(*[F.lit(x) for g, n in blocks.items() for x in (int(g), int(n))])
    asked = queries.withColumns(
        {"i": F.col("g"), "b": F.pmod(F.xxhash64("vec_id"), block_of[F.col("g")]).cast("int"), "s": F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))}
    ).select("i", "b", "s", "vec_id", "v")

    def solve(key, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(q) and len(x):
            x = x.sort_values("vec_id", kind="stable")
            ids, mine = x["vec_id"].to_numpy(np.int64), q["vec_id"].to_numpy(np.int64)
            vectors = _matrix(x["v"])
            for lo in range(0, len(q), 128):
                scores = _product(_matrix(q["v"].iloc[lo : lo + 128]), vectors)
                for n, row in zip(mine[lo : lo + 128], scores):
                    rest = np.flatnonzero(ids != n)
                    # Ties keep the order of the ids.
                    taken = rest[np.argsort(-row[rest], kind="stable")][: p.k]
                    out["query_id"] += [n] * len(taken)
                    out["vec_id"] += ids[taken].tolist()
                    out["score"] += [int(v) for v in row[taken]]
        return pd.DataFrame(out).astype("int64")

    cells = asked.groupBy("i", "b", "s").cogroup(sent.groupBy("i", "b", "s"))
    return cells.applyInPandas(solve, "query_id long, vec_id long, score long")


def op6_voronoi(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON x.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
