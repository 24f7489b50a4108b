"""Exact Jaccard self-join on five-word shingles, with set-relation skipping.

1. Equal sets are one class; only a representative goes on.
2. Index lists: each set is ordered by a global order (rare shingles first, by counts of all
   shingles in a bounded number of hash buckets) and indexed by the shingles of its prefix. A list
   is held in blocks by set size: a set meets only the blocks whose sizes it can be similar to,
   and skips entries whose positions leave too few common shingles (block skipping by position).
3. Answers from similar sets: in each list, sets are first compared with the list's leader. A
   set that is verified against a leader shares that leader's answers from then on; in the second
   round only pairs that are not yet in one component meet, and a parity signature refutes most
   of them before texts are read. So a group of n near copies costs n comparisons.

Nothing is lost: pairs that share no prefix shingle, or fail a size, position or parity bound,
can't reach the threshold, and pairs within a component can't change it.

A document's set: its distinct shingles of lower-cased (A-Z) words between white space; with fewer
words the whole sequence is the one shingle; null, empty or blank text has the empty set, which
links with nothing. Rows that share a doc_id are versions of one document. Rows without doc_id
take part, but never name a component: a component without any doc_id is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents
from .graph import components, may_hold

_MULT = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_WORDS = 8  # of 64 bits in a parity signature
_NO_ID = 1 << 62  # representatives without a doc_id are numbered from here


@dataclass(frozen=True)
class JoinParams:
    words: int = 5
    percent: int = 80
    buckets: int = 1 << 18  # of the shingle counts


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, len(h) if size < words else words, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MULT[i % 5] + h[i : i + n] * _MULT[(i + 1) % 5]
    out ^= out >> np.uint64(32)
    return np.unique(out)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def bucket_counts(docs: DataFrame, p: JoinParams = JoinParams(), text: str = "text") -> np.ndarray:
    """How many shingles of all documents fall into each hash bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(p.buckets, np.int64)
        for batch in batches:
            for value in batch[text]:
                at = (shingles(value, p.words) % np.uint64(p.buckets)).astype(np.int64)
                np.add.at(total, at, 1)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used.astype(np.int32), "n": total[used]})

    rows = docs.select(text).mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(p.buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def sets_of(docs: DataFrame, p: JoinParams = JoinParams(), text: str = "text") -> DataFrame:
    """Add ``n_shingles`` and ``set_id`` (equal for equal sets, null for empty ones)."""

    @F.pandas_udf("n long, id binary")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = []
        for value in column:
            s = shingles(value, p.words)
            rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None))
        return pd.DataFrame(rows, columns=["n", "id"])

    got = docs.withColumn("set__", run(text))
    return got.withColumns({"n_shingles": F.col("set__.n"), "set_id": F.col("set__.id")}).drop("set__")


def _index(docs: DataFrame, counts: np.ndarray, p: JoinParams) -> DataFrame:
    """``node n parity prefix`` for every row of ``docs(node, text)``; the prefix in global order."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    @F.pandas_udf("n int, parity array<long>, prefix array<long>")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = []
        for value in column:
            s = shingles(value, p.words)
            order = np.lexsort((s, shared.value[(s % np.uint64(p.buckets)).astype(np.int64)]))
            kept = len(s) + (-len(s) * p.percent // 100) + 1  # |s| - ceil(t |s|) + 1
            bits = np.bincount((s >> np.uint64(40)).astype(np.int64) % (64 * _WORDS), minlength=64 * _WORDS) & 1
            parity = np.packbits(bits.astype(np.uint8)).view(np.int64)
            rows.append((len(s), parity, s[order[:kept]].view(np.int64)))
        return pd.DataFrame(rows, columns=["n", "parity", "prefix"])

    return docs.select("node", run("text").alias("i")).select("node", "i.n", "i.parity", "i.prefix")


def _reaches(nx, ix, ny, iy, percent: int):
    """Can sets of sizes nx, ny with a common shingle at positions ix, iy reach the threshold?"""
    most = F.least(nx - ix, ny - iy)
    return (100 + percent) * most >= percent * (nx + ny)


def _verified(pairs: DataFrame, texts: DataFrame, p: JoinParams) -> DataFrame:
    """The pairs ``(a, b)`` whose texts link."""
    pairs = materialize(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    wanted = may_hold(texts, "node", ids, "node")
    left, right = (wanted.select(F.col("node").alias(k), F.col("text").alias(f"t{k}")) for k in ("a", "b"))

    @F.pandas_udf("boolean")
    def check(x: pd.Series, y: pd.Series) -> pd.Series:
        held: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in held:
                if len(held) > 64:
                    held.clear()
                held[text] = shingles(text, p.words)
            return held[text]

        return pd.Series([linked(of(a), of(b), p.percent) for a, b in zip(x, y)], dtype=bool)

    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(check("ta", "tb")).select("a", "b").distinct()


def representatives(docs: DataFrame, p: JoinParams = JoinParams()) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id n_shingles node``, and ``node text`` of one row for each distinct set.

    ``node`` is the smallest doc_id of the class; null for empty sets."""
    rows = materialize(sets_of(docs.select("doc_id", "text"), p).select("doc_id", "n_shingles", "set_id"), "sets")
    named = rows.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("node"))
    unnamed = F.lit(_NO_ID) + F.pmod(F.xxhash64("set_id"), F.lit(1 << 61))
    named = materialize(named.select("set_id", F.coalesce("node", unnamed).alias("node")), "classes")
    members = rows.join(named, "set_id", "left").select("doc_id", "n_shingles", "node")
    # A class's text is read from the row that names it; classes without any doc_id by their set.
    with_id = docs.select("doc_id", "text").filter("doc_id is not null")
    texts = may_hold(with_id, "doc_id", named, "node").select(F.col("doc_id").alias("node"), "text")
    nameless = named.filter(F.col("node") >= _NO_ID)
    if nameless.limit(1).count():
        others = sets_of(docs.filter("doc_id is null").select("text"), p).join(nameless, "set_id")
        texts = texts.union(others.select("node", "text").groupBy("node").agg(F.min("text").alias("text")))
    return members, texts


def links(docs: DataFrame, p: JoinParams = JoinParams()) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id n_shingles node``, and ``(node, root)`` of all nodes with a link."""
    members, texts = representatives(docs, p)
    counts = bucket_counts(docs, p)
    indexed = _index(texts, counts, p)
    names = members.select("node").filter("node is not null").distinct()
    entries = indexed.join(names, "node", "left_semi").select("node", "n", F.posexplode("prefix").alias("i", "shingle"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = entries.repartition(parts, "shingle")
    leader = lists.groupBy("shingle").agg(F.min(F.struct("node", "n", "i")).alias("l"), F.count(F.lit(1)).alias("size"))
    # Lists with one set are done; the others are small and kept.
    index = materialize(lists.join(leader.filter("size > 1").drop("size"), "shingle"), "index")

    led = index.filter(F.col("node") != F.col("l.node")).filter(_reaches(F.col("n"), F.col("i"), F.col("l.n"), F.col("l.i"), p.percent))
    shared = led.groupBy("node", F.col("l.node").alias("leader")).agg(F.count(F.lit(1)).alias("common"))
    best = shared.groupBy("node").agg(F.max(F.struct("common", "leader")).alias("m"))
    stars = _verified(best.select(F.col("node").alias("a"), F.col("m.leader").alias("b")), texts, p)
    first = materialize(components(stars), "components")

    # Second round: lists that still hold sets of different components.
    placed = index.select("node", "n", "i", "shingle").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed, "placed")
    mixed = placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("shingle")
    open_ = placed.join(mixed, "shingle", "left_semi")
    wanted = open_.select("node").distinct()
    parity = may_hold(texts, "node", wanted, "node")
    parity = _index(parity, counts, p).select("node", "parity").groupBy("node").agg(F.min("parity").alias("parity"))
    open_ = materialize(open_.join(parity, "node"), "open")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / p.percent)))
    x = open_.select(*[F.col(c).alias(f"x_{c}") for c in ("node", "n", "i", "root", "parity")], "shingle", F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    y = open_.select(*[F.col(c).alias(f"y_{c}") for c in ("node", "n", "i", "root", "parity")], "shingle", band.alias("band"))
    apart = sum((F.bit_count(F.col("x_parity")[w].bitwiseXOR(F.col("y_parity")[w])) for w in range(_WORDS)), F.lit(0))
    met = x.join(y, ["shingle", "band"]).filter(
        (F.col("x_root") != F.col("y_root"))
        & (F.col("x_node") < F.col("y_node"))
        & _reaches(F.col("x_n"), F.col("x_i"), F.col("y_n"), F.col("y_i"), p.percent)
        # The symmetric difference of linked sets is at most (1 - t) / (1 + t) of their sizes' sum.
        & ((100 + p.percent) * apart <= (100 - p.percent) * (F.col("x_n") + F.col("y_n")))
    )
    late = _verified(met.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct(), texts, p)
    return members, components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(late))


def near_components(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """``doc_id n_shingles component_id`` for every row."""
    members, roots = links(docs, p)
    found = members.join(roots, "node", "left").withColumn("component_id", F.coalesce("root", "node", "doc_id"))
    named = F.when(F.col("component_id") < _NO_ID, F.col("component_id"))
    return found.select("doc_id", "n_shingles", named.alias("component_id"))


def one_of_each(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """One row of each component: that of the smallest doc_id (of several, the smallest text).
    Rows with the empty set stay, and so do rows without doc_id."""
    found = near_components(docs.select("doc_id", "text"), p)
    gone = found.filter("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def op5_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, CAST(len(w) AS BIGINT) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT e.b, r.low FROM reach r JOIN both_ways e ON e.a = r.node)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, min(r.low) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.node = d.doc_id GROUP BY 1, 2
"""
