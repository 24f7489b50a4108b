"""Quality by nearest-neighbour voting in a latent semantic space.

A text's terms are its lower-cased words (runs of letters, digits and bytes beyond ASCII), hashed to
2^15 columns. Beside them stand shape features: successions of three character classes and bands of a
few shares (repeated words, repeated successions, length); ``shape`` is their share of the weight, 0
leaves them out. Both are weighted by log frequency and inverse document frequency and projected on
the leading singular vectors of a labelled sample. Every document's cosine with every labelled
vector is computed, block by block; its score is the share of label 1 among the nearest ones,
weighted by similarity.

The sample is bounded by ``labelled`` rows, drawn by a hash of the id; whole texts are read, and a
row is collected as its non-zero terms. What is broadcast is ``labelled`` x ``dimensions`` and
(2^15 + shapes) x ``dimensions`` numbers.

Null or empty text has no terms and gets the sample's share of label 1. Several labels of one
document are averaged, labels without id or value count nothing. Without labels every score is
0.5. Ties between neighbours go to the row that comes first in the sample's hash order. Extra
columns are kept; ``quality_score`` gets underscores behind it where an input column has that name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, free_name, table
from .langid import held_out

_CLASSES = 14
_BANDS = 10


@dataclass(frozen=True)
class QualityParams:
    labelled: int = 4096  # bound of the labelled sample
    dimensions: int = 48
    neighbours: int = 15
    threshold: float = 0.3
    shape: float = 0.5  # share of the shape features in a text's weight
    block: int = 512  # documents in one product


def _class_table() -> np.ndarray:
    """Byte -> character class."""
    out = np.full(256, 13, np.uint16)  # other ASCII marks
    out[128:] = 1
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 2
    out[ord("0") : ord("9") + 1] = 3
    for i, group in enumerate([" \t", "\n\r", ".", ",", "!?", "|", "#$%&*", "\"'()", "-_/:;@", "<>[]{}="], 4):
        out[list(group.encode())] = i
    return out


_CLASS = _class_table()
SHAPES = _CLASSES**3 + 4 * _BANDS
WORDS = 1 << 15
# Bytes of words: ASCII letters in lower case, digits, bytes beyond ASCII; others part words.
_WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def _band(share: float) -> int:
    return min(_BANDS - 1, int(share * _BANDS))


def shapes(data: bytes) -> np.ndarray:
    """Frequencies of the shape features."""
    out = np.zeros(SHAPES, np.float32)
    c = _CLASS[np.frombuffer(b"\n" + data + b"\n", np.uint8)]
    if len(c) > 2:
        code = (c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:]
        out[: _CLASSES**3] = np.bincount(code, minlength=_CLASSES**3)
    words = data.split()
    if words:
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        n = len(h)
        pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        size = max(1, n // 8)
        at, heavy = _CLASSES**3, np.float32(size)
        out[at + _band(float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0)] = heavy
        out[at + _BANDS + _band(1 - len(np.unique(h)) / n)] = heavy
        out[at + 2 * _BANDS + _band(1 - len(np.unique(pairs)) / (n - 1) if n > 1 else 0.0)] = heavy
        out[at + 3 * _BANDS + min(_BANDS - 1, int(np.log2(n) / 1.5))] = np.float32(max(1, size // 4))
    return out


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text and their frequencies: hashed words first, shape features behind ``WORDS``."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    words = data.translate(_WORD_BYTES).split()
    hashed = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % WORDS
    at, n = np.unique(hashed.astype(np.int32), return_counts=True)
    shape = shapes(data)
    marks = np.flatnonzero(shape)
    return np.concatenate([at, marks + WORDS]).astype(np.int32), np.concatenate([n, shape[marks]]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return x


class _Rows:
    """Texts as sparse rows."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.sizes = np.array([len(t) for t, _ in rows], np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.sizes)
        self.term = np.concatenate([np.zeros(0, np.int32), *[t for t, _ in rows]])
        self.value = np.concatenate([np.zeros(0, np.float32), *[v for _, v in rows]])

    def weigh(self, idf: np.ndarray, shape: float) -> _Rows:
        """Log frequency times ``idf``; words and shapes of a row of length one each, shares by ``shape``."""
        value = np.log1p(self.value) * idf[self.term]
        part = 2 * self.row + (self.term >= WORDS)
        norm = np.sqrt(np.bincount(part, value * value, minlength=2 * len(self.sizes)))
        share = np.sqrt(np.where(self.term >= WORDS, shape, 1 - shape))
        self.value = (value / np.maximum(norm[part], 1e-9) * share).astype(np.float32)
        return self

    def times(self, m: np.ndarray) -> np.ndarray:
        """Product with a dense matrix, in steps of bounded size."""
        out = np.zeros((len(self.sizes), m.shape[1]), np.float32)
        ends = np.cumsum(self.sizes)
        lo = 0
        while lo < len(ends):
            first = ends[lo] - self.sizes[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, first + (1 << 18), "right")))
            cells = slice(first, ends[hi - 1])
            full = np.flatnonzero(self.sizes[lo:hi]) + lo
            if len(full):
                cut = ends[full] - self.sizes[full] - first
                out[full] = np.add.reduceat(m[self.term[cells]] * self.value[cells, None], cut, axis=0)
            lo = hi
        return out

    def transposed_times(self, m: np.ndarray, width: int) -> np.ndarray:
        out = np.empty((width, m.shape[1]), np.float32)
        for j in range(m.shape[1]):
            out[:, j] = np.bincount(self.term, self.value * m[self.row, j], minlength=width)
        return out


class KnnModel:
    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, p: QualityParams):
        self.p, self.labels = p, labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if not len(labels):
            return
        x, width = _Rows(rows), WORDS + SHAPES
        self.idf = np.log((1 + len(rows)) / (1 + np.bincount(x.term, minlength=width))).astype(np.float32)
        x.weigh(self.idf, p.shape)
        # Leading right singular vectors by subspace iteration from a fixed start.
        k = min(p.dimensions, len(rows))
        basis = np.random.default_rng(0).standard_normal((width, k + 8)).astype(np.float32)
        for _ in range(6):
            left, _ = np.linalg.qr(x.times(basis))
            basis, _ = np.linalg.qr(x.transposed_times(left, width))
        values, turn = np.linalg.eigh(np.float64(basis.T @ x.transposed_times(x.times(basis), width)))
        self.basis = (basis @ turn[:, np.argsort(-values)[:k]]).astype(np.float32)
        self.vectors = _unit(x.times(self.basis))

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        x = _Rows(rows).weigh(self.idf, self.p.shape)
        cosine = _unit(x.times(self.basis)) @ self.vectors.T
        near, similar = nearest(cosine, min(self.p.neighbours, len(self.labels)))
        weight = np.maximum(similar, 0) ** 4
        total = weight.sum(axis=1)
        share = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.where((total > 0) & (x.sizes > 0), np.clip(share, 0, 1), self.prior).astype(np.float64)


def nearest(cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the ``k`` largest values of each row and these values; of equal ones the first columns."""
    border = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
    above = cosine > border
    level = cosine == border
    level &= np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)
    near = np.nonzero(above | level)[1].reshape(len(cosine), k)
    return near, np.take_along_axis(cosine, near, axis=1)


def fit(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> KnnModel:
    """Fit on a sample of at most ``labelled`` rows of ``labels(doc_id, quality)``."""
    once = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    sample = once.orderBy(order, "doc_id").limit(p.labelled).collect()  # at most ``labelled`` pairs
    place = {r["doc_id"]: (i, r["quality"]) for i, r in enumerate(sample)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches):
        for batch in batches:
            rows = [
                (*shared.value[i], *(x.tobytes() for x in terms(t))) for i, t in zip(batch["doc_id"], batch["text"]) if i in shared.value
            ]
            yield pd.DataFrame(rows, columns=["place", "quality", "terms", "counts"])

    # Repeated rows of a document would vote repeatedly: one of them is taken.
    found = docs.select("doc_id", "text").mapInPandas(run, "place int, quality double, terms binary, counts binary")
    one = F.min(F.struct("terms", "counts")).alias("x")
    rows = found.groupBy("place", "quality").agg(one).select("place", "quality", "x.*").orderBy("place").collect()
    sparse = [(np.frombuffer(r["terms"], np.int32), np.frombuffer(r["counts"], np.float32)) for r in rows]
    return KnnModel(sparse, np.array([r["quality"] for r in rows]), p)


def score(docs: DataFrame, model: KnnModel, text: str = "text") -> DataFrame:
    """Add ``quality_score`` (see above for a clashing name) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(column: pd.Series) -> pd.Series:
        model, out = shared.value, [np.zeros(0)]
        for lo in range(0, len(column), model.p.block):
            out.append(model.score([terms(x) for x in column[lo : lo + model.p.block]]))
        return pd.Series(np.concatenate(out))

    return docs.withColumn(free_name(docs, "quality_score"), run(text))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fold, which takes no part in fitting."""
    return labels.select("doc_id", "quality").filter(~held_out("doc_id", 5, 0))


def keep_good(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """The rows that the classifier accepts."""
    model = fit(docs, training_labels(labels), p)
    kept = score(docs, model).filter(F.col(free_name(docs, "quality_score")) >= p.threshold)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    p = QualityParams()
    model = fit(docs, training_labels(table(spark, sf_dir, "labels")), p)
    scored = score(docs.withColumn("held_out", held_out("doc_id", 5, 0)), model)
    value = F.col("quality_score")
    return scored.select("doc_id", "held_out", value.alias("score"), (value >= p.threshold).cast("int").alias("predicted"))
