"""I-Match fingerprints with randomised lexicons.

The lexicon holds the corpus's terms within a band of document frequency: neither everywhere nor
almost nowhere. Its size is bounded, as at most (mean distinct terms of a document) / ``low``
terms can occur in a share of at least ``low`` of the documents. A document keeps its distinct
lexicon terms, sorted, and hashes those that fall into each of several random sub-lexicons. The
sub-lexicons come in levels of falling size, so that short and long texts alike meet some of
which a few edits leave most unchanged.

Two fingerprints are alike by the share of sub-lexicons with equal hashes among those that hold a
term of either text, at the sparsest level which still says something.

Equal texts have equal fingerprints. Null text is empty; a text with fewer than ``least`` lexicon
terms uses all its terms; texts without any term share the empty fingerprint and are alike (1).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_KEYS, documents

@dataclass(frozen=True)
class FingerprintParams:
    low: float = 0.0005  # share of documents: the band's edges
    high: float = 0.2
    least: int = 8
    subsets: int = 24  # sub-lexicons on a level
    levels: tuple[int, ...] = (4, 16, 64, 256, 1024)  # one term of so many is in a sub-lexicon
    telling: int = 6  # sub-lexicons with terms that a level needs


def term_hashes(text: str) -> np.ndarray:
    """Distinct terms (white space apart, lower case) as sorted numbers."""
    words = text.lower().encode("utf-8", "replace").split()
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def lexicon(docs: DataFrame, p: FingerprintParams = FingerprintParams(), text: str = "text") -> np.ndarray:
    """Sorted hashes of the terms within the band, from all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pd.DataFrame:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"term": keys.view(np.int64), "n": n})

        for batch in batches:
            for value in batch[text]:
                held.append(term_hashes(value))
                size += len(held[-1])
                if size > 16 * FLUSH_KEYS:
                    yield out()
                    size = 0
        if held:
            yield out()

    rows = docs.filter(F.col(text).isNotNull()).select(text)
    counted = rows.mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = rows.count()
    band = counted.filter(F.col("n").between(max(2.0, p.low * total), p.high * total))
    return np.sort(band.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slots(p: FingerprintParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How terms reach sub-lexicons. One random split into ``rate`` parts gives that many
    sub-lexicons at once: for each split its salt, its number of parts, the first sub-lexicon it
    fills and how many it fills."""
    splits = []
    for level, rate in enumerate(p.levels):
        for filled in range(0, p.subsets, rate):
            splits.append((len(splits) + 1, rate, level * p.subsets + filled, min(rate, p.subsets - filled)))
    salt, rate, first, size = (np.array(x, np.uint64)[:, None] for x in zip(*splits))
    return salt * np.uint64(0x9E3779B97F4A7C15), rate, first, size


def fingerprint(text: str | None, words: np.ndarray, p: FingerprintParams = FingerprintParams()) -> str:
    """Eight hexadecimal digits for each sub-lexicon: a hash of its sorted distinct terms."""
    terms = term_hashes(text or "")
    if len(words) and len(terms):
        at = np.minimum(np.searchsorted(words, terms), len(words) - 1)
        inside = terms[words[at] == terms]
        terms = inside if len(inside) >= p.least else terms
    hashes = np.zeros(len(p.levels) * p.subsets, np.uint64)
    salt, rate, first, size = _slots(p)
    mixed = _mix(terms[None, :] + salt)
    part = mixed % rate
    chosen = part < size
    # The terms are distinct, so the sum of their hashes stands for the sub-document.
    np.add.at(hashes, (first + part)[chosen].astype(np.int64), _mix(mixed[chosen]) | np.uint64(1 << 32))
    return (hashes >> np.uint64(32)).astype(">u4").tobytes().hex()


def likeness(a: str, b: str, p: FingerprintParams = FingerprintParams()) -> float:
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s), ">u4").reshape(len(p.levels), p.subsets) for s in (a, b))
    used = ((x != 0) | (y != 0)).sum(axis=1)
    share = ((x == y) & (x != 0)).sum(axis=1) / np.maximum(used, 1)
    return float(share[used >= p.telling].max(initial=0.0))


def fingerprints(docs: DataFrame, words: np.ndarray, p: FingerprintParams = FingerprintParams(), text: str = "text") -> DataFrame:
    """Add ``fingerprint`` to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shared.value, p) for x in column], dtype=object)

    return docs.withColumn("fingerprint", run(text))


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by the beginning of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _ranges(docs: DataFrame, ranges: int) -> tuple[np.ndarray, dict[int, int]]:
    """Edges that split the ids evenly, and each range's smallest id."""
    known = docs.filter("doc_id is not null").select("doc_id")
    shares = [i / ranges for i in range(1, ranges)]
    edges = np.unique(known.approxQuantile("doc_id", shares, 0.2 / ranges)) if shares else np.zeros(0)
    rows = known.select(_range_of(edges)("doc_id").alias("r"), "doc_id").groupBy("r").agg(F.min("doc_id").alias("first")).collect()
    return edges, {r["r"]: r["first"] for r in rows}


def _range_of(edges: np.ndarray):
    @F.pandas_udf("int")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(np.float64), side="right").astype(np.int32))

    return run


def edited_likeness(docs: DataFrame, words: np.ndarray, p: FingerprintParams = FingerprintParams()) -> DataFrame:
    """Fingerprint every text, its edited form and the next text by ``doc_id``.

    Ids are split into even ranges; a range is one sorted run, and the first document of a range
    is sent to the range before it as well, so no order over all rows is needed. The text moves
    once, compressed. Rows of one id follow one another by compressed text; rows without id are left out of the order
    and take themselves as the next document.
    """
    spark = docs.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges, first = _ranges(docs, ranges)
    used = sorted(first)
    before = {used[i]: used[i - 1] for i in range(len(used))}  # the first range's goes behind the last
    shared = spark.sparkContext.broadcast((words, first, before, edges))

    @F.pandas_udf("array<struct<range:int,own:boolean>>")
    def placed(ids: pd.Series) -> pd.Series:
        _, first, before, edges = shared.value
        out = []
        for i in ids:
            if i is None or i != i:
                out.append([{"range": -1, "own": True}])
                continue
            at = int(np.searchsorted(edges, float(i), side="right"))
            rows = [{"range": at, "own": True}]
            if first[at] == i:
                rows.append({"range": before[at], "own": False})
            out.append(rows)
        return pd.Series(out, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, plain = shared.value[0], zstandard.ZstdDecompressor()
        held: tuple | None = None  # the last row, which waits for its next

        def row(one: tuple, after: tuple) -> tuple:
            _, doc_id, text, print_ = one
            changed = edited(text, after[2])
            other = fingerprint(changed, words, p)
            sha = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
            return doc_id, len(text), sha, print_, other, likeness(print_, other, p), likeness(print_, after[3], p)

        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        for batch in batches:
            rows = []
            for rng, own, doc_id, packed in zip(batch["range"], batch["own"], batch["doc_id"], batch["packed"]):
                text = plain.decompress(packed).decode()
                now = (rng, doc_id, text, fingerprint(text, words, p))
                if rng < 0:
                    rows.append(row((rng, None, *now[2:]), now))
                    continue
                if held is not None and held[0] == rng:
                    rows.append(row(held, now))
                held = now if own else None
            if rows:
                frame = pd.DataFrame(rows, columns=names)
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

    @F.pandas_udf("binary")
    def packed(column: pd.Series) -> pd.Series:
        small = zstandard.ZstdCompressor(level=1)
        return pd.Series([small.compress((x or "").encode("utf-8", "replace")) for x in column], dtype=object)

    dealt = docs.select("doc_id", packed("text").alias("packed"), F.explode(placed("doc_id")).alias("p")).select("p.range", "p.own", "doc_id", "packed")
    spread = F.when(F.col("range") < 0, F.monotonically_increasing_id()).otherwise(0)
    ordered = dealt.withColumn("spread", spread).repartition("range", "spread").sortWithinPartitions("range", F.desc("own"), "doc_id", "packed")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.drop("spread").mapInPandas(run, schema)


def op3_imatch(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return edited_likeness(docs, lexicon(docs))
