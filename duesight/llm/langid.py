"""Language identification by prediction with partial matching.

For every language a context tree over bytes of order three is counted: how often each byte
follows each context of three, two, one and no bytes. A byte's code length is its share in the
longest context that has seen it, plus an escape for every longer context that has seen others
only (method C: as many escapes as there are distinct successors). A text's language is the one
whose frozen tree codes it in the fewest bits. The statistics are fixed, so a code length is a
function of four bytes and is looked up.

Counts cover all training rows and every language; partial counts are summed inside the tasks, and
nothing is pruned: lower orders are exact. The model has a row for each distinct four-byte sequence of
a language, a number that levels off with the alphabet and not with the documents. It is broadcast in
parts of about ``part`` sequences (whole languages), each scored in a pass of its own.

Null text, or text without a letter: ``und`` with score 0; the same for all texts if there is
nothing to learn from, as in an empty table. An empty table of documents gives an empty result,
repeated rows are answered once each. Ties go to the language that sorts first. Extra columns are
kept; ``lang_pred`` and ``lang_score`` get underscores behind them where an input column has that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents, free_name

_LETTER = re.compile(r"[^\W\d_]")
_START = b"\n\n\n"
_PAIRS = 2048
_CELLS = 16_000_000  # of the table of ready code lengths, which saves time and changes no result


@dataclass(frozen=True)
class LanguageParams:
    part: int = 4_000_000  # learned sequences in one part of the model, whole languages each


def _lowered(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _grams(data: bytes) -> np.ndarray:
    """The four bytes that end at each position, as one number."""
    b = np.frombuffer(_START + data, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def gram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows ``(lang, gram, n)``: successions of four bytes in the texts of each language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def merge() -> None:
            for name, parts in held.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                if name in sums:
                    both = np.concatenate([sums[name][0], keys])
                    keys, where = np.unique(both, return_inverse=True)
                    n = np.bincount(where, np.concatenate([sums[name][1], n])).astype(np.int64)
                sums[name] = keys, n
            held.clear()

        def out() -> Iterator[pd.DataFrame]:
            for name, (keys, n) in sums.items():
                yield pd.DataFrame({"lang": name, "gram": keys.astype(np.int64), "n": n})
            sums.clear()

        for batch in batches:
            for value, name in zip(batch[text], batch[lang]):
                held.setdefault(name, []).append(_grams(_lowered(value)))
                size += len(held[name][-1])
                if size > 4_000_000:
                    merge()
                    size = 0
            if sum(len(k) for k, _ in sums.values()) > 2_000_000:
                yield from out()
        merge()
        yield from out()

    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    return rows.mapInPandas(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Tree:
    """Code lengths of one language."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.orders = []
        for order in (3, 2, 1, 0):
            keys, where = np.unique(grams & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            count = np.bincount(where, n)
            contexts, at, distinct = np.unique(keys >> 8, return_inverse=True, return_counts=True)
            total = np.bincount(at, count)
            bits = -np.log2(count / (total + distinct)[at])
            escape = -np.log2(distinct / (total + distinct))
            self.orders.append((order, keys, bits, contexts, escape))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        out, rest = np.zeros(len(grams)), np.arange(len(grams))
        for order, keys, bits, contexts, escape in self.orders:
            wanted = grams[rest] & ((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            seen = keys[at] == wanted
            out[rest[seen]] += bits[at[seen]]
            rest, wanted = rest[~seen], wanted[~seen]
            at = np.minimum(np.searchsorted(contexts, wanted >> 8), len(contexts) - 1)
            known = contexts[at] == wanted >> 8
            out[rest[known]] += escape[at[known]]
        out[rest] += 8.0  # a byte never seen: any of 256
        return out


class PpmModel:
    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.names = sorted(counts)
        self.trees = [_Tree(counts[k][0].astype(np.int64), counts[k][1]) for k in self.names]
        self.table = None

    def _prepare(self) -> None:
        """Code lengths of all learned sequences, found by two frequent byte pairs at once."""
        grams = np.unique(np.concatenate([t.orders[0][1] for t in self.trees]))
        pairs, n = np.unique(np.concatenate([grams >> 16, grams & 0xFFFF]), return_counts=True)
        frequent = pairs[np.argsort(-n, kind="stable")[: _PAIRS - 1]]
        self.pair = np.zeros(65536, np.uint32)
        self.pair[frequent] = np.arange(1, len(frequent) + 1)
        first, second = self.pair[grams >> 16], self.pair[grams & 0xFFFF]
        kept = np.flatnonzero((first > 0) & (second > 0))[: _CELLS // len(self.trees)]
        grams, first, second = grams[kept], first[kept], second[kept]
        self.row = np.zeros(_PAIRS * _PAIRS, np.int32)
        self.row[first * _PAIRS + second] = np.arange(1, len(grams) + 1)
        self.table = np.zeros((len(grams) + 1, len(self.trees)), np.float32)
        for i, tree in enumerate(self.trees):
            self.table[1:, i] = tree.bits(grams)

    def bits(self, text: str) -> np.ndarray:
        """Exact code length of the text in each language."""
        if self.table is None:
            self._prepare()
        total = np.zeros(len(self.names))
        data = _lowered(text)
        step = 1 << 20  # a very long text is coded in pieces that know what stands before them
        for lo in range(0, len(data), step):
            grams = _grams(data[max(0, lo - 3) : lo + step])
            grams = grams[3:] if lo else grams
            rows = self.row[self.pair[grams >> 16] * _PAIRS + self.pair[grams & 0xFFFF]]
            total += self.table[rows].sum(axis=0, dtype=np.float64)
            rest = grams[rows == 0].astype(np.int64)
            if len(rest):
                total += [t.bits(rest).sum() for t in self.trees]
        return total

    def judge(self, text: str | None) -> tuple[str | None, float, float]:
        """The nearest language, its code length, and the sum of 2^(its length - length) over all."""
        if not self.names or not text or not _LETTER.search(text):
            return None, 0.0, 0.0
        bits = self.bits(text)
        best = int(bits.argmin())
        return self.names[best], float(bits[best]), float(np.exp2(np.maximum(bits[best] - bits, -1000)).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        name, _, total = self.judge(text)
        return ("und", 0.0) if name is None else (name, 1 / total)


def fit(docs: DataFrame, p: LanguageParams = LanguageParams(), text: str = "text", lang: str = "lang") -> list[PpmModel]:
    """Learn every language from all rows with a text and a language. Nothing is cut off: the model
    comes in parts of about ``part`` sequences, each of whole languages."""
    counts = materialize(gram_counts(docs, text, lang), "grams")
    sizes = counts.groupBy("lang").count().orderBy("lang").collect()  # one row a language
    parts, size = [[]], 0
    for row in sizes:
        if parts[-1] and size + row["count"] > p.part:
            parts, size = [*parts, []], 0
        parts[-1].append(row["lang"])
        size += row["count"]
    models = []
    for names in parts:
        rows = counts.filter(F.col("lang").isin(names)).orderBy("lang", "gram").toPandas()
        models.append(PpmModel({k: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(np.float64)) for k, g in rows.groupby("lang")}))
    return models


def _judged(shared: Broadcast, text: Column) -> Column:
    @F.pandas_udf("name string, bits double, total double")
    def run(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(x) for x in column], columns=["name", "bits", "total"])

    return run(text)


def predict(docs: DataFrame, models: list[PpmModel], text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``lang_score`` (posterior under equal priors). A further part of the model
    is a further pass, so that a task holds one part at a time."""
    own = free_name(docs, "lang__")
    got = docs
    for number, model in enumerate(models):
        found = _judged(docs.sparkSession.sparkContext.broadcast(model), F.col(f"`{text}`"))
        if number == 0:
            got = got.withColumn(own, found)
            continue
        more = free_name(got, "lang__more")
        got = materialize(got, "languages").withColumn(more, found)
        a, b = F.col(own), F.col(more)
        least = F.least(a["bits"], b["bits"])
        far = [x["total"] * F.pow(F.lit(2.0), F.greatest(least - x["bits"], F.lit(-1000.0))) for x in (a, b)]
        # Of equal lengths the first name, as within a part.
        both = F.struct(F.when(a["bits"] <= b["bits"], a["name"]).otherwise(b["name"]).alias("name"), least.alias("bits"), (far[0] + far[1]).alias("total"))
        got = got.withColumn(own, F.when(a["name"].isNull(), b).when(b["name"].isNull(), a).otherwise(both)).drop(more)
    won = F.col(own)
    return got.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(won["name"], F.lit("und")).alias(free_name(docs, "lang_pred")),
        F.when(won["name"].isNull(), 0.0).otherwise(1 / won["total"]).alias(free_name(docs, "lang_score")),
    )


def held_out(key: str, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def op9_language(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id", 4, 2))
    model = fit(docs.filter(~F.col("held_out")))
    return predict(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score")
    )
