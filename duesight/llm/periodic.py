"""Periodic runs of words, found by multi-scale minimizers, and their removal.

A run is a stretch of words that repeats with a smallest period ``q``, at least twice and over at
least ``shortest`` words, and that no neighbouring word extends. All runs of every text are found:

* Periods up to ``DIRECT`` are scanned lag by lag.
* For every scale ``P`` (doubling), periods in (P, 2P] come from minimizers of windows over word
  sequences of length k = P / 2. A window at the start of a run and the one a period later hold the
  same words, so their leftmost minimizers are equal and a period apart: equal minimizers at a
  distance in (P, 2P] are the seeds, which are extended to both sides word by word.
* Sequences with a period of at most k / 2 would repeat too often; they lie inside runs that smaller
  scales have found and are no minimizers. Then equal minimizers lie over k / 2 apart and there are
  at most eight partners for each. A longer run that holds no other sequence in its first period
  spans two adjoining short runs of one root; those pairs give its periods by arithmetic.

Texts are handled in blocks of about ``BLOCK`` words, whole texts joined by marks that occur once,
so that no run crosses them. Hashes only choose seeds; extensions compare words, so results are exact.

Words are maximal stretches without ASCII white space. Null and empty texts, and texts without
words, have no runs and an empty collapsed text. Repeated rows get equal results each. An empty
table gives an empty table. A text longer than a block is a block of its own. The new column takes
a free name if the input has one of the name asked for (``common.free_name``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, free_name

SHORTEST = 12
DIRECT = 24  # at least twice the shortest run, so that a sequence of k words with a short period is in a run
BLOCK = 200_000
_TYPE = "struct<runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0xD6E8FEB86659FD93) + right)


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width`` values, by windows of doubling width."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every stretch of true values."""
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


class Block:
    """The runs of one block: word numbers ``ids``, with marks (negative, each occurring once)
    between texts; ``text_of`` numbers the text of every place."""

    def __init__(self, ids: np.ndarray, text_of: np.ndarray, longest: int, shortest: int = SHORTEST, direct: int = DIRECT):
        self.ids, self.text_of, self.longest, self.shortest, self.direct = ids, text_of, longest, shortest, direct
        self.found: list[np.ndarray] = []  # rows (start, end, period)

    def runs(self) -> np.ndarray:
        """Rows (start, end, period) by start, then period."""
        for lag in range(1, min(self.direct, self.longest // 2) + 1):
            start, end = _stretches(self.ids[:-lag] == self.ids[lag:])
            self._keep(start, end + lag, np.full(len(start), lag))
        self._scales()
        rows = self._distinct()
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def _keep(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        held = end - start >= np.maximum(self.shortest, 2 * period)
        if held.any():
            self.found.append(np.stack([start[held], end[held], period[held]], axis=1))

    def _distinct(self) -> np.ndarray:
        """Of the periods of one stretch the smallest: it divides the others."""
        rows = np.concatenate(self.found) if self.found else np.zeros((0, 3), np.int64)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        return rows[first]

    def _scales(self) -> None:
        scale = self.direct
        if self.longest < 2 * (scale + 1):
            return
        half = _mixed(self.ids.astype(np.uint64))  # hashes of sequences of k words; k doubles with the scale
        k = 1
        while k < scale // 2:
            step = min(k, scale // 2 - k)
            half = _joined(half[: len(half) - step], half[step:])
            k += step
        while self.longest >= 2 * (scale + 1):
            self._scale(scale, k, half)
            self._adjoining(scale, k)
            scale *= 2
            half = _joined(half[: max(len(half) - k, 0)], half[k:])
            k *= 2

    def _scale(self, scale: int, k: int, hashes: np.ndarray) -> None:
        if len(hashes) == 0:
            return
        bits = np.uint64(max(int(len(hashes)).bit_length(), 1))
        value = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
        # Sequences inside a known run of at most half their length are no minimizers.
        change = np.zeros(len(hashes) + 1, np.int64)
        for rows in self.found:
            held = rows[(2 * rows[:, 2] <= k) & (rows[:, 1] - rows[:, 0] >= k)]
            np.add.at(change, held[:, 0], 1)
            np.add.at(change, held[:, 1] - k + 1, -1)
        value[np.cumsum(change[:-1]) > 0] = _NONE
        width = scale - k + 2
        if len(value) < width:
            return
        least = _window_least(value, width)
        least = least[least != _NONE]
        if len(least) == 0:
            return
        at = np.unique(least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        key = hashes[at]
        order = np.lexsort((at, key))
        at, key = at[order], key[order]
        seeds, step = [], 1
        while step < len(at):
            lag = at[step:] - at[:-step]
            met = (key[step:] == key[:-step]) & (lag <= 2 * scale)
            if not met.any():
                break
            met &= (lag > scale) & (self.text_of[at[step:]] == self.text_of[at[:-step]])
            seeds.append(np.stack([at[:-step][met], lag[met]], axis=1))
            step += 1
        if seeds:
            self._extend(np.concatenate(seeds))

    def _extend(self, seeds: np.ndarray) -> None:
        """Extend seeds (place, lag) to whole stretches. Of the seeds of one text and lag the first
        is extended, those inside its stretch are done with it, and the rest go on."""
        text = self.text_of[seeds[:, 0]]
        order = np.lexsort((seeds[:, 0], seeds[:, 1], text))
        seeds, text = seeds[order], text[order]
        while len(seeds):
            group = np.ones(len(seeds), bool)
            group[1:] = (text[1:] != text[:-1]) | (seeds[1:, 1] != seeds[:-1, 1])
            number = np.cumsum(group) - 1
            place, lag = seeds[group, 0], seeds[group, 1]
            end = place + self._same(place, lag, 1)
            start = place - self._same(place - 1, lag, -1)
            self._keep(start, end + lag, lag)
            left = seeds[:, 0] >= np.maximum(end, place + 1)[number]
            seeds, text = seeds[left], text[left]

    def _same(self, place: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``place`` on, upwards or downwards, equal those a lag later."""
        ids, top = self.ids, len(self.ids) - 1
        count = np.zeros(len(place), np.int64)
        active, width = np.arange(len(place)), 8
        while len(active):
            reach = np.arange(width) * step
            a = (place[active] + count[active] * step)[:, None] + reach
            b = a + lag[active][:, None]
            same = (a >= 0) & (b <= top)
            same &= ids[np.clip(a, 0, top)] == ids[np.clip(b, 0, top)]
            n = np.where(same.all(axis=1), width, same.argmin(axis=1))
            count[active] += n
            active = active[n == width]
            width = min(width * 2, max(8, 4_000_000 // max(len(active), 1)), 65_536)
        return count

    def _adjoining(self, scale: int, k: int) -> None:
        """Runs of this scale of which each half lies in one of two adjoining runs of the same root."""
        rows = self._distinct()
        rows = rows[(rows[:, 1] - rows[:, 0] > scale) & (2 * rows[:, 2] <= k)]
        rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
        one, two = rows[:-1], rows[1:]
        met = (one[:, 2] == two[:, 2]) & (two[:, 0] <= one[:, 1]) & (one[:, 1] - two[:, 0] < one[:, 2])
        for (a1, b1, p), (a2, b2, _) in zip(one[met].tolist(), two[met].tolist()):
            shift = self._phase(a1, a2, p)
            if shift is None:
                continue
            first = scale + 1 + (a2 - shift - scale - 1) % p
            lag = np.arange(first, min(b1 - a1, b2 - a2, 2 * scale) + 1, p)
            start, end = np.maximum(a1, a2 - lag), np.minimum(b1, b2 - lag)
            # Only where both ends of the short runs meet can the stretch go on beyond them.
            open_ended = ((a2 - lag == a1) | (b2 - lag == b1)) & (end > start)
            if open_ended.any():
                self._extend(np.stack([start[open_ended], lag[open_ended]], axis=1))
            closed = ~open_ended & (end > start)
            self._keep(start[closed], (end + lag)[closed], lag[closed])

    def _phase(self, a1: int, a2: int, p: int) -> int | None:
        """The place from ``a1`` on, below ``a1 + p``, where the words go on as from ``a2``."""
        places = np.arange(a1, a1 + p)
        for i in range(p):
            places = places[self.ids[places + i] == self.ids[a2 + i]]
            if len(places) == 0:
                return None
        return int(places[0])


def _blocks(texts: pd.Series) -> Iterator[list[list[bytes]]]:
    block, size = [], 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if block and size + len(words) > BLOCK:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield block


def block_runs(texts: list[list], shortest: int = SHORTEST, direct: int = DIRECT) -> list[np.ndarray]:
    """Runs (start, end, period) of every text, a list of words."""
    numbers: dict = {}
    sizes = np.array([len(words) for words in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1  # a mark follows each text
    ids = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for i, (words, at) in enumerate(zip(texts, begins.tolist())):
        ids[at : at + len(words)] = [numbers.setdefault(w, len(numbers)) for w in words]
        ids[at + len(words)] = -1 - i
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    rows = Block(ids, text_of, int(sizes.max(initial=0)), shortest, direct).runs()
    owner = text_of[rows[:, 0]]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [rows[cuts[i] : cuts[i + 1]] - np.array([b, b, 0]) for i, b in enumerate(begins.tolist())]


def _collapsed(words: list[bytes], rows: np.ndarray) -> str:
    """The words outside all runs and those of each run's first period."""
    if len(rows) == 0:
        return b" ".join(words).decode("utf-8", "surrogatepass")
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()]).decode("utf-8", "surrogatepass")


def _found(texts: pd.Series) -> pd.DataFrame:
    runs, collapsed = [], []
    for block in _blocks(texts):
        for words, rows in zip(block, block_runs(block)):
            runs.append([{"start": s, "length": e - s, "period": q} for s, e, q in rows.tolist()])
            collapsed.append(_collapsed(words, rows))
    return pd.DataFrame({"runs": pd.Series(runs, dtype=object), "collapsed": pd.Series(collapsed, dtype=object)})


def find(docs: DataFrame, text: str = "text", out: str = "periodic") -> tuple[DataFrame, str]:
    """``docs`` with a struct of ``runs`` (start, length, period in words; by start, then period)
    and ``collapsed`` (the text's words without repetitions), and that column's name."""
    name = free_name(docs, out)
    return docs.withColumn(name, F.pandas_udf(_found, _TYPE)(F.col(f"`{text}`"))), name


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every run cut down to its first period; texts without runs stay as they are."""
    found, name = find(docs, text)
    changed = F.when(F.size(f"{name}.runs") > 0, F.col(f"{name}.collapsed")).otherwise(F.col(f"`{text}`"))
    return found.withColumn(text, changed).select(*[F.col(f"`{c}`") for c in docs.columns])


def with_planted_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """In documents whose ``crc32(doc_id)`` ends in 0, words from a place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("plant__w"), F.floor(F.col("plant__h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - F.col("plant__a")) / (3 + g % 8))).cast("int")
    repeated = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("plant__w", F.when(i < F.col("plant__a"), i).otherwise(F.col("plant__a") + (i - F.col("plant__a")) % F.col("plant__p"))),
    )
    out = docs.withColumn("plant__h", h).withColumn("plant__w", F.when(F.col("plant__h") % 10 == 0, words))
    out = out.withColumn("plant__a", F.when(n > 0, a)).withColumn("plant__p", F.when(n > 0, p))
    planted = F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col(text))
    return out.withColumn(text, planted).drop("plant__h", "plant__w", "plant__a", "plant__p")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(documents(spark, sf_dir).select("doc_id", "text"))
    found, name = find(docs)
    runs = F.col(f"{name}.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    out = found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        longest.alias("best"),
        _sha(listed).alias("runs_sha256"),
        _sha(F.col(f"{name}.collapsed")).alias("collapsed_sha256"),
    )
    period = -F.col("best.q")
    return out.select(
        "doc_id",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.floor(1000 * F.col("best.length") / period).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
