"""Sum-of-squares packing of token sequences.

Documents become ids plus an end mark; only those longer than a sequence are cut. Each piece is
then placed where the sum of the squared counts of open sequences, by residual gap, becomes
smallest (Csirik, Johnson, Kenyon, Orlin, Shor, Weber: On the sum-of-squares algorithm for bin
packing): a gap that many open sequences share is used up before rare ones are made.

The work is spread evenly, without a key, over groups of ``group_pieces`` pieces; every group
packs its own sequences. A group leaves a handful of sequences partly filled out of thousands,
and its memory depends on the sequence length, not on the corpus.

Null or empty text: the end mark alone. Repeated rows are pieces of their own. An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import materialize
from .bpe import Bounded, byte_alphabet
from .common import documents

#: Pieces that one task packs.
GROUP_PIECES = 100_000
#: Pieces a worker remembers (about 200 bytes each).
PIECES = 800_000
#: Characters of a text that are split at a time.
STRETCH = 1 << 20
# White space of the vocabulary's normaliser, and its split pattern.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^%s\p{L}\p{N}]+" % _SPACES
_ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"


class WordBpe:
    """BPE with word ends. Merges never leave a piece of the split pattern, so every distinct
    lower-case piece is merged once for each worker (as far as the bounded cache reaches)."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        self.model = library.model  # merges the bytes of one piece
        special = [t["content"] for t in json.loads(library.to_str())["added_tokens"]]
        self.special = {t: np.array([library.token_to_id(t)], "<u4").tobytes() for t in special}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.letters = {b: c for c, b in byte_alphabet().items()}
        self.blank = re.compile(f"[{_SPACES}]")
        self.ascii, self.any = re.compile(_ASCII_PATTERN), regex.compile(_PATTERN)
        self.pieces = Bounded(self._piece, entries=PIECES)

    def _piece(self, piece: str) -> bytes:
        data = piece if piece.isalpha() and piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [token.id for token in self.model.tokenize(data)]).tobytes()

    def _ordinary(self, text: str) -> bytes:
        if text.isascii():
            found = self.ascii.findall(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # One character at a time, as the vocabulary's normaliser does it: only the capital
            # sigma looks at its neighbours in str.lower.
            text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()
            found = self.any.findall(text)
        return b"".join(map(self.pieces.__getitem__, found))

    def _stretches(self, text: str) -> Iterator[str]:
        """A very long text is cut at white space, which no piece crosses."""
        at = 0
        while len(text) - at > STRETCH and (cut := self.blank.search(text, at + STRETCH)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for part in self.special_pattern.split(text) if self.special_pattern else [text]:
            parts += [self.special[part]] if part in self.special else map(self._ordinary, self._stretches(part))
        return np.frombuffer(b"".join(parts), "<u4")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def pieces(docs: DataFrame, path: str, length: int = 2048, end: int = 0, text: str = "text") -> DataFrame:
    """One row for each piece of each document: ``piece start length ids_crc32`` beside the
    other columns of ``docs``."""

    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def run(column: pd.Series) -> pd.Series:
        t, rows = tokenizer(path), []
        for value in column:
            ids = np.append(t.encode(value or ""), np.array([end], "<u4")).astype("<u4")
            cuts = range(0, len(ids), length)
            rows.append(
                [
                    {"piece": i, "start": s, "length": len(part), "ids_crc32": zlib.crc32(part.tobytes())}
                    for i, s in enumerate(cuts)
                    for part in [ids[s : s + length]]
                ]
            )
        return pd.Series(rows, dtype=object)

    others = [c for c in docs.columns if c != text]
    return docs.select(*[F.col(f"`{c}`") for c in others], F.explode(run(text)).alias("pack__")).select(
        *[F.col(f"`{c}`") for c in others], "pack__.*"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for every length, in the given order of arrival."""
    open_count = np.zeros(capacity + 1, np.int64)  # open sequences by gap; those without gap don't count
    stacks: dict[int, list[int]] = defaultdict(list)
    fill: list[int] = []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        # Change of the sum of squares when a gap g becomes g - size: 2 * (n[g - size] - n[g] + 1), and
        # 1 - 2 * n[g] when it closes; a new sequence makes one of gap capacity - size.
        change = 2 * (open_count[: capacity - size + 1] - open_count[size:] + 1)
        change[0] = 1 - 2 * open_count[size]
        change[capacity - size] = 2 * open_count[capacity - size] + 1 if size < capacity else 0
        usable = open_count[size:] > 0
        usable[capacity - size] = True
        # Of equal changes the smallest gap.
        left = int(np.where(usable, change, np.iinfo(np.int64).max).argmin())
        gap = left + size
        if gap == capacity:
            at = len(fill)
            fill.append(0)
        else:
            at = stacks[gap].pop()
            open_count[gap] -= 1
        sequence[i], offset[i] = at, fill[at]
        fill[at] += size
        if left:
            stacks[left].append(at)
            open_count[left] += 1
    return sequence, offset


def pack(rows: DataFrame, length: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length``. Within a group long pieces
    come first, so the short ones are left to close gaps."""
    stored = materialize(rows, "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    schema = stored.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = list(batches)
        if not group:
            return
        frame = pd.concat(group, ignore_index=True)
        frame = frame.iloc[np.argsort(-frame["length"].to_numpy(), kind="stable")].reset_index(drop=True)
        frame["sequence_id"], frame["offset"] = sum_of_squares(frame["length"].to_numpy(np.int64), length)
        frame["sequence_id"] += TaskContext.get().partitionId() << 32
        yield frame

    return stored.repartition(groups).mapInPandas(run, schema + ",sequence_id:bigint,offset:bigint")


def pack_documents(docs: DataFrame, path: str, length: int = 2048) -> DataFrame:
    return pack(pieces(docs.select("doc_id", "text"), path, length), length)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
