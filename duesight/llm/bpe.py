"""Byte-level BPE by forced-boundary splitting, and its decoder.

A pair of bytes that stands side by side inside no vocabulary token can never be merged across,
so a cut between the two is certain. Texts are cut there first; the fragments (mostly words)
are encoded independently, once for every distinct fragment a worker remembers, and their ids are
concatenated. Within one piece of a fragment the vocabulary's merges are the tokenizers library's.

The vocabulary's own pre-splitting pattern must give the same pieces for a fragment as it gives
inside the whole text. It looks at its surroundings in two places only, so a certain cut is used
unless it follows white space (a run of white space gives its last one away by what follows) or
precedes an apostrophe (contractions) or lies inside a character. Special tokens are split off
before anything else and are not cut.

Null text is an empty text: no ids. Bytes always round-trip; very long texts are processed in
one pass over their bytes, and the fragment cache is bounded.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import documents

#: Fragments a worker remembers.
CACHE_ENTRIES = 200_000
#: Longer ones are encoded anew.
LONGEST_KEY = 64
# Byte-level alphabet (printable bytes stand for themselves) and split pattern.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = re.compile(r"\s")


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte."""
    others = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class Bounded(dict):
    """A cache in two generations: when the younger is full, what it holds becomes the elder, and
    of the elder only what is asked for again lives on. Long keys are not remembered."""

    def __init__(self, compute, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.elder = compute, entries, {}

    def __missing__(self, key):
        if len(key) > LONGEST_KEY:
            return self.compute(key)
        value = self.elder.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.entries // 2:
            self.elder = dict(self)
            self.clear()
        self[key] = value
        return value


def _certain_cuts(tokens) -> np.ndarray:
    """For every pair of bytes: can a text be cut between them?"""
    cut = np.ones((256, 256), bool)
    for token in tokens:
        for a, b in zip(token, token[1:]):
            cut[a, b] = False
    cut[:, 0x80:0xC0] = False  # inside a character
    cut[:, ord("'")] = False
    # White space: the ASCII ones, and every byte that may end another one.
    ends = {chr(c).encode()[-1] for c in range(0x3001) if _SPACE.match(chr(c))}
    cut[sorted(ends), :] = False
    return cut.reshape(-1)


class ForcedBoundaryBpe:
    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        spec, to_byte = json.loads(library.to_str()), byte_alphabet()
        self.model = library.model  # merges the bytes of one piece
        self.letters = {b: c for c, b in to_byte.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = lambda token: bytes(to_byte[c] for c in token)
        ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.special = special
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for token, i in ids.items():
            self.tokens[i] = token
        for text, i in special.items():
            self.tokens[i] = text.encode()
        self.cut = _certain_cuts(ids)
        self.pattern = regex.compile(_PATTERN)
        self.fragments = Bounded(self._encode_fragment)

    def _encode_fragment(self, fragment: bytes) -> tuple[bytes, str]:
        ids: list[int] = []
        for piece in self.pattern.findall(fragment.decode()):
            ids += [token.id for token in self.model.tokenize("".join(map(self.letters.__getitem__, piece.encode())))]
        return np.array(ids, np.uint32).tobytes(), ",".join(map(str, ids))

    def _ordinary(self, text: str) -> list[tuple[bytes, str]]:
        data = text.encode("utf-8", "replace")
        codes = np.frombuffer(data, np.uint8).astype(np.uint16)
        at = (np.flatnonzero(self.cut[codes[:-1] << 8 | codes[1:]]) + 1).tolist()
        pieces = map(data.__getitem__, map(slice, [0, *at], [*at, len(data)]))
        return list(map(self.fragments.__getitem__, pieces))

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids as an array, and as decimal numbers joined by commas."""
        parts, at = [], 0
        for m in self.special_pattern.finditer(text) if self.special_pattern else ():
            parts += self._ordinary(text[at : m.start()]) if m.start() > at else []
            i = self.special[m[0]]
            parts.append((np.array([i], np.uint32).tobytes(), str(i)))
            at = m.end()
        parts += self._ordinary(text[at:]) if at < len(text) else []
        return np.frombuffer(b"".join([p[0] for p in parts]), np.uint32), ",".join([p[1] for p in parts])

    def decode(self, ids) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ForcedBoundaryBpe:
    """One for each worker process and vocabulary file."""
    return ForcedBoundaryBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every text as ``array<int>``; all columns are kept."""

    @F.pandas_udf("array<int>")
    def run(column: pd.Series) -> pd.Series:
        t = tokenizer(path)
        return pd.Series([t.encode(x or "")[0].astype(np.int32) for x in column], dtype=object)

    return docs.withColumn(ids, run(text))


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of every array of ids (null: empty)."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        t = tokenizer(path)
        return pd.Series([t.decode(x.tolist() if x is not None else []) for x in column], dtype=object)

    return rows.withColumn(text, run(ids))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass; adds ``bpe_n``, ``bpe_ids_sha256`` and
    ``bpe_decoded_sha256``. Ids never leave the task, so nothing larger than the text moves."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()

    @F.pandas_udf("n long, ids string, decoded string")
    def run(column: pd.Series) -> pd.DataFrame:
        t, rows = tokenizer(path), []
        for value in column:
            ids, listed = t.encode(value or "")
            rows.append((len(ids), sha(listed), sha(t.decode(ids.tolist()))))
        return pd.DataFrame(rows, columns=["n", "ids", "decoded"])

    got = docs.withColumn("bpe__", run(text))
    return got.withColumns(
        {"bpe_n": F.col("bpe__.n"), "bpe_ids_sha256": F.col("bpe__.ids"), "bpe_decoded_sha256": F.col("bpe__.decoded")}
    ).drop("bpe__")


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = round_trip(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return got.select(
        "doc_id",
        F.col("bpe_n").alias("n_tokens"),
        F.col("bpe_ids_sha256").alias("ids_sha256"),
        F.col("bpe_decoded_sha256").alias("decoded_sha256"),
    )
