"""Secret scan by dictionary-primed compression novelty.

Base spans are found by pattern. Beyond them, a string that stands in a sensitive context is
measured: how many bytes does zstandard need for its first occurrence when it has already seen the
text in front of it and a dictionary of the corpus's own frequent identifiers? Words and identifiers
cost little; keys and passwords cost nearly their whole entropy and are reported wherever they stand
in the text. As short rare words cost as much, a value must also change between small letters,
capitals and digits ``switches`` times; one of small letters alone is never reported. A value that base spans cover in part is reported whole.

The identifier dictionary is a top-k report over all distinct texts: its size is a parameter. An
identifier counts once a text, so copies of a document teach it nothing, and neither values in a
sensitive context nor identifiers that look random are counted.

Null or empty text: no spans. Repeated rows are reported once each, an empty table gives an
empty result, extra columns are kept; own columns are ``secret_*``, with underscores behind a name
that an input column has.
"""

from __future__ import annotations

import functools
import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents, free_name, parse_spans, partial_counts, replace_spans, spans_text
from .graph import flagged

# Span kinds in order, and their patterns.
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "novel"]
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_SENSITIVE = re.compile(
    r"(?:passw(?:or)?d|passphrase|secret|token|api[_-]?key|credential|private[_-]?key|access[_-]?key|bearer|authorization)",
    re.A | re.I,
)
_HINTS = ("pass", "secret", "token", "api", "credential", "key", "bearer", "authorization")
_VALUE = re.compile(r"[A-Za-z0-9+/_=$!#%.~-]+")
_DIGIT_SWITCH = re.compile(r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")
_SWITCH = re.compile(r"[a-z](?=[A-Z0-9])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])|[A-Z](?=[a-z])")
_END = re.compile(r"[\n;]|[.!?](?=\s)")  # of a statement


@dataclass(frozen=True)
class SecretParams:
    shortest: int = 10  # characters of a candidate
    context: int = 256  # characters of text in front of the candidate
    novelty: float = 0.62  # marginal bytes for each byte of the candidate
    switches: int = 3  # changes between small letters, capitals and digits; words have fewer
    identifiers: int = 8192  # most frequent corpus terms in the dictionary
    level: int = 3


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        spans += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return spans


@functools.lru_cache(maxsize=4)
def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
    return zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False)


def marginal_bytes(candidate: str, context: str, dictionary: bytes, level: int = 3) -> int:
    """Bytes that ``candidate`` adds to the compressed size of its context."""
    c, around = _compressor(dictionary, level), context.encode()
    return len(c.compress(around + b" " + candidate.encode())) - len(c.compress(around))


def candidates(text: str, p: SecretParams) -> list[tuple[int, int]]:
    """Places of values that begin behind a sensitive word in its statement, each once; where a value
    holds sensitive words itself, also what stands behind the last of them. One pass over the text."""
    low = text.lower()
    if not any(w in low for w in _HINTS):
        return []
    words = [m.end() for m in _SENSITIVE.finditer(text)]
    found, until = {}, 0
    for word in words:
        if word < until:
            continue
        stop = _END.search(text, word)
        until = stop.start() if stop else len(text)
        for m in _VALUE.finditer(text, word, until):
            start, end = _VALUE.match(text, m.start()).span()  # it may run on behind the statement
            until = max(until, end)
            inside = words[bisect_right(words, end) - 1]
            for at in (start, max(start, inside)):
                if end - at >= p.shortest:
                    found[at, end] = True
    return list(found)


def _covering(base: list[tuple[int, int, str]]) -> Callable[[int, int], bool]:
    """Tells whether base spans leave nothing of a place, by bisection in their union."""
    starts, ends = [], []
    for start, end, _ in sorted(base):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def covered(start: int, end: int) -> bool:
        at = bisect_right(starts, start) - 1
        return at >= 0 and ends[at] >= end

    return covered


def novel_spans(text: str, base: list[tuple[int, int, str]], dictionary: bytes, p: SecretParams) -> list[tuple[int, int, str]]:
    found, judged, covered = {}, {}, _covering(base)
    for start, end in candidates(text, p):
        value = text[start:end]
        if value in judged or covered(start, end):
            continue
        # The first occurrence is the one that is new to the text.
        at = text.find(value)
        cost = marginal_bytes(value, text[max(0, at - p.context) : at], dictionary, p.level)
        judged[value] = cost >= p.novelty * (end - start) and len(_SWITCH.findall(value)) >= p.switches
        while judged[value] and at >= 0:
            if not covered(at, at + len(value)):
                found[at, at + len(value)] = (at, at + len(value), "novel")
            at = text.find(value, at + len(value))
    return list(found.values())


_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,31}(?![A-Za-z0-9_])")


def _random(term: str, p: SecretParams) -> bool:
    return len(term) >= p.shortest and len(_DIGIT_SWITCH.findall(term)) >= 3


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every text once. Only texts whose hash occurs more than once are shuffled."""
    hashed = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("h")).filter("text is not null")
    repeated = materialize(hashed.groupBy("h").count().filter("count > 1").select("h"), "text-copies")
    split = flagged(hashed, "h", repeated, "h")
    return split.filter("not may__hold").select("text").union(split.filter("may__hold").select("text").dropDuplicates())


def identifier_dictionary(docs: DataFrame, p: SecretParams = SecretParams(), text: str = "text") -> bytes:
    """Identifiers that stand in most distinct texts; the most frequent stand last, where zstandard
    reaches them with the shortest offsets. At most ``identifiers`` * 33 bytes."""

    def add(counts: dict, value: str) -> None:
        # Values behind sensitive words are blotted out.
        at, kept = 0, []
        for start, end in sorted(candidates(value, p)):
            kept.append(value[at:start])
            at = max(at, end)
        for term in set(_IDENTIFIER.findall(" ".join([*kept, value[at:]]))):
            row = counts.get(term)
            if row is not None:
                row[0] += 1
            elif not _random(term, p):
                counts[term] = [1]

    counted = partial_counts(distinct_texts(docs, text), "text", add, "term", ["n"])
    # Numbered hapaxes (keys look like identifiers, too) never enter: a term must recur.
    top = counted.filter("n > 2").orderBy(F.desc("n"), "term").limit(p.identifiers).collect()
    return " ".join(r["term"] for r in reversed(top)).encode()


def find(docs: DataFrame, p: SecretParams = SecretParams(), text: str = "text") -> DataFrame:
    """Add ``secret_base``, ``secret_spans`` and a count for each base kind to every row."""
    known = docs.sparkSession.sparkContext.broadcast(identifier_dictionary(docs, p, text))

    @F.pandas_udf("base string, spans string, " + ", ".join(f"n_{k} long" for k in BASE_KINDS))
    def scan(column: pd.Series) -> pd.DataFrame:
        rows = []
        for value in column:
            base = base_spans(value) if value else []
            more = novel_spans(value, base, known.value, p) if value else []
            counts = [sum(x[2] == k for x in base) for k in BASE_KINDS]
            rows.append((spans_text(base, BASE_KINDS), spans_text([*base, *more], KINDS), *counts))
        return pd.DataFrame(rows, columns=["base", "spans", *[f"n_{k}" for k in BASE_KINDS]])

    own = free_name(docs, "secret__")
    got = docs.withColumn(own, scan(text))
    return got.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"{own}.n_{k}").alias(free_name(docs, f"secret_n_{k}")) for k in BASE_KINDS],
        F.col(f"{own}.base").alias(free_name(docs, "secret_base")),
        F.col(f"{own}.spans").alias(free_name(docs, "secret_spans")),
    )


def redacted_text(text: str | None, spans: str | None) -> str | None:
    if not text or not spans:
        return text
    return replace_spans(text, parse_spans(spans), lambda kind, value: f"<secret:{kind}>")


def redact(docs: DataFrame, p: SecretParams = SecretParams(), text: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by its kind; all rows stay."""
    apply = F.pandas_udf(
        lambda t, s: pd.Series([redacted_text(a, b) for a, b in zip(t, s)], dtype=object), "string"
    )
    found = find(docs, p, text).withColumn(text, apply(text, free_name(docs, "secret_spans")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.col(f"secret_n_{k}").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.col("secret_base").cast("binary"), 256).alias("base_sha256"),
        F.col("secret_spans").alias("spans"),
    )


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(spans_text(spans, BASE_KINDS).encode()).hexdigest()
