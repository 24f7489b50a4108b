"""Information-theoretic sanitisation of personal data.

Base spans are found by pattern. Then the corpus decides which other terms give a protected
entity away: every term's occurrences are counted overall and inside the windows around
entities of each kind. A term's disclosure is its pointwise mutual information with "an entity
of this kind is near", as a share of that event's own information content (1: the term occurs
nowhere else). Terms above the removal threshold are removed, those above the generalisation
threshold are generalised to their first letters: everywhere, also far from any entity and in
documents without one, where they still give it away. Only places inside a base span are left to it.

Statistics cover all documents and are joined by term, never broadcast. What tasks get of the
terms is a bit filter of fixed size, which keeps terms that can't matter out of the join.

Null or empty text: no spans, zero counts. Repeated rows are reported once each. An empty
table gives an empty result. Extra columns are kept by ``find``; its own are
``pii_*``, with underscores behind a name that an input column has.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents, free_name, parse_spans, partial_counts, replace_spans, spans_text

# Span kinds in order, and their patterns.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "generalise", "remove"]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't begin inside a run of digits that a match could have begun with.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]+")
_BITS = 23  # of the filter of terms, 1 MB
_KNOWN = 200_000  # answers of the filter that a task remembers
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


@dataclass(frozen=True)
class PiiParams:
    window: int = 8  # words on each side of an entity
    reach: int = 160  # code points on each side within which these words lie
    support: int = 20  # occurrences near entities below which nothing is concluded
    generalise_at: float = 0.75  # share of the information content
    remove_at: float = 0.9
    stem: int = 3  # letters that a generalised term keeps


def _luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(_DOUBLED[v] for v in values[1::2])) % 10 == 0


def _emails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end(), "email"
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdecimal() for c in m[0]) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return spans


def untouched(spans: list[tuple[int, int, str]]) -> Callable[[int, int], bool]:
    """Tells whether a place ``(start, end)`` touches none of the spans, by bisection."""
    spans = sorted(spans)
    starts, reached = [s for s, _, _ in spans], list(accumulate((e for _, e, _ in spans), max))

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)  # spans that start in front of the place's end
        return not before or reached[before - 1] <= start

    return free


def context_terms(text: str, spans: list[tuple[int, int, str]], p: PiiParams) -> list[tuple[str, int, int, str]]:
    """Terms in the windows around the spans, each place once for each kind; none inside a span."""
    found, free = {}, untouched(spans)
    for start, end, kind in spans:
        lo, hi = max(0, start - p.reach), min(len(text), end + p.reach)
        before = list(_TERM.finditer(text, lo, start))[-p.window :]
        after = list(_TERM.finditer(text, end, hi))[: p.window]
        for m in [*before, *after]:
            if free(*m.span()):
                found[m.start(), kind] = (m[0].lower(), m.start(), m.end(), kind)
    return list(found.values())


def term_statistics(docs: DataFrame, p: PiiParams = PiiParams(), text: str = "text") -> DataFrame:
    """Occurrences of every term of the corpus: in all, and near entities of each kind."""
    place = {k: i + 1 for i, k in enumerate(BASE_KINDS)}

    def add(counts: dict, value: str) -> None:
        for term in _TERM.findall(value.lower()):
            row = counts.get(term)
            if row is None:
                counts[term] = [1, 0, 0, 0, 0]
            else:
                row[0] += 1
        spans = base_spans(value)
        for term, _, _, kind in context_terms(value, spans, p) if spans else ():
            counts.setdefault(term, [0, 0, 0, 0, 0])[place[kind]] += 1

    return partial_counts(docs, text, add, "term", ["n", *BASE_KINDS])


def disclosing_terms(stats: DataFrame, p: PiiParams = PiiParams()) -> DataFrame:
    """Rows ``(term, disclosure)`` of the terms at or above the generalisation threshold."""
    total = stats.agg(F.struct(*[F.sum(c).cast("double").alias(c) for c in ["n", *BASE_KINDS]])).scalar()
    shares = []
    for kind in BASE_KINDS:
        event = total[kind] / total["n"]
        mutual = F.log2(F.col(kind) / (F.col("n") * event))
        shares.append(F.when(F.col(kind) >= p.support, mutual / -F.log2(event)))
    return (
        stats.filter(F.greatest(*BASE_KINDS) >= p.support)
        .select("term", F.least(F.lit(1.0), F.greatest(*shares, F.lit(0.0))).alias("disclosure"))
        .filter(F.col("disclosure") >= p.generalise_at)
    )


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bits by CRC-32 of ``terms.term``, as words of 32: at most 2^18 rows however many terms."""
    slot = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(1 << _BITS))
    bit = F.expr("shiftleft(1L, cast(pmod(slot, 32) as int))")
    words = terms.select(slot.alias("slot")).select(F.shiftright("slot", 5).alias("w"), bit.alias("bit"))
    rows = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()
    held = np.zeros(1 << (_BITS - 5), np.uint32)
    held[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return held


def places(text: str, spans: list[tuple[int, int, str]], may: set[str]) -> dict[str, list[tuple[int, int]]]:
    """All places of the terms in ``may`` that touch no span."""
    found, free = {}, untouched(spans)
    for m in _TERM.finditer(text):
        term = m[0].lower()
        if term in may and free(*m.span()):
            found.setdefault(term, []).append(m.span())
    return found


def find(docs: DataFrame, p: PiiParams = PiiParams(), text: str = "text") -> DataFrame:
    """Add ``pii_base`` and ``pii_spans`` (span texts) and a count for each kind to every row."""
    # Written once: the totals and the terms are both read from it.
    stats = materialize(term_statistics(docs, p, text), "pii-terms")
    disclosing = materialize(disclosing_terms(stats, p), "pii-disclosing")
    held = docs.sparkSession.sparkContext.broadcast(term_filter(disclosing))
    disclosing = disclosing.withColumnRenamed("term", "pii__term")
    schema = "base string, terms array<struct<term:string,at:array<struct<start:int,end:int>>>>, " + ", ".join(
        f"n_{k} long" for k in BASE_KINDS
    )
    known: dict = {}

    def may_disclose(word: str) -> bool:
        answer = known.get(word)
        if answer is None:
            slot = zlib.crc32(word.lower().encode()) & ((1 << _BITS) - 1)
            if len(known) >= _KNOWN:
                known.clear()
            answer = known[word] = bool(int(held.value[slot >> 5]) >> (slot & 31) & 1)
        return answer

    @F.pandas_udf(schema)
    def scan(column: pd.Series) -> pd.DataFrame:
        rows = []
        for value in column:
            spans = base_spans(value) if value else []
            may = {w.lower() for w in set(_TERM.findall(value)) if may_disclose(w)} if value else ()
            terms = places(value, spans, may) if may else {}
            rows.append(
                (
                    spans_text(spans, BASE_KINDS),
                    [{"term": t, "at": [{"start": s, "end": e} for s, e in at]} for t, at in terms.items()],
                    *[sum(x[2] == k for x in spans) for k in BASE_KINDS],
                )
            )
        return pd.DataFrame(rows, columns=["base", "terms", *[f"n_{k}" for k in BASE_KINDS]])

    # Only keys and findings go through the shuffles; the text stays out. The other columns travel
    # inside a struct, so that no name of theirs meets one of these.
    keys = [c for c in docs.columns if c != text]
    doc = F.struct(*[F.col(f"`{c}`") for c in keys]) if keys else F.struct(F.lit(0).alias("none"))
    scanned = docs.select(doc.alias("doc"), scan(F.col(f"`{text}`")).alias("found"), F.monotonically_increasing_id().alias("row"))
    # A row for each distinct term of a document, with all its places.
    found = scanned.select("doc", "row", "found", F.explode_outer("found.terms").alias("at"))
    found = found.withColumn("found", F.col("found").dropFields("terms"))
    # Rows without terms get keys of their own, so that they don't meet in one task.
    own = F.coalesce(F.col("at.term"), F.concat(F.lit("#"), F.col("row").cast("string")))
    joined = found.withColumn("pii__term", own).join(disclosing, "pii__term", "left")
    kind = F.when(F.col("disclosure") >= p.remove_at, "remove").otherwise("generalise")
    place = F.struct(F.col("at.at").alias("at"), kind.alias("kind"))
    grouped = joined.groupBy("row").agg(
        F.first("doc").alias("doc"),
        F.first("found").alias("found"),
        F.collect_list(F.when(F.col("disclosure").isNotNull(), place)).alias("more"),
    )

    @F.pandas_udf("string")
    def merged(base: pd.Series, more: pd.Series) -> pd.Series:
        return pd.Series(
            [
                spans_text([*parse_spans(b), *[(int(y["start"]), int(y["end"]), x["kind"]) for x in m for y in x["at"]]], KINDS)
                for b, m in zip(base, more)
            ],
            dtype=object,
        )

    return grouped.select(
        *[F.col(f"doc.`{c}`").alias(c) for c in keys],
        *[F.col(f"found.n_{k}").alias(free_name(docs, f"pii_n_{k}")) for k in BASE_KINDS],
        F.col("found.base").alias(free_name(docs, "pii_base")),
        merged(F.col("found.base"), F.col("more")).alias(free_name(docs, "pii_spans")),
    )


def sanitised_text(text: str | None, spans: str | None, p: PiiParams = PiiParams()) -> str | None:
    """The text with its spans replaced: base ones by their kind, terms generalised or removed."""
    if not text or not spans:
        return text

    def substitute(kind: str, value: str) -> str:
        if kind == "generalise":
            return value[: p.stem] + "*"
        return "" if kind == "remove" else f"<{kind}>"

    return replace_spans(text, parse_spans(spans), substitute)


def sanitise(docs: DataFrame, key: str, p: PiiParams = PiiParams(), text: str = "text") -> DataFrame:
    """``docs`` with sanitised texts; ``key`` is unique per row."""
    apply = F.pandas_udf(
        lambda t, s: pd.Series([sanitised_text(a, b, p) for a, b in zip(t, s)], dtype=object), "string"
    )
    own, bare = free_name(docs, "pii_spans"), docs.select(key, text)
    spans = find(bare, p, text).select(key, F.col(free_name(bare, "pii_spans")).alias(own))
    return docs.join(spans, key).withColumn(text, apply(text, own)).drop(own)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.col(f"pii_n_{k}").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.col("pii_base").cast("binary"), 256).alias("base_sha256"),
        F.col("pii_spans").alias("spans"),
    )


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(spans_text(spans, BASE_KINDS).encode()).hexdigest()
