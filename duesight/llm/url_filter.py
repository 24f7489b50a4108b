"""URL lists as Bloom filter cascades, with DataFrame functions only.

A list holds keys ``host + path``; a key fits an url whose host is the key's host or below it and
whose path starts with the key's path. The *key universe* of a corpus is every (host suffix, path
prefix) of its urls that has the shape of a listed key: so many labels, so many slashes, and so many
characters behind the last slash.

Level 1 of a cascade encodes the listed keys, level 2 the keys of the universe that level 1 takes
wrongly for listed, level 3 the listed keys that level 2 takes for wrong, and so on until a level
is wrong about nothing. The first level that denies a key decides: an even one says listed, an odd
one not. So membership is exact for every key of the universe, and judging an url reads a few bits
of constants: no join and no shuffle. Only urls are read to build it, and only keys that level 1
takes for listed are made distinct and compared with the list.

Level 1 is sized so that it is wrong about as many keys as are listed, later ones have an eighth of
errors; all sizes follow from counts. The levels are constants on every executor, at most
``most_bits`` together, as long as the list's shapes number at most ``most_shapes``. A longer list
is looked up by an equi-join on the distinct (host, path) of the urls instead, with equal results.

Hosts are lower-cased in A-Z only. Null urls and those without ``://`` have empty host and path and
fit nothing. Of several keys that fit, the longest wins; a key both blocked and allowed is blocked.
Urls that fit no key are not listed, so they are allowed. Repeated rows get equal results, empty
tables give empty tables, an empty list fits nothing; null keys, and keys without host, are none.
Listed keys that are repeated count once. New columns take free names (``common.free_name``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, table

# The rules of the query, (host and path, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlParams:
    most_bits: int = 1 << 26  # all levels of a list together: 8 MB
    most_shapes: int = 64
    later_error: float = 0.125
    first_error: float | None = None  # of level 1; None: listed keys / keys of the universe


Shape = tuple[int, int, int]  # labels of the host, slashes of the path, characters behind the last


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 2)


def keys_of(listed: DataFrame) -> DataFrame:
    """Distinct ``key labels slashes tail`` of a list's ``key`` column (``host + path``)."""
    host, path = F.substring_index("key", "/", 1), F.expr("substring(key, length(substring_index(key, '/', 1)) + 1)")
    rows = listed.select(F.translate(F.substring_index("key", "/", 1), _UPPER, _LOWER).alias("h"), path.alias("p"), host.alias("raw"))
    rows = rows.filter("raw <> ''").select(F.concat("h", "p").alias("key"), "h", "p").distinct()
    slashes = F.length("p") - F.length(F.replace("p", F.lit("/"), F.lit("")))
    return rows.select(
        "key",
        F.size(F.split("h", r"\.")).alias("labels"),
        slashes.alias("slashes"),
        F.length(F.substring_index("p", "/", -1)).alias("tail"),
    )


def _candidate(host: str, path: str, shape: Shape) -> Column:
    """The url's key of this shape; null if it has none."""
    labels, slashes, tail = shape
    held = F.size(F.split(host, r"\.")) >= labels
    if slashes:
        head = F.concat(F.substring_index(path, "/", slashes), F.lit("/"))
        held &= F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) >= slashes
    else:
        head = F.lit("")
    prefix = F.substr(F.col(path), F.lit(1), F.length(head) + tail)
    held &= (F.length(path) >= F.length(head) + tail) & (F.col(host) != "")
    # Behind the last slash of the key's directory the tail may hold no further one.
    held &= ~F.contains(F.substr(prefix, F.length(head) + 1), F.lit("/"))
    return F.when(held, F.concat(F.substring_index(host, ".", -labels), prefix))


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    probes: int
    words: DataFrame  # one row: the bits as an array of longs

    def holds(self, key: Column) -> Column:
        """May ``key`` be among the encoded keys? Never false for one that is."""
        words = self.words.scalar()
        spots = _spots(key, self.number, self.bits, self.probes)
        tests = [F.getbit(F.get(words, F.shiftright(s, 6).cast("int")), s.bitwiseAND(63).cast("int")) == 1 for s in spots]
        return reduce(lambda a, b: a & b, tests)


def _spots(key: Column, number: int, bits: int, probes: int) -> list[Column]:
    """Bit numbers of a key: arithmetic progressions in two halves of one 64-bit hash."""
    h = F.xxhash64(F.lit(number), key)
    first, step = h.bitwiseAND(0x7FFFFFFF), F.shiftrightunsigned(h, 33).bitwiseOR(1)
    return [(first + i * step) % bits for i in range(probes)]


def encode(keys: DataFrame, number: int, count: int, error: float) -> Level:
    """A Bloom filter of the distinct ``key`` rows, written once. Its bits are set by partial
    aggregation; what one task assembles is the filter itself, of a size fixed by ``count``."""
    probes = max(1, round(log2(1 / error)))
    bits = 64 * ceil(max(count, 1) * probes / log(2) / 64)
    spots = keys.select(F.explode(F.array(*_spots(F.col("key"), number, bits, probes))).alias("s"))
    one = F.expr("shiftleft(1L, cast(s & 63 as int))")
    words = spots.groupBy(F.shiftright("s", 6).alias("i")).agg(F.bit_or(one).alias("w"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
    whole = words.union(blank).groupBy("i").agg(F.bit_or("w").alias("w"))
    row = whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("words"))
    return Level(number, bits, probes, materialize(row, "url-level"))


@dataclass(frozen=True)
class Cascade:
    """Exact membership in a list for the keys of one universe. Without levels it is a list that
    is empty; ``listed`` is set instead where the list is beyond the bounds."""

    levels: tuple[Level, ...]
    shapes: tuple[Shape, ...]
    listed: DataFrame | None = None

    def holds(self, key: Column) -> Column:
        member = F.lit(False)
        for level in reversed(self.levels):
            member = level.holds(key) & (F.lit(True) if level is self.levels[-1] else ~member)
        return member


def build(urls: DataFrame, listed: DataFrame, p: UrlParams = UrlParams(), url: str = "url") -> Cascade:
    """The cascade of the list ``listed(key)`` over the key universe of ``urls``."""
    listed = materialize(keys_of(listed), "url-listed")
    n = listed.count()
    if n == 0:
        return Cascade((), ())
    # One more than allowed tells whether there are too many.
    found = listed.select("labels", "slashes", "tail").distinct().limit(p.most_shapes + 1).collect()
    shapes = tuple(sorted((r.labels, r.slashes, r.tail) for r in found))
    if len(shapes) > p.most_shapes:
        return Cascade((), (), listed)
    host, path = host_and_path(F.col(f"`{url}`"))
    parts = urls.select(host.alias("h"), path.alias("p")).filter("h <> ''")
    universe = parts.select(F.explode(F.array(*[_candidate("h", "p", s) for s in shapes])).alias("key")).filter("key is not null")
    error = p.first_error
    if error is None:
        size = universe.agg(F.approx_count_distinct("key").alias("n")).first().n
        error = min(0.5, n / max(size, 1))
    # Later levels hold an eighth of the keys before them: all together less than as many again.
    if n * (1.5 * log2(1 / error) + 12) > p.most_bits:
        return Cascade((), (), listed)
    levels, inside, outside = [], listed.select("key"), universe
    count = n
    while count:
        level = encode(inside, len(levels) + 1, count, p.later_error if levels else error)
        levels.append(level)
        wrong = outside.filter(level.holds(F.col("key"))).distinct()
        if len(levels) == 1:
            wrong = wrong.join(listed.select("key"), "key", "left_anti")
        inside, outside = materialize(wrong, "url-wrong"), inside
        count = inside.count()
    return Cascade(tuple(levels), shapes)


def _longest(keys: list[Column]) -> Column:
    """Of the given keys (null: not fitting) the longest; equally long ones of an url differ never."""
    sized = [F.when(k.isNotNull(), F.struct(F.length(k).alias("n"), k.alias("key"))) for k in keys]
    return F.array_max(F.array(*sized))["key"] if sized else F.lit(None).cast("string")


def fitting(urls: DataFrame, cascade: Cascade, host: str, path: str, out: str) -> DataFrame:
    """Add the longest listed key that fits, or null, as column ``out``."""
    if cascade.listed is not None:
        return _fitting_by_join(urls, cascade.listed, host, path, out)
    names = [free_name(urls, f"url__key{i}") for i in range(len(cascade.shapes))]
    held = urls.select("*", *[_candidate(host, path, s).alias(k) for s, k in zip(cascade.shapes, names)])
    return held.withColumn(out, _longest([F.when(cascade.holds(F.col(k)), F.col(k)) for k in names])).drop(*names)


def _fitting_by_join(urls: DataFrame, listed: DataFrame, host: str, path: str, out: str) -> DataFrame:
    """The same for lists of any length: each distinct (host, path) looks up its suffixes with its
    prefixes of the lengths (of which there are few) that listed paths have."""
    distinct = urls.select(F.col(host).alias("url__h"), F.col(path).alias("url__p")).filter("url__h <> ''").distinct()
    sizes = listed.select(F.length("key") - F.length(F.substring_index("key", "/", 1))).toDF("n").agg(F.collect_set("n")).scalar()
    suffixes = F.transform(F.sequence(F.lit(1), F.size(F.split("url__h", r"\."))), lambda i: F.call_function("substring_index", "url__h", F.lit("."), -i))
    keys = distinct.withColumn("n", F.explode(sizes)).filter(F.col("n") <= F.length("url__p")).withColumn("s", F.explode(suffixes))
    keys = keys.withColumn("key", F.concat("s", F.substr("url__p", F.lit(1), F.col("n"))))
    best = keys.join(listed.select("key"), "key").groupBy("url__h", "url__p").agg(F.max_by("key", F.length("key")).alias(out))
    joined = urls.join(best, (F.col(host) == F.col("url__h")) & (F.col(path) == F.col("url__p")), "left")
    return joined.drop("url__h", "url__p")


def judge(urls: DataFrame, blocked: DataFrame, allowed: DataFrame, p: UrlParams = UrlParams(), url: str = "url") -> tuple[DataFrame, str]:
    """``urls`` with a struct of ``host path rule verdict``, and that column's name."""
    host, path = host_and_path(F.col(f"`{url}`"))
    h, q = free_name(urls, "url__host"), free_name(urls, "url__path")
    out = urls.withColumn(h, host).withColumn(q, path)
    b, a = free_name(urls, "url__block"), free_name(urls, "url__allow")
    out = fitting(out, build(urls, blocked, p, url), h, q, b)
    out = fitting(out, build(urls, allowed, p, url), h, q, a)
    block = F.col(b).isNotNull() & (F.col(a).isNull() | (F.length(b) >= F.length(a)))
    verdict = F.when(block, "block").otherwise("allow")
    rule = F.when(block, F.col(b)).otherwise(F.col(a))
    name = free_name(urls, "judged")
    packed = F.struct(F.col(h).alias("host"), F.col(q).alias("path"), rule.alias("rule"), verdict.alias("verdict"))
    return out.withColumn(name, packed).drop(h, q, b, a), name


def allowed_only(urls: DataFrame, blocked: DataFrame, allowed: DataFrame, p: UrlParams = UrlParams(), url: str = "url") -> DataFrame:
    """The rows whose url is not blocked."""
    judged, name = judge(urls, blocked, allowed, p, url)
    return judged.filter(F.col(f"{name}.verdict") == "allow").drop(name)


def rule_list(spark: SparkSession, verdict: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(k) for k, v in RULES if v == verdict])).alias("key"))


def op12_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged, name = judge(pages, rule_list(spark, "block"), rule_list(spark, "allow"))
    return judged.select("page_id", f"{name}.*")


_REST = "coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '')"
_FITS = " ".join(
    f"WHEN (host = '{k.split('/')[0]}' OR ends_with(host, '.{k.split('/')[0]}')) AND starts_with(path, '{k[k.index('/'):]}') THEN '{k}'"
    for k, _ in sorted(RULES, key=lambda r: -len(r[0]))
)
_BLOCKED = ", ".join(f"'{k}'" for k, v in RULES if v == "block")
OP12_SQL = f"""
WITH rest AS (SELECT page_id, {_REST} AS r FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(r, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM rest
),
fits AS (SELECT *, CASE {_FITS} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({_BLOCKED}) THEN 'block' ELSE 'allow' END AS verdict FROM fits
"""
