"""Global order without a single-partition window: ranks, prefix sums, quantiles, top-k.

A window without partition keys moves every row into one task. Here a global order is a range
sort; each range knows its own rows, and only one row per range (its totals) is ever
accumulated in sequence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import sample_order
from ..session import materialize, scalar_row

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _starts(per_part: DataFrame, *sums: str) -> DataFrame:
    """Exclusive running totals over one row per range partition (a few thousand at most)."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )


def rank_rows(df: DataFrame, order_by: list[Column], rank: str = "rank") -> DataFrame:
    """Add the 1-based position of every row in the global order.

    ``order_by`` must end in a unique column, so that ranks do not depend on the run. The
    sorted rows are written once; the numbers are then plain arithmetic on that table.
    """
    placed = materialize(
        df.orderBy(*order_by).withColumn("__row", F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright("__row", _ROW_BITS)
    row = F.col("__row").bitwiseAND((1 << _ROW_BITS) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("rows"))
    # One row per range partition: the size of this side is the partition count.
    offsets = F.broadcast(_starts(counts, "rows"))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(rank, (F.col("_before_rows") + row + 1).cast("long"))
        .drop("_part", "__row", "_before_rows")
    )


def prefix_sums(df: DataFrame, order_by: list[Column], sums: dict[str, str]) -> DataFrame:
    """Running totals (inclusive) over a global order; ``sums`` maps new column -> column.

    The order must be unique per row. Typical input is already aggregated to one row per
    distinct value, so a value shared by a third of all rows is one row here.
    """
    placed = materialize(
        df.orderBy(*order_by).withColumn("_part", F.spark_partition_id()), "prefix"
    )
    sources = list(dict.fromkeys(sums.values()))
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sources])
    offsets = F.broadcast(_starts(totals, *sources))
    upto = (
        Window.partitionBy("_part")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = placed.join(offsets, "_part")
    for name, source in sums.items():
        out = out.withColumn(name, F.col(f"_before_{source}") + F.sum(source).over(upto))
    return out.drop("_part", *[f"_before_{c}" for c in sources])


def _positions(probs: list[float], interpolate: bool) -> Column:
    """Wanted places (from 0, by ``_total`` values) as an array of ``q`` and ``at``."""
    if interpolate:
        position = lambda p: F.lit(p) * (F.col("_total") - 1)
    else:
        position = lambda p: F.greatest(
            F.ceil(F.round(F.lit(p) * F.col("_total"), 9)) - 1, F.lit(0)
        ).cast("double")
    return F.array(*[F.struct(F.lit(p).alias("q"), position(p).alias("at")) for p in probs])


def _covers(at: Column) -> Column:
    """Is the place among the ``_n`` equal values that end in front of ``_upto``?"""
    return (at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n"))


def quantiles(
    df: DataFrame, value: str, probs: list[float], by: str | None = None, interpolate: bool = True
) -> DataFrame:
    """Exact quantiles of a column, optionally per label: rows ``(by, q, value)``.

    ``percentile`` keeps every distinct value of a group in one task's memory; this counts
    distinct values, accumulates the counts over a range sort and picks the rows that cover
    the wanted positions. ``by`` is a label with few values (feature names), not an entity key.
    """
    label = by or "_all"
    values = df.select(
        (F.col(by) if by else F.lit(0)).alias(label), F.col(value).cast("double").alias("_v")
    ).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != float("inf")))
    counts = values.groupBy(label, "_v").agg(F.count(F.lit(1)).alias("_n"))
    running = prefix_sums(counts, [F.col(label), F.col("_v")], {"_upto": "_n"})
    # One row per label.
    span = running.groupBy(label).agg(F.max("_upto").alias("_end"), F.sum("_n").alias("_total"))
    placed = running.join(span, label).withColumn(
        "_upto", F.col("_upto") - F.col("_end") + F.col("_total")
    )
    wanted = _positions(probs, interpolate)
    covers = _covers

    hits = placed.select(
        label,
        "_v",
        "_n",
        "_upto",
        F.explode(
            F.filter(
                wanted, lambda s: covers(F.floor(s["at"])) | covers(F.ceil(s["at"]))
            )
        ).alias("w"),
    )
    at = F.col("w.at")
    found = hits.groupBy(label, F.col("w.q").alias("q"), at.alias("_at")).agg(
        F.max(F.when(covers(F.floor(at)), F.col("_v"))).alias("_lo"),
        F.max(F.when(covers(F.ceil(at)), F.col("_v"))).alias("_hi"),
    )
    share = F.col("_at") - F.floor("_at")
    out = found.select(
        label, "q", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share).alias("value")
    )
    return out if by else out.drop(label)


_ACCURACY = 10_000  # of the sketch: it may be off by this part of all ranks
# Half-widths of brackets, as shares of all ranks; the first that also spans a few rows is used.
_SPANS = [5 / _ACCURACY, 50 / _ACCURACY, 500 / _ACCURACY, 1.0]


def _brackets(values: DataFrame, label: str, probs: list[float]) -> dict:
    """Per label disjoint intervals that hold the wanted ranks: from one pass with a sketch."""
    around = [min(max(p + sign * w, 0.0), 1.0) for w in _SPANS for p in probs for sign in (-1, 1)]
    seen = values.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", around, _ACCURACY).alias("q"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
    )
    found = {}
    for row in seen.collect():  # one row per label
        level = next(i for i, w in enumerate(_SPANS) if w * row.n >= 5 or w == 1.0)
        cuts = row.q[level * 2 * len(probs) : (level + 1) * 2 * len(probs)]
        if level == len(_SPANS) - 1:
            cuts = [row.lo, row.hi]
        merged: list[list[float]] = []
        for low, high in sorted(zip(cuts[::2], cuts[1::2])):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(high, merged[-1][1])
            else:
                merged.append([low, high])
        found[row[label]] = merged
    return found


def bracketed_quantiles(df: DataFrame, value: str, probs: list[float], by: str | None = None, interpolate: bool = True) -> dict:
    """Exact quantiles ``{label: [value, ..]}`` in two passes, without sorting the values.

    The first pass brackets every wanted rank with a quantile sketch. The second counts: rows
    between brackets by bracket, rows inside by value; only the distinct values inside, a
    thousandth of all rows per quantile, are ordered. Where a rank is not in its bracket (the sketch
    promises it is), the label is worked out by ``quantiles``.
    """
    label = by or "_all"
    values = df.select(
        (F.col(by) if by else F.lit(0)).alias(label), F.col(value).cast("double").alias("_v")
    ).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != float("inf")) & F.col(label).isNotNull())
    brackets = _brackets(values, label, probs)
    if not brackets:
        return {}
    cell = F.lit(None).cast("int")
    for name, parts in brackets.items():  # labels are feature names
        passed = F.lit(0)
        for low, high in parts:
            passed = passed + (F.col("_v") >= low).cast("int") + (F.col("_v") > high).cast("int")
        cell = F.when(F.col(label) == F.lit(name), passed).otherwise(cell)
    cells = values.withColumn("_cell", cell)
    inside = F.when(F.col("_cell") % 2 == 1, F.col("_v"))
    counts = cells.groupBy(label, "_cell", inside.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_cell", "_v")
    placed = counts.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(Window.partitionBy(label))})
    wanted = _positions(probs, interpolate)
    hits = placed.select(label, "_v", F.explode(F.filter(wanted, lambda s: _covers(F.floor(s["at"])) | _covers(F.ceil(s["at"])))).alias("w"), "_n", "_upto")
    found: dict = {}
    for row in hits.select(label, "_v", "w.q", "w.at", _covers(F.floor("w.at")).alias("is_low"), _covers(F.ceil("w.at")).alias("is_high")).collect():
        ends = found.setdefault(row[label], {}).setdefault(row.q, [None, None, row["at"]])
        ends[0] = row["_v"] if row.is_low else ends[0]
        ends[1] = row["_v"] if row.is_high else ends[1]
    out = {}
    for name, got in found.items():
        if any(low is None or high is None for low, high, _ in got.values()):
            rest = df.filter(F.col(by) == F.lit(name)) if by else df
            out[name] = [r["value"] for r in quantiles(rest, value, probs, interpolate=interpolate).orderBy("q").collect()]
            out[name] = [dict(zip(sorted(set(probs)), out[name]))[p] for p in probs]
        else:
            out[name] = [got[p][0] + (got[p][1] - got[p][0]) * (got[p][2] - int(got[p][2])) for p in probs]
    return out


def quantile_values(df: DataFrame, value: str, probs: list[float], interpolate: bool = True) -> list[float]:
    """Quantiles as constants, in the order of ``probs`` (empty without values). They are fitted
    scalars: worked out once, then fixed in every plan that uses them."""
    return next(iter(bracketed_quantiles(df, value, probs, interpolate=interpolate).values()), [])


def grouped_quantile_values(
    df: DataFrame, value: str, probs: list[float], by: str
) -> dict[str, list[float]]:
    """The same per label; ``len(labels) * len(probs)`` numbers."""
    return bracketed_quantiles(df, value, probs, by=by)


def inner_edges(edges: list[float]) -> list[float]:
    """Distinct edges strictly between the outer ones (an edge equal to an outer one closes no
    bucket of its own)."""
    return [e for e in sorted(set(edges)) if edges[0] < e < edges[-1]]


def edges_passed(edges: list[float], value: str, compare: str) -> Column:
    """How many of the ascending ``edges`` lie ``<`` or ``<=`` the value of a column."""
    at, passed = F.col(value).cast("double"), F.lit(0)
    for i, edge in enumerate(edges, start=1):
        low = F.lit(float(edge))
        passed = F.when(low < at if compare == "<" else low <= at, i).otherwise(passed)
    return passed


def quantile_bucket(df: DataFrame, value: str, buckets: int, name: str) -> DataFrame:
    """Equal-count buckets 0..n-1, right-closed, lowest value included, duplicate edges merged."""
    edges = quantile_values(df, value, [i / buckets for i in range(buckets + 1)])
    bucket = edges_passed(inner_edges(edges) if edges else [], value, "<")
    return df.withColumn(name, F.when(F.col(value).isNotNull(), bucket))


def top_n(df: DataFrame, n: int, *order_by: Column) -> DataFrame:
    """Top-n by a total order: each task keeps n rows, n rows per task are merged."""
    return df.orderBy(*order_by).limit(n)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Reproducible sample of n rows without replacement, independent of partitioning."""
    return df.orderBy(sample_order(key, seed), key).limit(n)


def page(df: DataFrame, number: int, size: int, *order_by: Column) -> DataFrame:
    """One page of an ordered listing with its total and page count on every row."""
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    return (
        df.orderBy(*order_by)
        .offset((number - 1) * size)
        .limit(size)
        .withColumn("page", F.lit(number))
        .withColumn("total", total)
        .withColumn("pages", F.ceil(total / size).cast("long"))
    )


def page_after(df: DataFrame, size: int, keys: list[str], after: tuple | None = None) -> DataFrame:
    """The next rows behind a key position: unlike an offset it costs the same for every page.
    The keys must be unique together."""
    if after is not None:
        later = F.lit(False)
        for i, key in enumerate(keys):
            same = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(keys[:i], after)], F.lit(True))
            later = later | (same & (F.col(key) > F.lit(after[i])))
        df = df.filter(later)
    return df.orderBy(*keys).limit(size)
