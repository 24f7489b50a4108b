"""Connected components over large link tables, and a bounded membership filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_BITS = 23


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the smallest node it reaches.

    Alternating large and small stars (Kiveris et al., 2014): every round points neighbours to
    local minima. A node's neighbours are never gathered; its minimum is pre-aggregated and
    joined back, so a hub with a third of all links is an ordinary join key. Each round is
    written down, which cuts the lineage. Links of a node to itself add nothing.
    """
    now = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        # ``down`` feeds three places below: written once.
        down = materialize(down, "large-star")
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").filter("v <> m").select("v", "m").union(lowest.select("u", "m"))
        now = materialize(small.toDF("a", "b").distinct(), "small-star")
        before, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << _BITS))


def flagged(rows: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """Add ``may__hold``: may ``key`` be among ``ids[name]``? Never false for one that is.

    The ids are hashed into 2^23 bits, at most 2^17 broadcast rows however many ids there are.
    Used to keep what can't matter out of a shuffle; an exact join follows.
    """

    def bit(column: str) -> Column:
        return F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), 64) as int))")

    words = ids.select(F.shiftright(_slot(F.col(name)), 6).alias("may__w"), bit(name).alias("bit"))
    words = words.groupBy("may__w").agg(F.bit_or("bit").alias("may__bits"))
    held = rows.withColumn("may__w", F.shiftright(_slot(F.col(key)), 6)).join(F.broadcast(words), "may__w", "left")
    return held.withColumn("may__hold", F.coalesce(F.col("may__bits").bitwiseAND(bit(key)) != 0, F.lit(False))).drop("may__w", "may__bits")


def may_hold(rows: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """The rows so flagged: a superset of those whose key is among the ids."""
    return flagged(rows, key, ids, name).filter("may__hold").drop("may__hold")
