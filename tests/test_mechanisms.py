"""Bracketed quantiles, as-of by ranges, the bucketed feature table and boosted quantiles."""

import bisect
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from duesight.operators import history, ordering, quantile_boost
from duesight.params import ModelParams
from duesight.sources.tables import Tables

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("n,top", [(1, 5), (2, 5), (7, 3), (900, 40), (30_000, 10**6), (30_000, 4)])
def test_bracketed_quantiles_are_exact(spark, n, top):
    rng = np.random.default_rng(n + top)
    values = rng.integers(0, top, n) / 8
    rows = [(float(v), "a" if i % 3 else "b") for i, v in enumerate(values)] + [(None, "a"), (float("nan"), "b"), (float("inf"), "a"), (1.0, None)]
    df = spark.createDataFrame(rows, "x double, label string")
    for label in ("a", "b"):
        own = np.array([v for v, g in rows[:n] if g == label])
        got = ordering.grouped_quantile_values(df, "x", PROBS, "label").get(label)
        assert got == (pytest.approx(np.quantile(own, PROBS).tolist(), abs=1e-12) if len(own) else None)
    named = df.filter("label is not null")
    lower = ordering.quantile_values(named, "x", PROBS, interpolate=False)
    assert lower == np.quantile(values, PROBS, method="inverted_cdf").tolist()
    assert ordering.quantile_values(df.limit(0), "x", PROBS) == []


def test_bracketed_quantiles_sort_only_brackets(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("_v"), F.lit(0).alias("_all"))
    parts = ordering._brackets(df, "_all", [0.1, 0.5, 0.9])[0]
    held = sum(df.filter(F.col("_v").between(low, high)).count() for low, high in parts)
    assert len(parts) == 3 and 0 < held < 0.01 * 200_000


def test_asof_by_ranges_equals_a_plain_search(spark):
    rng = np.random.default_rng(2)
    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(microseconds=int(m)) for m in rng.integers(0, 4000, 3000)]
    # One key has a third of all rows.
    keys = ["hot" if i % 3 == 0 else f"k{rng.integers(0, 200)}" for i in range(3000)]
    left = [(i, None if i % 97 == 0 else keys[i], None if i % 89 == 0 else times[i]) for i in range(0, 3000, 2)]
    right = {(keys[i], times[i]): i for i in range(1, 3000, 2)}
    lf = spark.createDataFrame(left, "id int, k string, t timestamp")
    rf = spark.createDataFrame([(k, t, v) for (k, t), v in right.items()] + [(None, times[0], 1), ("hot", None, 2)], "k string, t timestamp, v int")
    by_key = {}
    for k, t in right:
        by_key.setdefault(k, []).append(t)
    for held in by_key.values():
        held.sort()

    def before(k, t):
        held = by_key.get(k, [])
        at = bisect.bisect_left(held, t) if t is not None else 0
        return held[at - 1] if at else None

    want = {i: (before(k, t), right.get((k, before(k, t)))) for i, k, t in left}
    got = history.asof_join_ranges(lf, rf, "k", "t", "t", ["v"])
    assert {r.id: (r._hist_asof, r.v) for r in got.collect()} == want and got.count() == len(left)
    assert history.asof_join_ranges(lf, rf.limit(0), "k", "t", "t", ["v"]).filter("v is not null").count() == 0
    assert history.asof_join_ranges(lf.limit(0), rf, "k", "t", "t", ["v"]).count() == 0


def test_asof_by_ranges_spreads_a_hot_key(spark, monkeypatch):
    seen = []
    real = history.materialize
    monkeypatch.setattr(history, "materialize", lambda df, label: seen.append(real(df, label)) or seen[-1])
    base = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.timestamp_micros("id").alias("t"), "id")
    # Small ranges would be merged into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = history.asof_join_ranges(base.select("k", "t"), base, "k", "t", "t", ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows.count() == 30_000
    parts = [r["count"] for r in seen[0].filter("_key = 0").groupBy("_part").count().collect()]
    assert len(parts) >= 2 and max(parts) <= 0.8 * sum(parts)


def test_bucketed_feature_table_is_not_shuffled(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    state = spark.range(500).select(F.col("id").cast("string").alias("customer_id"), F.rand(1).alias("x"))
    stored = tables.feature_table(state, "bucketed_state", "customer_id", 4)
    rows = spark.range(2000).select((F.col("id") % 600).cast("string").alias("customer_id"), "id")
    joined = rows.join(stored.hint("merge"), "customer_id", "left")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert joined.filter("x is null").count() == sum(i % 600 >= 500 for i in range(2000))


def plain_tree(x, y, start, q, rate):
    """One tree of depth 1 by trying every cut."""
    best = None
    for cut in sorted(set(x))[:-1]:
        left, right = (y > start)[x <= cut], (y > start)[x > cut]
        if min(len(left), len(right)) < 20:
            continue
        g = [np.where(side, q, q - 1).sum() for side in (left, right)]
        gain = g[0] ** 2 / len(left) + g[1] ** 2 / len(right)
        if best is None or gain > best[0] + 1e-9:
            best = (gain, cut)
    cut = best[1]
    leaf = [np.quantile(y[side] - start, q, method="inverted_cdf") for side in (x <= cut, x > cut)]
    return start + rate * np.where(x <= cut, *leaf)


def test_boosted_quantiles(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 20, 1500)
    y = np.round(x + rng.normal(0, 1 + x / 4, 1500), 3)
    other = rng.integers(0, 3, 1500)
    rows = [(i, float(a), float(c), float(b)) for i, (a, b, c) in enumerate(zip(x, y, other))]
    df = spark.createDataFrame(rows, "i int, x double, z double, days_late double").repartition(3)
    one = quantile_boost.fit_boosted_interval(df, ModelParams(trees=1, depth=1, learning_rate=0.5), ["x"])
    got = {r.i: (r.days_late_lower, r.days_late_upper) for r in one.transform(df).collect()}
    start = one.trees.start
    want = zip(plain_tree(x, y, start[0], 0.1, 0.5), plain_tree(x, y, start[1], 0.9, 0.5))
    assert [got[i] for i in range(1500)] == [pytest.approx(w) for w in want]
    model = quantile_boost.fit_boosted_interval(df, ModelParams(trees=12, depth=2, learning_rate=0.4), ["x", "z"], store_every=5)
    scored = model.transform(df)
    shares = scored.agg(F.expr("avg(int(days_late between days_late_lower and days_late_upper))"), F.expr("avg(int(days_late < days_late_lower))")).first()
    assert 0.72 < shares[0] < 0.88 and 0.05 < shares[1] < 0.16
    width = {r.x: r.w for r in scored.groupBy("x").agg(F.avg(F.expr("days_late_upper - days_late_lower")).alias("w")).collect()}
    assert width[19.0] > 2 * width[0.0]  # the spread follows the noise
    model.save(spark, f"{tmp_path}/m")
    again = quantile_boost.BoostedInterval.load(spark, f"{tmp_path}/m").transform(df)
    assert scored.exceptAll(again).count() == 0


def test_boosted_quantiles_of_odd_rows(spark):
    rows = [(None, 1.0), (float("nan"), 2.0), (3.0, None), *[(float(i), float(i)) for i in range(60)]]
    df = spark.createDataFrame(rows, "x double, days_late double")
    model = quantile_boost.fit_boosted_interval(df, ModelParams(trees=2, depth=2), ["x"])
    assert model.transform(df).filter("days_late_lower is null or days_late_upper is null").count() == 0
    none = quantile_boost.fit_boosted_interval(df.limit(0), ModelParams(trees=2), ["x"])
    assert none.transform(df).filter("days_late_lower is not null").count() == 0
