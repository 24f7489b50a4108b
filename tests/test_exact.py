"""Values that must not depend on how a sum was cut up, nor on how a double is printed."""

import threading

import duckdb
import numpy as np
import pytest
from conftest import outcome_rows
from pyspark.sql import functions as F

from duesight.functions import scoring as S
from duesight.operators import decision, features, history, model_store
from duesight.operators import quantile_boost as boost
from duesight.params import ModelParams
from duesight.plans import model_queries, views


def sql_rounded(values, digits):
    return [duckdb.execute(f"SELECT round(?::DOUBLE, {digits})", [v]).fetchone()[0] for v in values]


def test_half_cents_as_in_sql(spark):
    values = [-9.915, -12.254999999999999, -14.924999999999999, 2.675, 0.125, 1e13 + 0.1, 0.0, -0.004]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 6):
        assert [r.v for r in df.select(S.rounded(F.col("v"), digits).alias("v")).collect()] == sql_rounded(values, digits)


def test_expected_value_at_half_cents(spark):
    """amounts whose expected value ends in half a cent, as the check SQL rounds it."""
    rows = [(i, a / 100, 3.0, 9.0, 0.0, 9.0) for i, a in enumerate([368750, 381250, 706250, 718750, 1206250, 1356250])]
    df = spark.createDataFrame(rows, "invoice_id int, invoice_amount double, days_late_lower double, days_late_upper double, cust_std_days_late double, days_late_pred double")
    got = [r.expected_value for r in decision.value_predictions(df).orderBy("invoice_id").collect()]
    plain = [1.0 * 0.8 * ((3.0 * 0.0003) * r[1]) - 15.0 for r in rows]
    assert got == sql_rounded(plain, 2)


@pytest.fixture(scope="module")
def train(spark):
    dates = ("2020-01-01", "2020-02-01")
    days = ["2020-02-%02d" % d for d in range(1, 28)]
    rows = [(f"c{i % 7}", f"i{i}", *dates, days[i % 27], (i * 7919 % 100003) / 100 * 10 ** (i % 5)) for i in range(600)]
    return outcome_rows(spark, rows)


def test_cold_start_values_in_any_order(train):
    """the same bits, whatever the order and the parts in which rows are summed."""
    ways = [train.orderBy("invoice_amount").coalesce(1), train.orderBy(F.col("invoice_amount").desc()).coalesce(1)]
    ways += [train.repartition(n, "invoice_id") for n in (3, 5, 16)]
    assert len({tuple(features.fold_defaults(w).first()) for w in ways}) == 1


def test_equal_spreads_are_equal(spark):
    """[14, 12, 8, 11, 18, 5] and [17, 18, 13, 24] have the same variance, 62/3."""
    late = {"a": [14, 12, 8, 11, 18, 5], "b": [17, 18, 13, 24]}
    rows = [(c, f"{c}{i}", "2020-01-01", "2020-02-01", f"2020-02-{1 + d:02d}", 10.0) for c, ds in late.items() for i, d in enumerate(ds)]
    gold = history.gold_customer(outcome_rows(spark, rows))
    assert len({r.std_days_late for r in gold.collect()}) == 1


def test_segments_split_at_the_exact_median(spark):
    """a sketch of 30,001 values may be off by some ranks; the median is the middle value."""
    n = 30_001
    gold = spark.range(n).select(
        F.col("id").cast("string").alias("customer_id"),
        (F.col("id") / 7).alias("avg_days_late"),
        (F.lit(n) - F.col("id")).cast("double").alias("std_days_late"),
        F.lit(1).alias("invoice_count"),
        F.lit(1.0).alias("avg_invoice_amount"),
    ).repartition(16, "customer_id")
    sizes = {r.segment: r["count"] for r in views.customer_segments(gold).groupBy("segment").count().collect()}
    assert sizes == {"Late but Predictable": n // 2, "Prompt but Erratic": n // 2, "Prompt & Reliable": 1}


def test_every_tree_is_added_once(spark):
    """blocks carry predictions from tree to tree, so that no pass goes through earlier trees again."""
    rows = spark.range(3000).select((F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 7 * F.col("id") % 50).alias("days_late"))
    seen, packed = [], boost._advanced
    boost._advanced = lambda blocks, trees: seen.append((packed(blocks, trees), trees)) or seen[-1][0]
    try:
        boost.fit_boosted_interval(rows, ModelParams(trees=4, depth=2), ["x"], store_every=2)
    finally:
        boost._advanced = packed
    for blocks, trees in seen:
        for r in blocks.collect():
            bins, p = np.frombuffer(r.bins, np.uint8).reshape(1, -1), np.frombuffer(r.p).reshape(2, -1)
            plain = trees.advance(np.tile(np.array(trees.start)[:, None], (1, r.n)), bins, 0)
            assert p == pytest.approx(plain, abs=1e-9) and len(trees.value) <= 3
    assert [len(t.value) for _, t in seen] == [1, 2, 3]


def test_leaves_hold_exact_quantiles(spark):
    """a sketch of 60,001 residuals may be off by some ranks; a level's pass reads no labels."""
    n = 60_001
    rows = spark.range(n).repartition(7).select((F.col("id") % 2).cast("double").alias("x"), F.pow((F.col("id") * 7919) % n / 100, F.lit(3)).alias("days_late"))
    one = boost.fit_boosted_interval(rows, ModelParams(trees=1, depth=1, learning_rate=1.0), ["x"])
    plain = {x: np.sort([r.days_late for r in rows.filter(F.col("x") == x).collect()]) for x in (0.0, 1.0)}
    split = {q: one.trees.cut[0, q, 0] < 1 << 30 for q in (0, 1)}
    for q, share in enumerate((0.1, 0.9)):
        start = one.trees.start[q]
        parts = [plain[0.0], plain[1.0]] if split[q] else [np.sort(np.concatenate(list(plain.values())))]
        want = [np.quantile(y - start, share, method="inverted_cdf") for y in parts]
        assert one.trees.value[0, q, : len(want)].tolist() == want
    blocks = [boost.Block(3, bytes(3), np.array([1.0, 5.0, y]).tobytes(), np.zeros((2, 3)).tobytes()) for y in (-1e9, 2.0, 1e9)]
    for reach in (1e-6, 1.0, 1e12):  # wherever the grid ends
        assert boost._leaf_values(spark.sparkContext.parallelize(blocks, 2), one.trees, reach, 2)[:, 0].tolist() == [-1e9, 1e9]
    bins, sides = boost._sided(boost.Block(3, bytes(3), np.array([1.0, 5.0, 2.0]).tobytes(), np.array([[2.0] * 3, [0.0] * 3]).tobytes()))
    assert bins == bytes(3) and list(sides) == [2, 3, 2]


def test_leakage_variants_are_fitted_side_by_side(spark, root, monkeypatch):
    """every fit waits until all four have begun."""
    began, fit = threading.Barrier(4, timeout=60), model_queries.models.fit_mean
    monkeypatch.setattr(model_queries, "PARAMS", ModelParams(trees=1, depth=2))
    monkeypatch.setattr(model_queries.models, "fit_mean", lambda *a: began.wait() >= 0 and fit(*a))
    rows = model_queries.leakage_experiment(spark, root).collect()
    assert sorted(r.variant[0] for r in rows) == list("ABCD") and all(r.mae > 0 for r in rows)


def test_hold_out_is_predicted_once(spark):
    """F8: the metrics pass over stored predictions."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(x):
        calls.add(1)
        return float(x)

    class Model:
        def predict(self, df):
            late = F.col("days_late_pred")
            return df.withColumn("days_late_pred", slow("days_late")).withColumns({"days_late_lower": late - 1, "days_late_upper": late + 1})

    test = spark.range(300).select(
        F.col("id").cast("string").alias("invoice_id"),
        (F.col("id") * 100.0).alias("invoice_amount"),
        F.lit(3.0).alias("cust_std_days_late"),
        (F.col("id") % 20 - 5).cast("int").alias("days_late"),
    )
    row = model_store.metrics_of(Model(), test).first()
    assert row.n == 300 and row.median_ae == 0 and row.ev_decision_engine is not None
    assert calls.value == 300
