import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from duesight.operators import mean_boost, models
from duesight.params import ModelParams

SMALL = ModelParams(trees=9, depth=4)


@pytest.fixture(scope="module")
def rows(spark):
    x, z = F.col("id") % 10, (F.col("id") * 37) % 11
    late = x * 3 + F.when((z > 4) & (x < 6), 7).otherwise(0) + F.pmod(F.hash("id"), F.lit(13))
    df = spark.range(3000).repartition(3).select("id", x.cast("double").alias("x"), z.cast("double").alias("z"), late.cast("int").alias("days_late"))
    return df.cache()


def _predictions(df):
    return np.array([r.days_late_pred for r in df.orderBy("id").select("days_late_pred").collect()])


def test_same_trees_as_spark_ml(rows):
    """Every value is a candidate for both, so predictions and importances must agree."""
    theirs = GBTRegressor(labelCol="days_late", predictionCol="days_late_pred", maxIter=9, maxDepth=4, stepSize=0.1, seed=42)
    vectors = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows)
    theirs = theirs.fit(vectors)
    ours = models.fit_mean(rows, SMALL, ["x", "z"])
    assert np.allclose(_predictions(ours.transform(rows)), _predictions(theirs.transform(vectors)), atol=1e-9)
    assert np.allclose(ours.importances(), theirs.featureImportances.toArray(), atol=1e-9)


def test_blocks_tasks_and_stores_change_nothing(rows, monkeypatch):
    one = mean_boost.fit_boosted_mean(rows.coalesce(1), SMALL, ["x", "z"], store_every=100)
    monkeypatch.setattr(mean_boost, "BLOCK", 1)  # a block a batch
    monkeypatch.setattr(mean_boost, "FEW_TASKS", 1)  # sums in a tree
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        many = mean_boost.fit_boosted_mean(rows, SMALL, ["x", "z"], store_every=2)
        assert np.allclose(_predictions(one.transform(rows)), _predictions(many.transform(rows)), atol=1e-9)
    finally:
        rows.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_missing_values_unlabelled_and_no_rows(spark, rows, tmp_path):
    """Spark ML's assembler raised on a missing feature."""
    odd = rows.withColumns({"x": F.when(F.col("id") % 5 > 0, F.col("x")), "days_late": F.when(F.col("id") % 7 > 0, F.col("days_late"))})
    model = models.fit_mean(odd, SMALL, ["x", "z"])
    pred = _predictions(model.transform(odd))
    assert len(pred) == 3000 and np.isfinite(pred).all()
    known = models.fit_mean(odd.filter("days_late is not null"), SMALL, ["x", "z"])
    assert np.allclose(pred, _predictions(known.transform(odd)), atol=1e-9)
    for number, kept in enumerate([model, models.fit_mean(rows.limit(0), SMALL, ["x", "z"])]):
        kept.save(spark, f"{tmp_path}/{number}")
        again = mean_boost.BoostedMean.load(spark, f"{tmp_path}/{number}").transform(odd)
        assert kept.transform(odd).exceptAll(again).count() == 0


def test_permuted_errors_are_those_of_whole_predictions(spark, rows):
    """Missing features take part, which Spark ML's assembler raised on."""
    odd = rows.withColumns({"x": F.when(F.col("id") % 5 > 0, F.col("x")), "w": F.lit(1.0), "days_late": F.when(F.col("id") % 7 > 0, F.col("days_late"))})
    odd = odd.withColumn("invoice_id", F.col("id").cast("string"))
    model = models.fit_mean(odd, SMALL, ["x", "z", "w"])
    got = {r.feature: (r.mae_increase, r.std) for r in models.permutation_importance(model, odd, 3, ["x", "z", "w"]).collect()}
    order = sorted(odd.toPandas().to_dict("records"), key=lambda r: (hashlib.md5(f"{r['id']}:42".encode()).hexdigest(), r["invoice_id"]))
    frame = pd.DataFrame(order)

    def mae(f):
        return (f.days_late - model.trees.predict(f)[0]).abs().mean()

    for name in ("x", "z", "w"):
        shifts = [(r + 1) * len(frame) // 4 for r in range(3)]
        more = [mae(frame.assign(**{name: np.roll(frame[name].to_numpy(), s)})) - mae(frame) for s in shifts]
        assert np.allclose(got[name], (np.mean(more), np.std(more, ddof=1)), atol=1e-9)
    assert got["w"] == (0.0, 0.0) and got["x"][0] > 1
