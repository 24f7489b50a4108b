"""Versioned tables, and the model that is found through its record."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duesight.operators import features, model_store, models
from duesight.params import ModelParams
from duesight.plans import stages
from duesight.sources import testdata
from duesight.sources.versioned import VersionedTables


def test_versions(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    assert not tables.exists("t")
    with pytest.raises(LookupError):
        tables.scan("t")
    tables.refresh(spark.range(5), "t")
    reader = tables.scan("t")
    tables.refresh(tables.scan("t").withColumn("x", F.col("id") * 2).filter("id > 0"), "t")  # reads itself, new columns
    assert reader.count() == 5 and tables.scan("t", 1).count() == 5
    assert tables.scan("t").columns == ["id", "x"] and tables.scan("t").count() == 4
    assert [r.number for r in tables.versions("t").orderBy("number").collect()] == [1, 2]
    with pytest.raises(ValueError):
        tables.retain("t", 0)
    assert tables.retain("t", 1) == 1 and tables.scan("t").count() == 4
    tables.refresh(spark.range(1), "t")
    assert tables.scan("t").count() == 1


def test_a_refresh_that_dies_changes_nothing(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    tables.refresh(spark.range(3), "t")
    with pytest.raises(Exception, match="broken"):
        tables.refresh(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), "t")
    assert tables.scan("t").count() == 3 and tables.versions("t").count() == 1
    # A folder without a pointer is not read, and goes with the old versions.
    spark.range(9).write.parquet(f"{tables.path('t')}/version-unfinished")
    assert tables.scan("t").count() == 3 and tables.retain("t", 5) >= 1 and tables.scan("t").count() == 3


def test_serving_uses_the_record(spark, root, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    p = ModelParams(trees=2, depth=2)
    f = stages.Folds(spark, root, with_customer=True)
    codes = f.encoders()
    train = features.encode(features.invoice_features(f.state(f.train)), codes)
    model = models.fit_bundle(train, codes, f.defaults, p)
    test = features.invoice_features(f.state(f.test))
    metrics = model_store.metrics_of(model, test)
    day = dt.date(1996, 6, 1)
    model_store.publish(tables, model, "a", "1", day, metrics, p)
    model_store.publish(tables, model, "b", "2", day, metrics, p, is_champion=False)
    served = model_store.serving(tables)
    assert (served.run_id, served.cutoff) == ("a", day)
    assert served.defaults == pytest.approx({k: float(v) for k, v in f.defaults.items()})
    rows, paid = testdata.ledger(spark, root), stages.closed(spark, root)
    log = served.score(rows, paid, "both", "2024-01-01 00:00:00")
    assert log.filter("scoring_mode = 'backtest'").agg(F.min("posting_date")).first()[0] >= day
    assert log.filter("scoring_mode = 'open'").count() == rows.filter("is_open = 1").count()
    want = model.predict(test).select("invoice_id", "days_late_pred", "days_late_lower")
    again = served.model.predict(test).select("invoice_id", "days_late_pred", "days_late_lower")
    assert want.exceptAll(again).count() == 0
    with pytest.raises(LookupError):
        model_store.serving(tables, F.col("run_id") == "none")
