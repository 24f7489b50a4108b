import pytest
from conftest import day
from pyspark.sql import functions as F

from duesight.operators import decision, dedupe, evaluation, features, guards, history, models, ordering
from duesight.params import ModelParams
from duesight.plans import stages
from duesight.plans.views import register_views
from duesight.schemas import RAW_INPUT_COLS
from duesight.session import materialize

SMALL = ModelParams(trees=3, depth=3)


@pytest.fixture(scope="module")
def fitted(spark, root):
    f = stages.Folds(spark, root, with_customer=True)
    codes = f.encoders()
    train, test = (
        materialize(features.encode(features.invoice_features(f.state(r)), codes)) for r in (f.train, f.test)
    )
    return f, models.fit_bundle(train, codes, f.defaults, SMALL), test


def test_bundle_keeps_rows_and_orders_intervals(fitted):
    _, model, test = fitted
    scored = model.predict(test.select("invoice_id", *RAW_INPUT_COLS))
    assert scored.count() == test.count()
    assert scored.filter("days_late_lower > days_late_upper or p_late not between 0 and 1").count() == 0


def test_bundle_handles_unseen_categories_and_cold_start(spark, fitted):
    _, model, test = fitted
    row = test.limit(1).select("invoice_id", *RAW_INPUT_COLS)
    odd = row.withColumns(
        {"payment_terms": F.lit("NEVER SEEN"), "cust_avg_days_late": F.lit(None).cast("double")}
    )
    assert model.predict(odd).filter("days_late_pred is not null").count() == 1


def test_round_trip(spark, fitted, tmp_path):
    _, model, test = fitted
    model.save(str(tmp_path))
    again = models.LatenessModel.load(spark, str(tmp_path))
    raw = test.select("invoice_id", *RAW_INPUT_COLS)
    cells = ["invoice_id", "days_late_pred", "days_late_lower", "days_late_upper"]
    assert model.predict(raw).select(*cells).exceptAll(again.predict(raw).select(*cells)).count() == 0


def test_interval_covers_most_outcomes(fitted):
    _, model, test = fitted
    raw = test.select("invoice_id", "days_late", *RAW_INPUT_COLS)
    row = evaluation.error_metrics(model.predict(raw).withColumn("actual", F.col("days_late"))).first()
    assert 65 < row.pi_coverage < 95


def test_permutation_finds_the_useful_feature(spark):
    df = spark.range(400).select(
        F.col("id").cast("string").alias("invoice_id"),
        (F.col("id") % 10).cast("double").alias("useful"),
        ((F.col("id") * 37) % 11).cast("double").alias("noise"),
        ((F.col("id") % 10) * 5).cast("int").alias("days_late"),
    )
    model = models.fit_mean(df, ModelParams(trees=5, depth=4), ["useful", "noise"])
    got = {r.feature: r.mae_increase for r in models.permutation_importance(model, df, 2, ["useful", "noise"]).collect()}
    assert got["useful"] > 5 and abs(got["noise"]) < 1


def test_champion_is_latest_flagged(spark):
    rows = [("a", True, "2024-01-01"), ("b", True, "2024-02-01"), ("c", False, "2024-03-01")]
    runs = spark.createDataFrame(rows, "run_id string, champion boolean, created_at string")
    assert models.champion(runs).first().run_id == "b"


def test_guards_notice_violations(spark):
    bad = spark.createDataFrame(
        [("i1", day("2020-02-01"), day("2020-01-01")), ("i1", day("2020-01-01"), day("2020-02-01")), (None, day("2020-01-01"), day("2020-02-01"))],
        "invoice_id string, posting_date date, due_date date",
    )
    got = {r.check: r.violations for r in guards.silver(bad).collect()}
    assert got == {"silver_null_id": 1, "silver_unique_id": 1, "silver_due_after_posting": 1}
    late = spark.createDataFrame([(day("2020-02-01"), day("2020-02-01"))], "_hist_asof date, posting_date date")
    assert guards.history_before_posting(late).first().violations == 1
    flat = spark.createDataFrame([(2.0, 1.0)], "days_late_lower double, days_late_upper double")
    assert guards.interval_order(flat).first().violations == 1
    queue = spark.createDataFrame(
        [("CALL", 1.0, 1), ("CALL", 5.0, 2), ("NAP", 0.0, None)], "action string, expected_value double, rank long"
    )
    got = {r.check: r.violations for r in guards.queue(queue, queue.limit(2), 1).collect()}
    assert got == {"queue_count": 1, "queue_capacity": 1, "queue_tiers": 1, "queue_rank_set": 1, "queue_call_order": 1}


def test_latest_prediction_and_pages(spark):
    log = spark.createDataFrame(
        [("i1", "1", "2024-01-01"), ("i1", "2", "2024-02-01"), ("i2", "1", "2024-01-01")],
        "invoice_id string, model_version string, scored_at string",
    )
    got = {r.invoice_id: r.model_version for r in dedupe.latest_prediction(log, "invoice_id").collect()}
    assert got == {"i1": "2", "i2": "1"}
    rows = spark.range(25).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    seen, after = [], None
    while True:
        part = [tuple(r) for r in ordering.page_after(rows, 10, ["a", "b"], after).collect()]
        if not part:
            break
        seen += part
        after = part[-1]
    assert len(seen) == 25 and seen == sorted(seen)
    second = ordering.page(rows, 2, 10, F.col("a"), F.col("b")).collect()
    assert [(r.a, r.b) for r in second] == seen[10:20] and second[0].pages == 3


def test_views_are_published(spark, root):
    stored = stages.stored_open_predictions(spark, root, with_customer=True)
    queue = decision.cap_calls(decision.value_predictions(stored)).withColumns(
        {
            "queue_date": F.lit("2024-01-01").cast("date"),
            "rank": F.lit(1),
            "predicted_payment_date": F.col("due_date"),
            "model_version": F.lit("1"),
            "scored_at": F.lit("2024-01-01"),
        }
    )
    names = register_views(spark, {"queue": queue, "gold": history.gold_customer(stages.closed(spark, root))})
    assert "v_executive_kpis" in names and "v_customer_segments" in names and "v_drift_latest" not in names
    assert spark.sql("select open_invoices from v_executive_kpis").first()[0] == queue.count()


def test_setup_and_catalog(spark):
    from duesight.sources.tables import catalog_table_exists, setup

    setup(spark, "duesight_test")
    assert spark.catalog.databaseExists("duesight_test")
    assert not catalog_table_exists(spark, "duesight_test.nothing")


def test_watched_tables_count_violations_while_written(spark):
    rows = spark.createDataFrame([(1, 2), (3, 2), (5, None)], "a int, b int")
    stored, report = guards.watched(rows, {"above": F.count_if(F.col("a") > F.col("b")), "nulls": F.count_if(F.col("b").isNull())})
    assert {tuple(r) for r in report.collect()} == {("above", 1), ("nulls", 1)} and stored.count() == 3
    none = rows.filter("false").withColumn("is_open", F.lit(1))
    assert {r.check: r.violations for r in guards.watched(none, guards.scoring_checks())[1].collect()} == {"rows_to_score": 1, "open_rows_present": 1}
