"""The ten dashboard views over the pipeline's tables.

Each view is a function of DataFrames, so its definition lives in one place; ``register_views``
publishes them as temporary views for SQL users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import cents, interval_text, rounded
from ..operators.decision import segment_customers, strategy_comparison
from ..operators.dedupe import latest_per_key


def executive_kpis(queue: DataFrame) -> DataFrame:
    late = F.col("days_late_pred") > 0
    call = F.col("action") == "CALL"
    total = lambda cond, c: F.round(F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0.0)), 2)
    return queue.agg(
        F.count(F.lit(1)).alias("open_invoices"),
        F.round(F.sum("invoice_amount"), 2).alias("total_outstanding"),
        F.count_if(late).alias("predicted_late"),
        total(late, "invoice_amount").alias("value_at_risk"),
        F.count_if(call).alias("recommended_calls"),
        total(call, "expected_value").alias("expected_daily_recovery"),
        F.round(F.avg("days_late_pred"), 2).alias("avg_predicted_delay"),
        F.round(F.avg(F.col("days_late_upper") - F.col("days_late_lower")), 2).alias("avg_interval_width"),
        F.max("queue_date").alias("queue_generated_at"),
    )


def collection_queue(queue: DataFrame) -> DataFrame:
    return queue.select(
        "rank",
        "action",
        "customer_name",
        "invoice_id",
        rounded(F.col("invoice_amount"), 2).alias("amount"),
        "due_date",
        "predicted_payment_date",
        F.ceil("days_late_pred").cast("int").alias("days_late_predicted"),
        interval_text(F.col("days_late_lower"), F.col("days_late_upper")).alias("prediction_interval"),
        rounded(F.col("p_late"), 2).alias("p_late"),
        F.round("p_responds", 2).alias("p_responds"),
        rounded(F.col("expected_value"), 2).alias("expected_value"),
    ).orderBy("rank")


def action_summary(queue: DataFrame) -> DataFrame:
    return queue.groupBy("action").agg(
        F.count(F.lit(1)).alias("invoices"),
        F.round(F.sum("invoice_amount"), 2).alias("exposure"),
        F.round(F.sum("expected_value"), 2).alias("total_expected_value"),
        F.round(F.avg("p_late"), 3).alias("avg_p_late"),
        F.round(F.avg("days_late_pred"), 2).alias("avg_predicted_delay"),
    )


def invoice_detail(queue: DataFrame, gold: DataFrame) -> DataFrame:
    """Everything known about an invoice, with its customer's behaviour."""
    behaviour = gold.select(
        "customer_id",
        rounded(F.col("avg_days_late"), 1).alias("customer_avg_days_late"),
        rounded(F.col("late_rate"), 3).alias("customer_late_rate"),
        rounded(F.col("recent_90d_avg_days_late"), 1).alias("customer_recent_90d_avg"),
    )
    return queue.join(behaviour, "customer_id", "left").select(
        "invoice_id",
        "customer_id",
        "customer_name",
        rounded(F.col("invoice_amount"), 2).alias("amount"),
        "posting_date",
        "due_date",
        "predicted_payment_date",
        rounded(F.col("days_late_pred"), 1).alias("p50_days_late"),
        rounded(F.col("days_late_lower"), 1).alias("p10_days_late"),
        rounded(F.col("days_late_upper"), 1).alias("p90_days_late"),
        rounded(F.col("p_late"), 3).alias("probability_late"),
        rounded(F.col("expected_value"), 2).alias("expected_value"),
        "action",
        "payment_terms",
        "business_code",
        F.col("cust_invoice_count").cast("int").alias("customer_history_depth"),
        "customer_avg_days_late",
        "customer_late_rate",
        "customer_recent_90d_avg",
        "model_version",
        "scored_at",
    )


def customer_segments(gold: DataFrame) -> DataFrame:
    """Median split at observed values (the lower medians). ``gold`` is read three times, so pass a stored table."""
    return segment_customers(gold, interpolate=False).select(
        "customer_id",
        rounded(F.col("avg_days_late"), 1).alias("avg_days_late"),
        rounded(F.col("std_days_late"), 1).alias("payment_variability"),
        "invoice_count",
        cents(F.col("avg_invoice_amount")).alias("avg_invoice_amount"),
        "segment",
    )


def model_performance(log: DataFrame) -> DataFrame:
    return log.select(
        "evaluated_at",
        "model_version",
        F.round("mae", 3).alias("mae"),
        F.round("rmse", 3).alias("rmse"),
        F.round("bias", 3).alias("bias"),
        F.round("within_3d", 1).alias("pct_within_3_days"),
        F.round("pi_coverage", 1).alias("pi_coverage_pct"),
        F.round("late_auc", 3).alias("late_auc"),
        "n_labelled",
        "n_awaiting_label",
        "median_label_lag_days",
    ).orderBy(F.col("evaluated_at").desc())


def drift_latest(log: DataFrame) -> DataFrame:
    newest = latest_per_key(log, ["feature"], F.col("evaluated_at").desc())
    return newest.select(
        "feature", "type", F.round("psi", 4).alias("psi"), "status", "model_version", "evaluated_at"
    ).orderBy(F.col("psi").desc())


def pipeline_health(log: DataFrame) -> DataFrame:
    return log.select(
        "run_timestamp",
        "stage",
        "rows_in",
        "rows_clean",
        "rows_quarantined",
        F.round(F.col("reject_rate") * 100, 2).alias("reject_rate_pct"),
        F.to_json("reject_reasons").alias("reject_reasons"),
    ).orderBy(F.col("run_timestamp").desc())


def quarantine_reasons(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy(F.col("_reject_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("rows_rejected"))
        .orderBy(F.col("rows_rejected").desc())
    )


def strategies(queue: DataFrame) -> DataFrame:
    return (
        strategy_comparison(queue)
        .select("strategy", F.round("daily_ev", 2).alias("expected_value_of_20_calls"), "sort_order")
        .orderBy("sort_order")
    )


# View name, its function and the tables it reads.
VIEWS = {
    "v_executive_kpis": (executive_kpis, ["queue"]),
    "v_collection_queue": (collection_queue, ["queue"]),
    "v_action_summary": (action_summary, ["queue"]),
    "v_invoice_detail": (invoice_detail, ["queue", "gold"]),
    "v_customer_segments": (customer_segments, ["gold"]),
    "v_model_performance": (model_performance, ["performance"]),
    "v_drift_latest": (drift_latest, ["drift"]),
    "v_pipeline_health": (pipeline_health, ["quality"]),
    "v_quarantine_reasons": (quarantine_reasons, ["quarantine"]),
    "v_strategy_comparison": (strategies, ["queue"]),
}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Publish every view whose tables are given; returns the registered names."""
    done = []
    for name, (build, needs) in VIEWS.items():
        if all(t in tables for t in needs):
            build(*[tables[t] for t in needs]).createOrReplaceTempView(name)
            done.append(name)
    return done
