"""Joining payments back as delayed labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CREATED, INVOICE_COLS, PAID
from .quality import REASON, tag_events


def join_outcomes(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Attach the payment; unpaid invoices survive with a NULL label. ``days_late`` is signed."""
    # Events carry an empty clear_date on creation rows; the payment's is the one that counts.
    bare = invoices.drop("clear_date")
    return bare.join(payments.select("invoice_id", "clear_date"), "invoice_id", "left").withColumns(
        {
            "days_late": F.datediff("clear_date", "due_date"),
            "is_open": F.col("clear_date").isNull().cast("int"),
        }
    )


def outcomes_from_events(deduped: DataFrame) -> DataFrame:
    """Validate, keep one row per invoice id and attach the payment, in one pass over the events.

    Same rows as validating, deduplicating and joining the two event types separately, but the
    events are read and shuffled once: creation and payment of an invoice meet in one group. Of
    several clean rows for an id the latest ingestion wins, then the smallest event id; copies
    are reduced before the shuffle.
    """
    tagged = tag_events(deduped).filter(F.col(REASON).isNull())
    newest = F.struct(-F.unix_micros(F.col("_ingested_at").cast("timestamp")), "_event_id")
    created, paid = F.col("event_type") == CREATED, F.col("event_type") == PAID
    columns = [c for c in INVOICE_COLS if c != "invoice_id"]
    return (
        tagged.groupBy("invoice_id")
        .agg(
            F.min_by(F.struct(*columns), F.when(created, newest)).alias("i"),
            F.min_by("clear_date", F.when(paid, newest)).alias("clear_date"),
        )
        .filter("i is not null")
        .select("invoice_id", "i.*", "clear_date")
        .withColumns(
            {
                "days_late": F.datediff("clear_date", "due_date"),
                "is_open": F.col("clear_date").isNull().cast("int"),
            }
        )
    )


def delayed_labels(latest: DataFrame, payments: DataFrame) -> DataFrame:
    """Predictions with the outcome that has arrived since; waiting rows stay."""
    return latest.join(payments.select("invoice_id", "clear_date"), "invoice_id", "left").withColumns(
        {
            "actual_days_late": F.datediff("clear_date", "due_date"),
            "has_label": F.col("clear_date").isNotNull(),
            "label_lag_days": F.datediff("clear_date", "posting_date"),
        }
    )


def orphan_payments(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Payments whose invoice never reached silver (a left join would lose them silently)."""
    return payments.join(invoices.select("invoice_id"), "invoice_id", "left_anti")


def labelled(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter((F.col("is_open") == 0) & F.col("days_late").isNotNull())


def open_book(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("is_open") == 1)


def scoring_scope(outcomes: DataFrame, scope: str, cutoff: Column) -> DataFrame:
    """Rows to score, tagged ``scoring_mode``: the open book, the closed test window or both."""
    mode = F.when(F.col("is_open") == 1, "open").when(
        (F.col("is_open") == 0) & (F.col("posting_date") >= cutoff), "backtest"
    )
    wanted = {"open": ["open"], "backtest": ["backtest"], "both": ["open", "backtest"]}[scope]
    return outcomes.withColumn("scoring_mode", mode).filter(F.col("scoring_mode").isin(wanted))


def lateness_summary(outcomes: DataFrame) -> DataFrame:
    """Overall figures over cleared invoices. ``days_late`` has few distinct values (days),
    so the exact percentile stays small."""
    return labelled(outcomes).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("days_late").alias("avg_days_late"),
        F.percentile("days_late", F.lit(0.5)).alias("median_days_late"),
        F.avg((F.col("days_late") > 0).cast("double")).alias("late_rate"),
    )
