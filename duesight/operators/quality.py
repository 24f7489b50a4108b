"""Validation, quarantine and data-quality metrics of the silver stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import safe_date
from ..params import MAX_PLAUSIBLE_AMOUNT
from ..schemas import CREATED, PAID, QUARANTINE_COLS

REASON = "_reject_reason"


def _first_failure(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that is broken, NULL when none is."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])


# Rule names and their order.
def _invoice_rules() -> list[tuple[str, Column]]:
    return [
        ("null_invoice_id", F.col("invoice_id").isNull()),
        ("null_customer_id", F.col("customer_id").isNull()),
        ("unparseable_posting_date", F.col("posting_date").isNull()),
        ("unparseable_due_date", F.col("due_date").isNull()),
        ("due_before_posting", F.col("due_date") < F.col("posting_date")),
        ("null_amount", F.col("invoice_amount").isNull()),
        ("implausible_amount", F.abs("invoice_amount") > MAX_PLAUSIBLE_AMOUNT),
    ]


def _payment_rules() -> list[tuple[str, Column]]:
    return [
        ("null_invoice_id", F.col("invoice_id").isNull()),
        ("unparseable_clear_date", F.col("clear_date").isNull()),
    ]


def tag_invoices(events: DataFrame) -> DataFrame:
    """Creation events with parsed dates and the reason they are rejected, if any.

    Negative amounts are credit notes and valid.
    """
    parsed = events.filter(F.col("event_type") == CREATED).withColumns(
        {"posting_date": safe_date("posting_date"), "due_date": safe_date("due_date")}
    )
    return parsed.withColumn(REASON, _first_failure(_invoice_rules()))


def tag_payments(events: DataFrame) -> DataFrame:
    parsed = events.filter(F.col("event_type") == PAID).withColumn(
        "clear_date", safe_date("clear_date")
    )
    return parsed.withColumn(REASON, _first_failure(_payment_rules()))


def tag_events(events: DataFrame) -> DataFrame:
    """Both event types tagged in one pass, each by its own rules."""
    parsed = events.filter(F.col("event_type").isin(CREATED, PAID)).withColumns(
        {c: safe_date(c) for c in ("posting_date", "due_date", "clear_date")}
    )
    reason = F.when(F.col("event_type") == CREATED, _first_failure(_invoice_rules())).otherwise(
        _first_failure(_payment_rules())
    )
    return parsed.withColumn(REASON, reason)


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) - rejected rows are kept aside, never dropped."""
    clean = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    return clean, tagged.filter(F.col(REASON).isNotNull())


def quarantine(tagged_invoices: DataFrame, tagged_payments: DataFrame) -> DataFrame:
    """All rejected rows of both stages in one contract."""
    rejected = [split(t)[1].select(*QUARANTINE_COLS) for t in (tagged_invoices, tagged_payments)]
    return rejected[0].unionByName(rejected[1])


def reason_counts(tagged_invoices: DataFrame, tagged_payments: DataFrame) -> DataFrame:
    """Rows per (stage, reason); the clean rows have a NULL reason. One pass over each stage."""
    stages = [("invoices", tagged_invoices), ("payments", tagged_payments)]
    tagged = [t.select(F.lit(name).alias("stage"), REASON) for name, t in stages]
    return (
        tagged[0]
        .unionByName(tagged[1])
        .groupBy("stage", REASON)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dq_metrics(counts: DataFrame, rows_in: Column, run_at: Column) -> DataFrame:
    """One row per stage from ``reason_counts``.

    ``rows_in`` is the caller's denominator (usually the whole bronze table, replays and both
    event types included); ``rows_stage`` is what this stage saw.
    """
    bad = F.when(F.col(REASON).isNotNull(), F.col("n"))
    return (
        counts.groupBy("stage")
        .agg(
            F.sum("n").alias("rows_stage"),
            F.coalesce(F.sum(F.when(F.col(REASON).isNull(), F.col("n"))), F.lit(0)).alias("rows_clean"),
            F.coalesce(F.sum(bad), F.lit(0)).alias("rows_quarantined"),
            # At most one entry per rule.
            F.map_from_entries(
                F.array_sort(F.collect_list(F.when(F.col(REASON).isNotNull(), F.struct(REASON, "n"))))
            ).alias("reject_reasons"),
        )
        .select(
            "stage",
            rows_in.cast("long").alias("rows_in"),
            "rows_stage",
            "rows_clean",
            "rows_quarantined",
            F.coalesce(F.try_divide(F.col("rows_quarantined"), rows_in), F.lit(0.0)).alias("reject_rate"),
            "reject_reasons",
            run_at.alias("run_timestamp"),
        )
    )


def dq_metrics_simple(
    stage: str, rows_in: int, clean: DataFrame, rejected: DataFrame
) -> DataFrame:
    """The metrics of one stage from its (clean, quarantined) pair, as one plan."""
    tagged = clean.select(F.lit(None).cast("string").alias(REASON)).unionByName(rejected.select(REASON))
    counts = tagged.groupBy(F.lit(stage).alias("stage"), REASON).agg(F.count(F.lit(1)).alias("n"))
    return dq_metrics(counts, F.lit(rows_in), F.current_timestamp())
