"""Ingestion and silver-stage queries."""

from pyspark.sql import functions as F

from ..operators import dedupe, outcomes, quality
from ..session import materialize
from ..sources import events as event_source
from ..sources import testdata
from . import stages
from .registry import query, tidy
from .sqlkit import out

EVENT_OUT = (
    "_event_id _source event_type event_timestamp invoice_id customer_id customer_name invoice_amount:m "
    "posting_date due_date payment_terms business_code clear_date"
)


@query("ledger_events", f"SELECT {out(EVENT_OUT)} FROM feed")
def ledger_events(spark, root):
    return tidy(event_source.ledger_events(testdata.ledger(spark, root)), money="invoice_amount")


@query("fault_injection", f"SELECT {out(EVENT_OUT)}, _ingested_at FROM bronze")
def fault_injection(spark, root):
    return tidy(testdata.bronze(spark, root), money="invoice_amount")


@query("dedupe_events", f"SELECT {out(EVENT_OUT)}, _ingested_at FROM deduped")
def dedupe_events(spark, root):
    return tidy(stages.deduped(spark, root), money="invoice_amount")


@query("validate_invoices", "SELECT _event_id, invoice_id, posting_date, due_date, reason FROM inv_tagged")
def validate_invoices(spark, root):
    rows = quality.tag_invoices(stages.deduped(spark, root))
    return rows.select(
        "_event_id", "invoice_id", "posting_date", "due_date", F.col(quality.REASON).alias("reason")
    )


@query("validate_payments", "SELECT _event_id, invoice_id, clear_date, reason FROM pay_tagged")
def validate_payments(spark, root):
    rows = quality.tag_payments(stages.deduped(spark, root))
    return rows.select("_event_id", "invoice_id", "clear_date", F.col(quality.REASON).alias("reason"))


@query("quarantine_union", "SELECT * FROM rejected")
def quarantine_union(spark, root):
    return quality.quarantine(*stages.tagged(stages.deduped(spark, root)))


@query(
    "business_key_dedupe",
    f"""SELECT {out("invoice_id customer_id customer_name invoice_amount:m posting_date due_date payment_terms business_code _event_id _ingested_at")}
    FROM silver_inv""",
)
def business_key_dedupe(spark, root):
    return tidy(stages.silver(stages.deduped(spark, root))[0], money="invoice_amount")


@query(
    "duplicate_report",
    "SELECT _event_id, CAST(count(*) AS BIGINT) AS n FROM bronze GROUP BY _event_id HAVING count(*) > 1",
)
def duplicate_report(spark, root):
    return dedupe.duplicate_report(testdata.bronze(spark, root), "_event_id")


DQ = """
SELECT s.stage, CAST(b.rows_in AS BIGINT) AS rows_in, CAST(s.rows_stage AS BIGINT) AS rows_stage,
  CAST(s.rows_clean AS BIGINT) AS rows_clean, CAST(s.rows_stage - s.rows_clean AS BIGINT) AS rows_quarantined,
  round((s.rows_stage - s.rows_clean) / CAST(b.rows_in AS DOUBLE), 6) AS reject_rate,
  r.reason, CAST(r.n AS BIGINT) AS n
FROM (SELECT stage, count(*) AS rows_stage, count(*) FILTER (WHERE reason IS NULL) AS rows_clean FROM tagged GROUP BY stage) s
CROSS JOIN (SELECT count(*) AS rows_in FROM bronze) b
LEFT JOIN (SELECT stage, reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY stage, reason) r ON r.stage = s.stage
"""
TAGGED = "(SELECT 'invoices' AS stage, reason FROM inv_tagged UNION ALL SELECT 'payments', reason FROM pay_tagged)"


def _dq(spark, root):
    # Two passes (all rows, then the deduplicated ones) over what is a stored table in production.
    bronze = materialize(testdata.bronze(spark, root), "bronze")
    counts = quality.reason_counts(*stages.tagged(dedupe.dedupe_events(bronze)))
    rows_in = bronze.agg(F.count(F.lit(1))).scalar()
    return quality.dq_metrics(counts, rows_in, F.to_timestamp_ntz(F.lit(testdata.REPLAYED_AT)))


@query("dq_metrics", DQ.replace("FROM tagged", f"FROM {TAGGED} t"))
def dq_metrics(spark, root):
    flat = _dq(spark, root).select(
        "stage",
        "rows_in",
        "rows_stage",
        "rows_clean",
        "rows_quarantined",
        "reject_rate",
        F.explode_outer("reject_reasons").alias("reason", "n"),
    )
    return tidy(flat)


SILVER_OUT = (
    "invoice_id customer_id customer_name invoice_amount:m posting_date due_date payment_terms business_code "
    "clear_date days_late:i is_open:i"
)


@query("outcomes", f"SELECT {out(SILVER_OUT)} FROM silver_out")
def outcome_join(spark, root):
    rows = stages.silver_outcomes(stages.deduped(spark, root))
    return tidy(rows.drop("_event_id", "_ingested_at"), money="invoice_amount")


@query(
    "orphan_payments",
    "SELECT invoice_id, clear_date FROM silver_pay p WHERE NOT EXISTS (SELECT 1 FROM silver_inv i WHERE i.invoice_id = p.invoice_id)",
)
def orphan_payments(spark, root):
    inv, pay = stages.silver(stages.deduped(spark, root))
    return outcomes.orphan_payments(pay, inv).select("invoice_id", "clear_date")


@query(
    "lateness_summary",
    """SELECT CAST(count(*) AS BIGINT) AS n, round(avg(days_late), 6) AS avg_days_late,
      round(CAST(quantile_cont(days_late, 0.5) AS DOUBLE), 6) AS median_days_late,
      round(avg(CAST(days_late > 0 AS DOUBLE)), 6) AS late_rate FROM labelled""",
)
def lateness_summary(spark, root):
    return tidy(outcomes.lateness_summary(testdata.outcomes(spark, root)))


@query(
    "group_counts",
    """SELECT 'event_type' AS grouping, event_type AS value, CAST(count(*) AS BIGINT) AS n FROM bronze GROUP BY event_type
    UNION ALL SELECT 'reject_reason', _reject_reason, CAST(count(*) AS BIGINT) FROM rejected GROUP BY _reject_reason
    UNION ALL SELECT 'scoring_mode', scoring_mode || ':' || CAST(has_label AS VARCHAR), CAST(count(*) AS BIGINT) FROM outcome_labels GROUP BY scoring_mode, has_label
    UNION ALL SELECT 'model_version', model_version, CAST(count(*) AS BIGINT) FROM pred_log GROUP BY model_version""",
)
def group_counts(spark, root):
    def count_by(df, grouping, value):
        return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(grouping).alias("grouping"), "value", "n"
        )

    rejected = quality.quarantine(*stages.tagged(stages.deduped(spark, root)))
    mode = F.concat_ws(":", "scoring_mode", F.col("has_label").cast("string"))
    return (
        count_by(testdata.bronze(spark, root), "event_type", F.col("event_type"))
        .unionByName(count_by(rejected, "reject_reason", F.col("_reject_reason")))
        .unionByName(count_by(stages.labels(spark, root), "scoring_mode", mode))
        .unionByName(count_by(stages.log(spark, root), "model_version", F.col("model_version")))
    )


@query(
    "coverage_summary",
    """SELECT CAST(count(*) AS BIGINT) AS invoices, CAST(sum(is_open) AS BIGINT) AS open_invoices,
      CAST(sum(1 - is_open) AS BIGINT) AS closed_invoices, min(posting_date) AS first_posting,
      max(posting_date) AS last_posting, sum(is_open) > 0 AS has_open FROM ledger""",
)
def coverage_summary(spark, root):
    from ..operators.profile import coverage_summary as summarize

    return tidy(summarize(testdata.outcomes(spark, root)))
