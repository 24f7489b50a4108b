"""Pipeline guardrails. Each check yields one row ``(check, violations)``; 0 means passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import HIST_COLS, TIERS
from ..session import materialize, scalar_row
from .dedupe import duplicate_report


def _check(name: str, df: DataFrame, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def _count(name: str, df: DataFrame) -> DataFrame:
    return _check(name, df, F.count(F.lit(1)))


def watched(df: DataFrame, checks: dict[str, Column], label: str = "guarded") -> tuple[DataFrame, DataFrame]:
    """Write ``df`` once and count on the way what violates ``checks`` (an aggregate for each name), so
    that a guard needs no scan of its own. Returns the written table and the report."""
    spark, seen = df.sparkSession, Observation()
    counts = {n: F.coalesce(c, F.lit(0)).cast("long") for n, c in checks.items()}
    stored = materialize(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), label)
    found = seen.get
    if not set(counts) <= set(found):  # a plan known to be empty observes nothing
        return stored, union([_check(n, stored, c) for n, c in checks.items()])
    return stored, spark.createDataFrame([(n, found[n]) for n in counts], "check string, violations long")


def history_checks() -> dict[str, Column]:
    """History dated on or after the posting date, or after the invoice's own payment (needs
    ``_hist_asof`` kept by the join)."""
    return {
        "history_before_posting": F.count_if(F.col("_hist_asof") >= F.col("posting_date")),
        "own_outcome_unseen": F.count_if(F.col("_hist_asof") >= F.col("clear_date")),
    }


def scoring_checks() -> dict[str, Column]:
    """Something to score, open rows present."""
    return {
        "rows_to_score": F.when(F.count(F.lit(1)) > 0, 0).otherwise(1),
        "open_rows_present": F.when(F.count_if(F.col("is_open") == 1) > 0, 0).otherwise(1),
    }


def union(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def silver(invoices: DataFrame) -> DataFrame:
    """No null id, unique ids, due on or after posting."""
    nulls = _check("silver_null_id", invoices, F.count_if(F.col("invoice_id").isNull()))
    unique = _count("silver_unique_id", duplicate_report(invoices, "invoice_id"))
    dates = _check("silver_due_after_posting", invoices, F.count_if(F.col("due_date") < F.col("posting_date")))
    return union([nulls, unique, dates])


def same_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """The as-of join neither drops nor duplicates invoices."""
    n = scalar_row(before.agg(F.count(F.lit(1)).alias("n")))["n"]
    return _check("asof_row_count", after, F.abs(F.count(F.lit(1)) - F.first(n)))


def history_before_posting(asof: DataFrame) -> DataFrame:
    """No history dated on or after the posting date (needs ``_hist_asof`` kept by the join)."""
    return _check("history_before_posting", asof, history_checks()["history_before_posting"])


def cleared_after_posting(outcomes: DataFrame) -> DataFrame:
    """Reported, never aborted on: payments dated before their invoice."""
    return _check("cleared_after_posting", outcomes, F.count_if(F.col("clear_date") < F.col("posting_date")))


def own_outcome_unseen(asof: DataFrame) -> DataFrame:
    """The state an invoice sees is older than its own payment."""
    return _check("own_outcome_unseen", asof, history_checks()["own_outcome_unseen"])


def timeline_key(timeline: DataFrame) -> DataFrame:
    return _count("timeline_unique_key", duplicate_report(timeline, "customer_id", "clear_date"))


def cold_start_defaults(asof: DataFrame, defaults: DataFrame) -> DataFrame:
    """Rows without history carry exactly the given defaults."""
    row = scalar_row(defaults)
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(row[c]) for c in HIST_COLS])
    return _check("cold_start_defaults", asof.withColumn("_bad", F.col("_hist_asof").isNull() & differs), F.count_if("_bad"))


def folds(folded: DataFrame, timeline: DataFrame, last_train_clear: DataFrame) -> DataFrame:
    """Folds do not overlap in time, and the training history ends inside the training fold."""
    last_train = F.max(F.when(F.col("fold") == "train", F.col("posting_date")))
    first_test = F.min(F.when(F.col("fold") == "test", F.col("posting_date")))
    apart = _check("folds_disjoint", folded, F.when(last_train >= first_test, 1).otherwise(0))
    latest = scalar_row(last_train_clear)["last_clear"]
    inside = _check(
        "timeline_in_train", timeline.withColumn("_bad", F.col("clear_date") > latest), F.count_if("_bad")
    )
    return union([apart, inside])


def interval_order(predictions: DataFrame) -> DataFrame:
    return _check(
        "interval_order", predictions, F.count_if(F.col("days_late_lower") > F.col("days_late_upper"))
    )


def scoring_input(features: DataFrame, required: list[str]) -> DataFrame:
    """Something to score, open rows present, required columns present."""
    missing = [c for c in required if c not in features.columns]
    some = [_check(n, features, c) for n, c in scoring_checks().items()]
    return union([*some, _check("input_columns", features.limit(1), F.lit(len(missing)))])


def queue(queue_rows: DataFrame, predictions: DataFrame, capacity: int) -> DataFrame:
    """Same count as scored, calls within capacity, known tiers, ranks set, CALL in EV order."""
    n = scalar_row(predictions.agg(F.count(F.lit(1)).alias("n")))["n"]
    calls = F.count_if(F.col("action") == "CALL")
    # The CALL slice holds at most ``capacity`` rows.
    before = F.lag("expected_value").over(Window.orderBy("rank"))
    steps = queue_rows.filter("action = 'CALL'").select((F.col("expected_value") > before).alias("_bad"))
    return union(
        [
            _check("queue_count", queue_rows, F.abs(F.count(F.lit(1)) - F.first(n))),
            _check("queue_capacity", queue_rows, F.greatest(calls - capacity, F.lit(0))),
            _check("queue_tiers", queue_rows, F.count_if(~F.col("action").isin(TIERS))),
            _check("queue_rank_set", queue_rows, F.count_if(F.col("rank").isNull())),
            _check("queue_call_order", steps, F.count_if("_bad")),
        ]
    )


def backtest_labels(joined: DataFrame) -> DataFrame:
    """Performance needs at least one labelled backtest prediction."""
    have = F.count_if(F.col("has_label") & (F.col("scoring_mode") == "backtest"))
    return _check("backtest_labels", joined, F.when(have > 0, 0).otherwise(1))
