"""Pipeline stages over the test-table ledger, shared by the registered queries.

Each stage takes ``(spark, root)`` and returns a lazy DataFrame; ``stored_*`` stages write their
result once, as the pipeline does between its steps, because several passes follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decision, dedupe, features, history, outcomes, quality
from ..params import ScoringRun
from ..schemas import INVOICE_COLS, PAYMENT_COLS
from ..session import materialize
from ..sources import testdata

RUNS = [
    ScoringRun("1", "2024-01-01 06:00:00", run_id="run-1", z=1.0),
    ScoringRun("2", "2024-02-01 06:00:00", run_id="run-2", z=1.2816),
]
QUEUE_DATE = "2024-02-01"


# --- silver -------------------------------------------------------------------


def deduped(spark: SparkSession, root: str) -> DataFrame:
    return dedupe.dedupe_events(testdata.bronze(spark, root))


def tagged(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quality.tag_invoices(events), quality.tag_payments(events)


def silver(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean invoices and payments, one row per invoice id each."""
    inv, pay = (quality.split(t)[0] for t in tagged(events))
    return (
        dedupe.dedupe_business_key(inv.select(*INVOICE_COLS)),
        dedupe.dedupe_business_key(pay.select(*PAYMENT_COLS)),
    )


def silver_outcomes(events: DataFrame) -> DataFrame:
    return outcomes.outcomes_from_events(events)


# --- history and features -------------------------------------------------------


def closed(spark: SparkSession, root: str) -> DataFrame:
    """Labelled rows from the orders table alone."""
    return outcomes.labelled(testdata.outcomes(spark, root))


def closed_ledger(spark: SparkSession, root: str) -> DataFrame:
    return outcomes.labelled(testdata.ledger(spark, root))


def cutoff_date(spark: SparkSession, root: str, test_fraction: float = 0.2) -> Column:
    """First posting date of the test fold, as a constant.

    Fitted scalars (this date, the cold-start values) are worked out once and stay fixed for
    everything built on them, as a stored model run would keep them.
    """
    return F.lit(features.cutoff(closed(spark, root), test_fraction).first()["cutoff_date"])


class Folds:
    """Training and test rows of the ledger with what is fitted on the training fold.

    ``paid`` are the training rows without customer attributes: history and defaults need none,
    so they are not joined for them.
    """

    def __init__(self, spark: SparkSession, root: str, with_customer: bool = False):
        bare = closed(spark, root)
        rows = closed_ledger(spark, root) if with_customer else bare
        self.cutoff = cutoff_date(spark, root)
        self.paid = bare.filter(F.col("posting_date") < self.cutoff)
        self.rows = rows
        self.train, self.test = self.split(rows)
        self.defaults = features.fold_defaults(self.paid).first().asDict()

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Training and test rows of a table that holds both."""
        return rows.filter(F.col("posting_date") < self.cutoff), rows.filter(F.col("posting_date") >= self.cutoff)

    def timeline(self) -> DataFrame:
        """The training fold only: right at fitting time."""
        return history.customer_timeline(self.paid)

    def state(self, rows: DataFrame) -> DataFrame:
        return history.history_before(rows, self.paid, self.defaults)

    def encoders(self) -> DataFrame:
        """Stored: a small table of known size that several lookups read."""
        return materialize(features.fit_encoders(self.train), "encoders")


def defaults(spark: SparkSession, root: str) -> dict:
    return Folds(spark, root).defaults


def full_timeline(spark: SparkSession, root: str) -> DataFrame:
    """All cleared invoices: right at serving time."""
    return history.customer_timeline(closed(spark, root))


def fold_features(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Training and test feature matrices, both with training-fold history and encoders."""
    f = Folds(spark, root, with_customer=True)
    codes = f.encoders()
    return tuple(features.encode(features.invoice_features(f.state(r)), codes) for r in (f.train, f.test))


def open_state(
    spark: SparkSession, root: str, with_customer: bool = False, fitted: Folds | None = None
) -> DataFrame:
    rows = testdata.ledger(spark, root) if with_customer else testdata.outcomes(spark, root)
    fixed = (fitted or Folds(spark, root)).defaults
    return history.history_before(outcomes.open_book(rows), closed(spark, root), fixed)


# --- scoring --------------------------------------------------------------------


def open_predictions(spark: SparkSession, root: str, with_customer: bool = False) -> DataFrame:
    return decision.baseline_predict(open_state(spark, root, with_customer))


def stored_open_predictions(spark: SparkSession, root: str, with_customer: bool = False) -> DataFrame:
    return materialize(open_predictions(spark, root, with_customer), "predictions")


def test_scored(spark: SparkSession, root: str, fitted: Folds | None = None) -> DataFrame:
    """Test fold with baseline predictions and the outcome as ``actual``."""
    f = fitted or Folds(spark, root)
    return decision.baseline_predict(f.state(f.test)).withColumn("actual", F.col("days_late"))


def capped(spark: SparkSession, root: str, with_customer: bool = False) -> DataFrame:
    """The open book with its actions, not ranked."""
    stored = stored_open_predictions(spark, root, with_customer)
    return decision.cap_calls(decision.value_predictions(stored))


def queue(spark: SparkSession, root: str, with_customer: bool = True) -> DataFrame:
    stored = stored_open_predictions(spark, root, with_customer)
    ranked = decision.collection_queue(stored, F.lit(QUEUE_DATE).cast("date"))
    return decision.date_range(ranked)


def log(spark: SparkSession, root: str) -> DataFrame:
    """Prediction log of two runs. The second model was cut off later, so it has a shorter
    backtest window."""
    rows = testdata.ledger(spark, root)
    f = Folds(spark, root)
    scope = outcomes.scoring_scope(rows, "both", f.cutoff)
    state = history.history_before(scope, closed(spark, root), f.defaults)
    scored = decision.score_runs(features.invoice_features(state), RUNS)
    later = cutoff_date(spark, root, 0.1)
    return scored.filter(
        (F.col("model_version") == "1") | (F.col("scoring_mode") == "open") | (F.col("posting_date") >= later)
    )


def labels(spark: SparkSession, root: str) -> DataFrame:
    latest = dedupe.latest_prediction(log(spark, root), "invoice_id", "scoring_mode")
    return outcomes.delayed_labels(latest, testdata.payments(spark, root))
