"""Model quality: error metrics, AUC, calibration, business value.

Input rows carry ``actual`` (days late), ``days_late_pred``, ``days_late_lower`` and
``days_late_upper``. ``by`` names a label with few values (a model version); without it there
is one result row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..params import DecisionParams
from .decision import value_predictions
from .ordering import prefix_sums, quantile_bucket, quantile_values, quantiles, sample_n, top_n

PCT = 100.0


def _label(by: str | None) -> tuple[str, Column]:
    return (by, F.col(by)) if by else ("_all", F.lit(0))


def _inside() -> Column:
    return F.col("actual").between(F.col("days_late_lower"), F.col("days_late_upper"))


def _width() -> Column:
    return F.col("days_late_upper") - F.col("days_late_lower")


def late_auc(df: DataFrame, score: str = "p_late", actual: str = "actual", by: str | None = None) -> DataFrame:
    """Tie-corrected AUC of a score against ``actual > 0``; NULL when only one class occurs.

    Rows are counted per distinct score first; each positive then beats all negatives below it
    and half of those it ties with.
    """
    name, label = _label(by)
    late = F.col(actual) > 0
    known = df.filter(F.col(actual).isNotNull() & F.col(score).isNotNull())
    tallies = known.groupBy(label.alias(name), F.col(score).cast("double").alias("_score")).agg(
        F.count_if(late).alias("_pos"), F.count_if(~late).alias("_neg")
    )
    running = prefix_sums(tallies, [F.col(name), F.col("_score")], {"_upto": "_neg"})
    wins = F.col("_pos") * (F.col("_upto").cast("double") - F.col("_neg") / F.lit(2.0))
    per = running.groupBy(name).agg(
        F.sum(wins).alias("_wins"),
        F.sum("_pos").cast("double").alias("_p"),
        F.sum("_neg").cast("double").alias("_n"),
        F.max("_upto").cast("double").alias("_end"),
    )
    # Negatives of labels that sort earlier were counted too: take them off again.
    auc = F.try_divide(F.col("_wins") - (F.col("_end") - F.col("_n")) * F.col("_p"), F.col("_p") * F.col("_n"))
    out = per.select(name, auc.alias("late_auc"))
    return out if by else out.drop(name)


def error_metrics(df: DataFrame, by: str | None = None) -> DataFrame:
    """Everything of ``model_metrics`` that needs no ordering, in one aggregation."""
    name, label = _label(by)
    y, e = F.col("actual").cast("double"), F.col("actual") - F.col("days_late_pred")
    share = lambda cond: F.avg(cond.cast("double")) * PCT
    out = df.groupBy(label.alias(name)).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        # try_divide: no variance in the outcome means there is no r2.
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg(-e).alias("bias"),
        share(F.abs(e) <= 1).alias("within_1d"),
        share(F.abs(e) <= 3).alias("within_3d"),
        share(F.abs(e) <= 7).alias("within_7d"),
        share(_inside()).alias("pi_coverage"),
        F.avg(_width()).alias("pi_mean_width"),
    )
    return out if by else out.drop(name)


def model_metrics(df: DataFrame, by: str | None = None, digits: int | None = None) -> DataFrame:
    """All eleven metrics. ``digits`` rounds the AUC score first (scores equal to that many
    digits then count as ties)."""
    score = S.p_late(F.col("days_late_lower"), F.col("days_late_upper"))
    rows = df.withColumns(
        {
            "_score": F.round(score, digits) if digits is not None else score,
            "_abs_error": F.abs(F.col("actual") - F.col("days_late_pred")),
        }
    )
    if by is None:
        median = quantile_values(rows, "_abs_error", [0.5])
        return error_metrics(rows).withColumns(
            {
                "median_ae": F.lit(median[0] if median else None).cast("double"),
                "late_auc": late_auc(rows, "_score").scalar(),
            }
        )
    median = quantiles(rows, "_abs_error", [0.5], by=by).select(by, F.col("value").alias("median_ae"))
    # One row per label on every side.
    return (
        error_metrics(rows, by)
        .join(median, by, "left")
        .join(late_auc(rows, "_score", by=by), by, "left")
    )


METRICS = [
    "mae",
    "rmse",
    "median_ae",
    "r2",
    "bias",
    "within_1d",
    "within_3d",
    "within_7d",
    "pi_coverage",
    "pi_mean_width",
    "late_auc",
]


def calibration_by_quantile(df: DataFrame, buckets: int = 6) -> DataFrame:
    """Coverage per equal-count bucket of interval width."""
    tagged = quantile_bucket(df.withColumn("width", _width()), "width", buckets, "bucket")
    return tagged.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg(_inside().cast("double")) * PCT).alias("coverage"),
        F.avg("width").alias("mean_width"),
    )


def calibration_fixed(df: DataFrame) -> DataFrame:
    """Coverage for narrow (<3d), medium (3-8d) and wide (>8d) intervals, with the overall
    label. All three rows are present; coverage is NULL where a bucket is empty."""
    width, inside = _width(), _inside().cast("double")
    bounds = [("narrow", width < 3), ("medium", (width >= 3) & (width <= 8)), ("wide", width > 8)]
    rows = [
        F.struct(
            F.lit(name).alias("bucket"),
            F.count_if(cond).alias("n"),
            (F.avg(F.when(cond, inside)) * PCT).alias("coverage"),
        )
        for name, cond in bounds
    ]
    overall = F.avg(inside) * PCT
    return df.agg(
        F.array(*rows).alias("r"), S.calibration_label(overall).alias("calibration"), F.avg(width).alias("mean_width")
    ).select(F.inline("r"), "calibration", "mean_width")


def history_depth(count: Column) -> Column:
    """Fixed buckets of how many cleared invoices were known."""
    return (
        F.when(count <= 0, "0 (cold)")
        .when(count <= 2, "1-2")
        .when(count <= 10, "3-10")
        .when(count <= 50, "11-50")
        .otherwise("50+")
    )


def error_by_segment(df: DataFrame) -> DataFrame:
    """Mean absolute error by history depth and by amount quintile, one long table."""
    tagged = quantile_bucket(df, "invoice_amount", 5, "_q")
    pairs = F.explode(
        F.array(
            F.struct(F.lit("history_depth").alias("segment"), history_depth(F.col("cust_invoice_count")).alias("bucket")),
            F.struct(F.lit("amount_quintile").alias("segment"), F.concat(F.lit("Q"), F.col("_q") + 1).alias("bucket")),
        )
    ).alias("s")
    error = F.abs(F.col("actual") - F.col("days_late_pred"))
    return (
        tagged.select(pairs, error.alias("_e"))
        .groupBy("s.segment", "s.bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("_e").alias("mae"))
    )


def amount_deciles(df: DataFrame) -> DataFrame:
    """Lateness by decile of invoice amount."""
    tagged = quantile_bucket(df, "invoice_amount", 10, "amount_decile")
    return tagged.groupBy("amount_decile").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("days_late").alias("avg_late"),
        F.avg((F.col("days_late") > 0).cast("double")).alias("late_rate"),
        F.avg("invoice_amount").alias("avg_amount"),
    )


def business_metrics(predictions: DataFrame, p: DecisionParams = DecisionParams()) -> DataFrame:
    """Value of the ranking: EV of the top n by engine, by amount and at random, and the number
    of invoices worth a call. Compares orderings under the engine's own assumptions."""
    valued = value_predictions(predictions, p).select("invoice_id", "invoice_amount", "expected_value")
    ident, n = F.col("invoice_id").asc(), p.daily_capacity
    picks = {
        "ev_decision_engine": top_n(valued, n, F.col("expected_value").desc(), ident),
        "ev_by_amount": top_n(valued, n, F.col("invoice_amount").desc(), ident),
        "ev_random": sample_n(valued, n, "invoice_id"),
    }
    total = lambda df: df.agg(F.sum("expected_value")).scalar()
    out = valued.agg(F.count_if(F.col("expected_value") > 0).alias("positive_ev_invoices"))
    out = out.withColumns({name: total(df) for name, df in picks.items()})
    return out.withColumn("ev_uplift_vs_by_amount", F.col("ev_decision_engine") - F.col("ev_by_amount"))


def asymmetric_loss(df: DataFrame, n: int = 100) -> DataFrame:
    """Squared error against a loss that punishes under-prediction of large invoices, over the
    n most valuable predictions (the report is about the head of the queue)."""
    head = top_n(df, n, F.col("expected_value").desc(), F.col("invoice_id").asc())
    error = F.bround(F.col("actual") - F.col("days_late_pred"), 0)
    squared = error * error
    weighted = squared * (F.col("invoice_amount") / 10000.0) * F.when(error > 0, 2.0).otherwise(0.5)
    large = F.col("invoice_amount") > 50_000
    return head.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(squared).alias("mean_symmetric_loss"),
        F.avg(weighted).alias("mean_asymmetric_loss"),
        F.count_if((error == 3) & large).alias("under_predicted_cases"),
        F.count_if((error == -3) & large).alias("over_predicted_cases"),
    )


def coverage_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(F.date_format("posting_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), (F.avg(_inside().cast("double")) * PCT).alias("coverage")
    )


def confusion(df: DataFrame) -> DataFrame:
    """Late flag against the outcome, with precision and recall (NULL without a base)."""
    said, was = F.col("days_late_pred") > 0, F.col("actual") > 0
    return df.agg(
        F.count_if(said & was).alias("true_late"),
        F.count_if(said & ~was).alias("false_late"),
        F.count_if(~said & was).alias("missed_late"),
        F.count_if(~said & ~was).alias("true_on_time"),
    ).withColumns(
        {
            "precision": F.try_divide(F.col("true_late"), F.col("true_late") + F.col("false_late")),
            "recall": F.try_divide(F.col("true_late"), F.col("true_late") + F.col("missed_late")),
        }
    )


def naive_baseline(train_mean: Column, test: DataFrame) -> DataFrame:
    """Predicting the training mean for every row, and how much the model improves on it."""
    y = F.col("actual")
    return test.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - train_mean)).alias("naive_mae"),
        F.sqrt(F.avg((y - train_mean) * (y - train_mean))).alias("naive_rmse"),
        F.avg(F.abs(y - F.col("days_late_pred"))).alias("model_mae"),
    ).withColumn("improvement_pct", (1 - F.try_divide(F.col("model_mae"), F.col("naive_mae"))) * PCT)
