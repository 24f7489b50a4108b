"""Exploratory profile queries."""

from pyspark.sql import functions as F

from ..operators import history, profile
from ..operators.features import encode, invoice_features
from ..schemas import FEATURE_COLS
from ..session import materialize
from ..sources import testdata
from . import stages
from .registry import query, tidy
from .sqlkit import out

PROFILED = {
    "invoice_id": "string",
    "customer_id": "string",
    "customer_name": "string",
    "invoice_amount": "double",
    "posting_date": "date",
    "due_date": "date",
    "payment_terms": "string",
    "business_code": "string",
    "is_open": "int",
    "days_late": "int",
    "clear_date": "date",
}


@query(
    "column_profile",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS nulls,
        round((count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100, 6) AS null_pct, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM ledger"""
        for c, t in PROFILED.items()
    ),
)
def column_profile(spark, root):
    return tidy(profile.column_profile(testdata.ledger(spark, root), list(PROFILED)))


DESCRIBED = ["days_late_pred", "days_late_lower", "days_late_upper", "cust_invoice_count"]


@query(
    "describe",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM open_pred"""
        for c in DESCRIBED
    ),
)
def describe(spark, root):
    rows = materialize(stages.open_predictions(spark, root).select(*DESCRIBED), "predictions")
    return tidy(profile.describe(rows, DESCRIBED))


@query(
    "shape_stats",
    f"""SELECT {out("n:i late_share:d on_time_share:d very_late_share:d skewness:d kurtosis:d")} FROM (
      SELECT count(*) AS n, avg(CAST(days_late > 0 AS DOUBLE)) AS late_share, avg(CAST(days_late <= 0 AS DOUBLE)) AS on_time_share,
        avg(CAST(days_late > 30 AS DOUBLE)) AS very_late_share,
        avg(power(days_late - m, 3)) / power(avg(power(days_late - m, 2)), 1.5) AS skewness,
        avg(power(days_late - m, 4)) / power(avg(power(days_late - m, 2)), 2) - 3 AS kurtosis
      FROM labelled, (SELECT avg(days_late) AS m FROM labelled) x) y""",
)
def shape_stats(spark, root):
    return tidy(profile.shape_stats(stages.closed(spark, root)))


def _rates(key: str, least: int) -> str:
    return f"""SELECT {key}, CAST(count(*) AS BIGINT) AS n, round(avg(days_late), 6) AS avg_late,
      round(avg(CAST(days_late > 0 AS DOUBLE)), 6) AS late_rate, round(avg(invoice_amount), 2) AS avg_amount
    FROM labelled GROUP BY {key} HAVING count(*) >= {least}"""


@query("terms_rates", _rates("payment_terms", 200))
def terms_rates(spark, root):
    rows = profile.grouped_rates(stages.closed(spark, root), "payment_terms", min_rows=200)
    return tidy(rows.orderBy(F.col("avg_late").desc(), "payment_terms"), money="avg_amount")


@query("business_rates", _rates("business_code", 1))
def business_rates(spark, root):
    return tidy(profile.grouped_rates(stages.closed_ledger(spark, root), "business_code"), money="avg_amount")


@query(
    "concentration",
    """SELECT CAST(t AS BIGINT) AS max_invoices, CAST(count(*) FILTER (WHERE n <= t) AS BIGINT) AS customers,
      round(coalesce(sum(n) FILTER (WHERE n <= t), 0) / CAST(sum(n) AS DOUBLE) * 100, 6) AS pct_rows
    FROM (SELECT customer_id, count(*) AS n FROM labelled GROUP BY 1) c, (VALUES (1), (2), (5), (10)) v(t) GROUP BY t""",
)
def concentration(spark, root):
    return tidy(profile.concentration(stages.closed(spark, root)))


@query(
    "monthly",
    """SELECT last_day(CAST(m AS DATE)) AS month_end, round(avg_late, 6) AS avg_late, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM (SELECT unnest(generate_series(date_trunc('month', min(posting_date)), date_trunc('month', max(posting_date)), INTERVAL 1 MONTH)) AS m FROM labelled) s
    LEFT JOIN (SELECT date_trunc('month', posting_date) AS mm, avg(days_late) AS avg_late, count(*) AS n FROM labelled GROUP BY 1) a ON a.mm = s.m""",
)
def monthly(spark, root):
    return tidy(profile.monthly(stages.closed(spark, root)))


def _hist(expr: str, rows: str, low: int, high: int, width: float) -> str:
    last = int(round((high - low) / width)) - 1
    return f"""SELECT bin, CAST(count(*) AS BIGINT) AS n, round({float(low)} + bin * {float(width)}::DOUBLE, 6) AS bin_start FROM (
      SELECT CAST(least(floor((greatest(least(CAST({expr} AS DOUBLE), {high}), {low}) - {low}) / {width}::DOUBLE), {last}) AS BIGINT) AS bin
      FROM {rows}) x GROUP BY bin"""


@query("histogram", _hist("days_late", "labelled", -40, 60, 1))
def histogram(spark, root):
    return tidy(profile.histogram(stages.closed(spark, root), F.col("days_late"), -40, 60, 1))


@query("histogram_lag", _hist("label_lag_days", "outcome_labels WHERE has_label", 0, 120, 2))
def histogram_lag(spark, root):
    return tidy(profile.histogram(stages.labels(spark, root), F.col("label_lag_days"), 0, 120, 2))


@query("histogram_residual", _hist("days_late_pred - actual", "test_scored", -40, 40, 1))
def histogram_residual(spark, root):
    rows = stages.test_scored(spark, root)
    return tidy(profile.histogram(rows, F.col("days_late_pred") - F.col("actual"), -40, 40, 1))


@query("histogram_depth", _hist("log10(n)", "(SELECT count(*) AS n FROM labelled GROUP BY customer_id)", 0, 3, 0.1))
def histogram_depth(spark, root):
    per = stages.closed(spark, root).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return tidy(profile.histogram(per, F.log10("n"), 0, 3, 0.1))


CORRELATED = [*FEATURE_COLS, "days_late"]


def _corr_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1 :]]
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM train_features" for a, b in pairs
    )


@query("correlations", _corr_sql())
def correlations(spark, root):
    f = stages.Folds(spark, root, with_customer=True)
    train = encode(invoice_features(f.state(f.train)), f.encoders())
    return tidy(profile.correlations(train, CORRELATED))


@query(
    "sanity_counts",
    f"""SELECT {out("n:i cold_start:i unseen_terms:i unseen_codes:i open_rows:i")} FROM (
      SELECT count(*) AS n, count(*) FILTER (WHERE cust_invoice_count = 0) AS cold_start,
        count(*) FILTER (WHERE payment_terms_encoded = -1) AS unseen_terms,
        count(*) FILTER (WHERE business_code_encoded = -1) AS unseen_codes, sum(is_open) AS open_rows FROM open_features) x""",
)
def sanity_counts(spark, root):
    f = stages.Folds(spark, root, with_customer=True)
    rows = encode(invoice_features(stages.open_state(spark, root, with_customer=True, fitted=f)), f.encoders())
    return tidy(profile.sanity_counts(rows))


@query(
    "single_invoice_demo",
    """SELECT CAST(count(*) AS BIGINT) AS n, coalesce(bool_and(days_late = m), TRUE) AS feature_is_label
    FROM (SELECT days_late, avg(days_late) OVER (PARTITION BY customer_id) AS m, count(*) OVER (PARTITION BY customer_id) AS c FROM labelled) x WHERE c = 1""",
)
def single_invoice_demo(spark, root):
    rows = stages.closed(spark, root)
    return tidy(profile.single_invoice_demo(rows, history.static_history(rows)))


@query(
    "entity_drill",
    f"""SELECT {out("customer_id clear_date cust_invoice_count:d cust_avg_days_late:d cust_min_late:d cust_max_late:d")} FROM timeline
    WHERE customer_id = (SELECT min(customer_id) FROM (SELECT customer_id FROM labelled GROUP BY 1 HAVING count(*) BETWEEN 6 AND 12) e)""",
)
def entity_drill(spark, root):
    rows = profile.entity_drill(stages.full_timeline(spark, root), stages.closed(spark, root))
    return tidy(
        rows.select(
            "customer_id", "clear_date", "cust_invoice_count", "cust_avg_days_late", "cust_min_late", "cust_max_late"
        )
    )
