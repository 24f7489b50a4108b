"""Prediction log, evaluation and monitoring queries."""

from pyspark.sql import functions as F

from ..operators import dedupe, evaluation, monitoring
from ..operators.features import invoice_features
from ..schemas import DRIFT_CATEGORICAL, DRIFT_NUMERIC
from ..session import materialize
from ..sources import testdata
from . import stages
from .registry import query, tidy
from .sqlkit import out, p_late

LOG_OUT = (
    "invoice_id customer_id customer_name invoice_amount:m posting_date due_date cust_std_days_late:d "
    "cust_invoice_count:d amount_log:d payment_terms business_code scoring_mode days_late_pred:d days_late_lower:d "
    "days_late_upper:d p_late:d predicted_payment_date model_name model_version model_run_id scored_at"
)


def _names(spec: str) -> list[str]:
    return [t.partition(":")[0] for t in spec.split()]


@query("prediction_log", f"SELECT {out(LOG_OUT)} FROM pred_log")
def prediction_log(spark, root):
    rows = stages.log(spark, root)
    return tidy(rows.select(*_names(LOG_OUT)), money="invoice_amount")


LATEST = "invoice_id scoring_mode model_version scored_at days_late_pred:d p_late:d"


@query("latest_open", f"SELECT {out(LATEST)} FROM latest_open_log")
def latest_open(spark, root):
    opened = stages.log(spark, root).filter("scoring_mode = 'open'")
    return tidy(dedupe.latest_prediction(opened, "invoice_id").select(*_names(LATEST)))


@query("latest_by_mode", f"SELECT {out(LATEST)} FROM latest_mode_log")
def latest_by_mode(spark, root):
    rows = dedupe.latest_prediction(stages.log(spark, root), "invoice_id", "scoring_mode")
    return tidy(rows.select(*_names(LATEST)))


LABELS = "invoice_id scoring_mode model_version clear_date actual_days_late:i has_label label_lag_days:i"


@query("delayed_labels", f"SELECT {out(LABELS)} FROM outcome_labels")
def delayed_labels(spark, root):
    return tidy(stages.labels(spark, root).select(*_names(LABELS)))


def metrics_sql(rows: str, by: str = "") -> str:
    """All eleven metrics of ``rows`` (actual, days_late_pred/lower/upper), optionally per label."""
    group = f"GROUP BY {by}" if by else ""
    key = f"{by}," if by else ""
    part = f"PARTITION BY {by}" if by else ""
    late = p_late("days_late_lower", "days_late_upper")
    match = f"e.{by} = a.{by}" if by else "TRUE"
    sub = f"round({late}, 6)"
    return f"""
      SELECT e.*, a.late_auc FROM (
        SELECT {key} count(*) AS n, avg(abs(actual - days_late_pred)) AS mae, sqrt(avg(power(actual - days_late_pred, 2))) AS rmse,
          quantile_cont(abs(actual - days_late_pred), 0.5) AS median_ae,
          1 - sum(power(actual - days_late_pred, 2)) / nullif(var_pop(actual) * count(*), 0) AS r2,
          avg(days_late_pred - actual) AS bias,
          avg(CAST(abs(actual - days_late_pred) <= 1 AS DOUBLE)) * 100 AS within_1d,
          avg(CAST(abs(actual - days_late_pred) <= 3 AS DOUBLE)) * 100 AS within_3d,
          avg(CAST(abs(actual - days_late_pred) <= 7 AS DOUBLE)) * 100 AS within_7d,
          avg(CAST(actual BETWEEN days_late_lower AND days_late_upper AS DOUBLE)) * 100 AS pi_coverage,
          avg(days_late_upper - days_late_lower) AS pi_mean_width
        FROM {rows} r {group}) e
      JOIN (SELECT {key} sum(pos * (below + neg / 2.0::DOUBLE)) / nullif(sum(pos)::DOUBLE * sum(neg), 0) AS late_auc FROM (
          SELECT {key} score, pos, neg, coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below
          FROM (SELECT {key} {sub} AS score, count(*) FILTER (WHERE actual > 0) AS pos, count(*) FILTER (WHERE actual <= 0) AS neg
                FROM {rows} r GROUP BY {key} {sub}) t) u {group}) a ON {match}"""


METRIC_OUT = (
    "mae:d rmse:d median_ae:d r2:d bias:d within_1d:d within_3d:d within_7d:d pi_coverage:d pi_mean_width:d late_auc:d"
)


@query("model_metrics", f"SELECT {out('n:i ' + METRIC_OUT)} FROM ({metrics_sql('test_scored')}) m")
def model_metrics(spark, root):
    rows = materialize(
        stages.test_scored(spark, root).select("actual", "days_late_pred", "days_late_lower", "days_late_upper"),
        "scored",
    )
    return tidy(evaluation.model_metrics(rows, digits=6))


@query(
    "auc",
    f"SELECT round(late_auc, 6) AS late_auc FROM ({metrics_sql('test_scored')}) m",
)
def auc(spark, root):
    from ..functions.scoring import p_late as probability

    score = F.round(probability(F.col("days_late_lower"), F.col("days_late_upper")), 6)
    return tidy(evaluation.late_auc(stages.test_scored(spark, root).withColumn("score", score), "score"))


def _bucket_sql(rows: str, value: str, n: int) -> str:
    """Right-closed equal-count buckets with merged edges, spelled out."""
    probs = "[" + ", ".join(f"{i / n!r}" for i in range(n + 1)) + "]"
    return f"""(SELECT x.*, CAST(len(list_filter(inner_edges, lambda e: e < {value})) AS BIGINT) AS bucket
      FROM {rows} x, (SELECT list_filter(list_distinct(list_slice(q, 2, {n})), lambda e: e > q[1] AND e < q[{n + 1}]) AS inner_edges
        FROM (SELECT quantile_cont({value}, {probs}) AS q FROM {rows} y) z) e)"""


WIDTHS = "(SELECT *, days_late_upper - days_late_lower AS width FROM test_scored)"
INSIDE = "avg(CAST(actual BETWEEN days_late_lower AND days_late_upper AS DOUBLE)) * 100"


@query(
    "calibration_quantile",
    f"""SELECT bucket, CAST(count(*) AS BIGINT) AS n, round({INSIDE}, 6) AS coverage, round(avg(width), 6) AS mean_width
    FROM {_bucket_sql(WIDTHS, "width", 6)} b GROUP BY bucket""",
)
def calibration_quantile(spark, root):
    return tidy(evaluation.calibration_by_quantile(stages.test_scored(spark, root)))


@query(
    "calibration_fixed",
    f"""SELECT n.bucket, CAST(count(w.bucket) AS BIGINT) AS n, round(avg(inside) * 100, 6) AS coverage, o.calibration,
      round(o.mean_width, 6) AS mean_width
    FROM (VALUES ('narrow'), ('medium'), ('wide')) n(bucket)
    CROSS JOIN (SELECT CASE WHEN {INSIDE} < 75 THEN 'Under-conservative' WHEN {INSIDE} > 88 THEN 'Over-conservative'
        ELSE 'Well Calibrated' END AS calibration, avg(days_late_upper - days_late_lower) AS mean_width FROM test_scored) o
    LEFT JOIN (SELECT CASE WHEN width < 3 THEN 'narrow' WHEN width <= 8 THEN 'medium' ELSE 'wide' END AS bucket,
        CAST(actual BETWEEN days_late_lower AND days_late_upper AS DOUBLE) AS inside FROM {WIDTHS} t) w ON w.bucket = n.bucket
    GROUP BY n.bucket, o.calibration, o.mean_width""",
)
def calibration_fixed(spark, root):
    return tidy(evaluation.calibration_fixed(stages.test_scored(spark, root)))


@query(
    "error_by_segment",
    f"""SELECT 'history_depth' AS segment, CASE WHEN cust_invoice_count <= 0 THEN '0 (cold)' WHEN cust_invoice_count <= 2 THEN '1-2'
        WHEN cust_invoice_count <= 10 THEN '3-10' WHEN cust_invoice_count <= 50 THEN '11-50' ELSE '50+' END AS bucket,
      CAST(count(*) AS BIGINT) AS n, round(avg(abs(actual - days_late_pred)), 6) AS mae FROM test_scored GROUP BY 2
    UNION ALL SELECT 'amount_quintile', 'Q' || CAST(bucket + 1 AS VARCHAR), CAST(count(*) AS BIGINT),
      round(avg(abs(actual - days_late_pred)), 6) FROM {_bucket_sql("test_scored", "invoice_amount", 5)} b GROUP BY bucket""",
)
def error_by_segment(spark, root):
    return tidy(evaluation.error_by_segment(stages.test_scored(spark, root)))


@query(
    "amount_deciles",
    f"""SELECT bucket AS amount_decile, CAST(count(*) AS BIGINT) AS n, round(avg(days_late), 6) AS avg_late,
      round(avg(CAST(days_late > 0 AS DOUBLE)), 6) AS late_rate, round(avg(invoice_amount), 2) AS avg_amount
    FROM {_bucket_sql("labelled", "invoice_amount", 10)} b GROUP BY bucket""",
)
def amount_deciles(spark, root):
    return tidy(evaluation.amount_deciles(stages.closed(spark, root)), money="avg_amount")


@query(
    "business_metrics",
    """SELECT (SELECT CAST(count(*) AS BIGINT) FROM open_valued WHERE ev > 0) AS positive_ev_invoices, round(e, 2) AS ev_decision_engine,
      round(a, 2) AS ev_by_amount, round(r, 2) AS ev_random, round(e - a, 2) AS ev_uplift_vs_by_amount
    FROM (SELECT sum(ev) AS e FROM (SELECT ev FROM open_valued ORDER BY ev DESC, invoice_id LIMIT 20) x) x1,
      (SELECT sum(ev) AS a FROM (SELECT ev FROM open_valued ORDER BY invoice_amount DESC, invoice_id LIMIT 20) y) y1,
      (SELECT sum(ev) AS r FROM (SELECT ev FROM open_valued ORDER BY md5(invoice_id || ':42') LIMIT 20) z) z1""",
)
def business_metrics(spark, root):
    rows = stages.stored_open_predictions(spark, root)
    money = "ev_decision_engine ev_by_amount ev_random ev_uplift_vs_by_amount"
    return tidy(evaluation.business_metrics(rows), money=money)


def _asymmetric_sql() -> str:
    from .sqlkit import valued

    return f"""SELECT CAST(count(*) AS BIGINT) AS n, round(avg(e * e), 6) AS mean_symmetric_loss,
      round(avg(e * e * (invoice_amount / 10000.0) * CASE WHEN e > 0 THEN 2.0 ELSE 0.5 END), 4) AS mean_asymmetric_loss,
      CAST(count(*) FILTER (WHERE e = 3 AND invoice_amount > 50000) AS BIGINT) AS under_predicted_cases,
      CAST(count(*) FILTER (WHERE e = -3 AND invoice_amount > 50000) AS BIGINT) AS over_predicted_cases
    FROM (SELECT round_even(actual - days_late_pred, 0) AS e, invoice_amount
          FROM (SELECT * FROM ({valued("test_scored")}) v ORDER BY ev DESC, invoice_id LIMIT 100) t) x"""


@query("asymmetric_loss", _asymmetric_sql())
def asymmetric_loss(spark, root):
    from ..operators.decision import value_predictions

    rows = evaluation.asymmetric_loss(value_predictions(stages.test_scored(spark, root)))
    return tidy(rows.withColumn("mean_asymmetric_loss", F.round("mean_asymmetric_loss", 4)))


@query(
    "coverage_by_month",
    f"SELECT strftime(posting_date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n, round({INSIDE}, 6) AS coverage FROM test_scored GROUP BY 1",
)
def coverage_by_month(spark, root):
    return tidy(evaluation.coverage_by_month(stages.test_scored(spark, root)))


@query(
    "confusion",
    f"""SELECT {out("true_late:i false_late:i missed_late:i true_on_time:i")},
      round(true_late / nullif(CAST(true_late + false_late AS DOUBLE), 0), 6) AS precision,
      round(true_late / nullif(CAST(true_late + missed_late AS DOUBLE), 0), 6) AS recall FROM (
      SELECT count(*) FILTER (WHERE days_late_pred > 0 AND actual > 0) AS true_late,
        count(*) FILTER (WHERE days_late_pred > 0 AND actual <= 0) AS false_late,
        count(*) FILTER (WHERE days_late_pred <= 0 AND actual > 0) AS missed_late,
        count(*) FILTER (WHERE days_late_pred <= 0 AND actual <= 0) AS true_on_time FROM test_scored) x""",
)
def confusion(spark, root):
    return tidy(evaluation.confusion(stages.test_scored(spark, root)))


@query(
    "naive_baseline",
    """SELECT CAST(count(*) AS BIGINT) AS n, round(avg(abs(actual - m)), 6) AS naive_mae,
      round(sqrt(avg(power(actual - m, 2))), 6) AS naive_rmse, round(avg(abs(actual - days_late_pred)), 6) AS model_mae,
      round((1 - avg(abs(actual - days_late_pred)) / avg(abs(actual - m))) * 100, 6) AS improvement_pct
    FROM test_scored, (SELECT avg(days_late) AS m FROM train) t""",
)
def naive_baseline(spark, root):
    f = stages.Folds(spark, root)
    mean = F.lit(f.defaults["cust_avg_days_late"])
    return tidy(evaluation.naive_baseline(mean, stages.test_scored(spark, root, f)))


# --- monitoring -----------------------------------------------------------------


def psi_sql(ref: str, cur: str, features: dict[str, str]) -> str:
    """Numeric index per feature: name -> (reference expression | current expression)."""
    parts = []
    probs = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"
    for name, expr in features.items():
        a, _, b = expr.partition("|")
        b = b or a
        parts.append(
            f"""SELECT '{name}' AS feature, CASE WHEN n_edges < 3 THEN 0.0 ELSE (
          SELECT sum((c - r) * ln(c / r)) FROM (
            SELECT greatest(coalesce(rn, 0) / CAST(rt AS DOUBLE), 1e-6) AS r, greatest(coalesce(cn, 0) / CAST(ct AS DOUBLE), 1e-6) AS c
            FROM (SELECT unnest(range(0, len(inn) + 1)) AS bin) s
            LEFT JOIN (SELECT len(list_filter(inn, lambda e: e <= {a})) AS bin, count(*) AS rn FROM {ref} r GROUP BY 1) x ON x.bin = s.bin
            LEFT JOIN (SELECT len(list_filter(inn, lambda e: e <= {b})) AS bin, count(*) AS cn FROM {cur} c GROUP BY 1) y ON y.bin = s.bin,
            (SELECT count({a}) AS rt FROM {ref} r2) u, (SELECT count({b}) AS ct FROM {cur} c2) v) w) END AS psi
        FROM (SELECT list_filter(list_distinct(q), lambda e: e > q[1] AND e < q[11]) AS inn, len(list_distinct(q)) AS n_edges
          FROM (SELECT quantile_cont({a}, {probs}) AS q FROM {ref} e) qq) edges"""
        )
    return "\nUNION ALL\n".join(parts)


def cat_psi_sql(ref: str, cur: str, features: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{f}' AS feature, sum((c - r) * ln(c / r)) AS psi FROM (
          SELECT greatest(coalesce(rn, 0) / CAST((SELECT count({f}) FROM {ref} a) AS DOUBLE), 1e-6) AS r,
            greatest(coalesce(cn, 0) / CAST((SELECT count({f}) FROM {cur} b) AS DOUBLE), 1e-6) AS c
          FROM (SELECT {f} AS v, count(*) AS rn FROM {ref} a2 WHERE {f} IS NOT NULL GROUP BY 1) x
          FULL JOIN (SELECT {f} AS v, count(*) AS cn FROM {cur} b2 WHERE {f} IS NOT NULL GROUP BY 1) y ON x.v = y.v) z"""
        for f in features
    )


NUMERIC = {c: c for c in DRIFT_NUMERIC}
STATUS = "CASE WHEN psi IS NULL THEN 'unknown' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END"


def _drift_sides(spark, root):
    """Training rows with their own history against the open book, each stored once."""
    columns = ["days_late", *DRIFT_NUMERIC, *DRIFT_CATEGORICAL]
    f = stages.Folds(spark, root, with_customer=True)
    train = invoice_features(f.state(f.train))
    current = invoice_features(stages.open_state(spark, root, with_customer=True, fitted=f))
    return (
        materialize(train.select(*columns), "reference"),
        materialize(current.select(*columns), "current"),
    )


@query("psi_numeric", f"SELECT feature, round(psi, 6) AS psi FROM ({psi_sql('train_features', 'open_features', NUMERIC)}) p")
def psi_numeric(spark, root):
    train, current = _drift_sides(spark, root)
    return tidy(monitoring.numeric_psi(train, current, NUMERIC))


@query(
    "psi_categorical",
    f"SELECT feature, round(psi, 6) AS psi FROM ({cat_psi_sql('train', 'opened', DRIFT_CATEGORICAL)}) p",
)
def psi_categorical(spark, root):
    train = stages.Folds(spark, root, with_customer=True).train
    current = testdata.ledger(spark, root).filter("is_open = 1")
    return tidy(monitoring.categorical_psi(train, current, DRIFT_CATEGORICAL))


@query(
    "category_counts",
    "\nUNION ALL\n".join(
        f"""SELECT '{f}' AS feature, coalesce(x.v, y.v) AS value, CAST(coalesce(rn, 0) AS BIGINT) AS n_reference, CAST(coalesce(cn, 0) AS BIGINT) AS n_current
        FROM (SELECT {f} AS v, count(*) AS rn FROM train GROUP BY 1) x FULL JOIN (SELECT {f} AS v, count(*) AS cn FROM opened GROUP BY 1) y ON x.v = y.v"""
        for f in DRIFT_CATEGORICAL
    ),
)
def category_counts(spark, root):
    train = stages.Folds(spark, root, with_customer=True).train
    current = testdata.ledger(spark, root).filter("is_open = 1")
    return tidy(monitoring.category_counts(train, current, DRIFT_CATEGORICAL))


DRIFT_SQL = f"""
SELECT feature, type, round(psi, 6) AS psi, {STATUS} AS status FROM (
  SELECT *, 'numeric' AS type FROM ({psi_sql('train_features', 'open_features', NUMERIC)}) a
  UNION ALL SELECT *, 'categorical' FROM ({cat_psi_sql('train', 'opened', DRIFT_CATEGORICAL)}) b) d"""


@query("drift_report", DRIFT_SQL)
def drift_report(spark, root):
    train, current = _drift_sides(spark, root)
    rows = monitoring.drift_report(train, current, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return tidy(rows.orderBy(F.col("psi").desc(), "feature"))


@query(
    "prediction_drift",
    f"""SELECT round(psi, 6) AS psi, {STATUS} AS status, CAST(n AS BIGINT) AS n, round(mean_pred, 6) AS mean_pred,
      round(p90, 6) AS p90_pred, round(mean_p, 6) AS mean_p_late
    FROM ({psi_sql('train', 'open_pred', {'prediction': 'days_late|days_late_pred'})}) p,
      (SELECT count(*) AS n, avg(days_late_pred) AS mean_pred, quantile_cont(days_late_pred, 0.9) AS p90, avg(p_late) AS mean_p FROM open_valued) s""",
)
def prediction_drift(spark, root):
    from ..operators.decision import order_interval

    current = order_interval(stages.open_predictions(spark, root)).select("days_late_pred", "p_late")
    train = stages.Folds(spark, root).train
    return tidy(monitoring.prediction_drift(train, materialize(current, "current")))


LIVE = "(SELECT *, actual_days_late AS actual FROM outcome_labels WHERE has_label AND scoring_mode = 'backtest')"


@query(
    "live_performance",
    f"""SELECT m.model_version, {out(METRIC_OUT)}, CAST(n_labelled AS BIGINT) AS n_labelled,
      CAST(n_awaiting_label AS BIGINT) AS n_awaiting_label, round(CAST(lag_days AS DOUBLE), 6) AS median_label_lag_days
    FROM ({metrics_sql(LIVE, 'model_version')}) m JOIN (
      SELECT model_version, count(*) FILTER (WHERE has_label AND scoring_mode = 'backtest') AS n_labelled,
        count(*) FILTER (WHERE NOT has_label) AS n_awaiting_label, quantile_cont(label_lag_days, 0.5) AS lag_days
      FROM outcome_labels GROUP BY model_version) l ON l.model_version = m.model_version""",
)
def live_performance(spark, root):
    joined = materialize(stages.labels(spark, root), "labels")
    return tidy(monitoring.live_performance(joined, digits=6))


@query(
    "label_lag",
    f"""SELECT {out("n:i mean:d std:d min:i q25:d q50:d q75:d max:i")} FROM (
      SELECT count(*) AS n, avg(label_lag_days) AS mean, stddev_samp(label_lag_days) AS std, min(label_lag_days) AS min,
        quantile_cont(label_lag_days, 0.25) AS q25, quantile_cont(label_lag_days, 0.5) AS q50,
        quantile_cont(label_lag_days, 0.75) AS q75, max(label_lag_days) AS max FROM outcome_labels WHERE has_label) x""",
)
def label_lag(spark, root):
    return tidy(monitoring.label_lag(stages.labels(spark, root)))


def _delta_sql() -> str:
    live = f"(SELECT *, actual_days_late AS actual FROM outcome_labels WHERE has_label AND scoring_mode = 'backtest' AND model_version = '1')"
    rows = [
        f"SELECT '{m}' AS metric, round(a.{m}, 6) AS at_training, round(b.{m}, 6) AS on_delayed_labels, round(b.{m} - a.{m}, 6) AS delta FROM a, b"
        for m in monitoring.DELTA_METRICS
    ]
    return (
        f"SELECT * FROM (WITH a AS ({metrics_sql('test_scored')}), b AS ({metrics_sql(live)}) "
        + " UNION ALL ".join(rows)
        + ") d"
    )


@query("metric_delta", _delta_sql())
def metric_delta(spark, root):
    """Metrics at training time against those of version 1 once its labels arrived."""
    columns = ["actual", "days_late_pred", "days_late_lower", "days_late_upper"]
    trained = materialize(stages.test_scored(spark, root).select(*columns), "scored")
    live = stages.labels(spark, root).filter(
        (F.col("scoring_mode") == "backtest") & F.col("has_label") & (F.col("model_version") == "1")
    )
    live = materialize(live.withColumn("actual", F.col("actual_days_late")).select(*columns), "live")
    return tidy(
        monitoring.metric_delta(
            evaluation.model_metrics(trained, digits=6), evaluation.model_metrics(live, digits=6)
        )
    )


@query(
    "late_rate_gap",
    """SELECT round(h, 6) AS historical_late_rate, round(p, 6) AS predicted_late_rate, round(p - h, 6) AS gap,
      round(mean_pred, 6) AS mean_pred, round(mean_width, 6) AS mean_width
    FROM (SELECT avg(CAST(days_late > 0 AS DOUBLE)) AS h FROM labelled) a,
      (SELECT avg(CAST(days_late_pred > 0 AS DOUBLE)) AS p, avg(days_late_pred) AS mean_pred,
        avg(days_late_upper - days_late_lower) AS mean_width FROM open_pred) b""",
)
def late_rate_gap(spark, root):
    return tidy(
        monitoring.late_rate_gap(testdata.outcomes(spark, root), stages.open_predictions(spark, root))
    )
