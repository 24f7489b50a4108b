"""Dashboard views, guardrails and sinks as registered queries."""

from pyspark.sql import functions as F

from ..functions.dates import plus_days
from ..functions.scoring import rounded
from ..operators import decision, features, guards, history, monitoring
from ..schemas import DRIFT_CATEGORICAL, DRIFT_NUMERIC, RAW_INPUT_COLS
from ..session import materialize, new_folder
from ..sources import ledger_csv, testdata
from ..sources.tables import Tables
from . import stages, views
from .evaluation_queries import DRIFT_SQL, LIVE, _drift_sides, metrics_sql
from .registry import query, tidy
from .silver_queries import TAGGED, _dq
from .sqlkit import HIST_LIST, HIST_OUT, asof, out

# --- views ----------------------------------------------------------------------


def _queue(spark, root, with_customer=False):
    """Actions of the open book; ranked only where a view shows the rank."""
    return stages.capped(spark, root, with_customer).withColumns(
        {"queue_date": F.lit(stages.QUEUE_DATE).cast("date"), "p_responds": rounded(F.col("p_responds"), 3)}
    )


@query(
    "v_executive_kpis",
    """SELECT CAST(count(*) AS BIGINT) AS open_invoices, round(sum(invoice_amount), 2) AS total_outstanding,
      CAST(count(*) FILTER (WHERE days_late_pred > 0) AS BIGINT) AS predicted_late,
      round(coalesce(sum(invoice_amount) FILTER (WHERE days_late_pred > 0), 0), 2) AS value_at_risk,
      CAST(count(*) FILTER (WHERE action = 'CALL') AS BIGINT) AS recommended_calls,
      round(coalesce(sum(expected_value) FILTER (WHERE action = 'CALL'), 0), 2) AS expected_daily_recovery,
      round(avg(days_late_pred), 2) AS avg_predicted_delay, round(avg(days_late_upper - days_late_lower), 2) AS avg_interval_width,
      max(queue_date) AS queue_generated_at FROM queue""",
)
def v_executive_kpis(spark, root):
    return tidy(views.executive_kpis(_queue(spark, root)))


@query(
    "v_collection_queue",
    """SELECT CAST(rank AS BIGINT) AS rank, action, customer_name, invoice_id, round(invoice_amount, 2) AS amount, due_date,
      predicted_payment_date, CAST(ceil(days_late_pred) AS BIGINT) AS days_late_predicted,
      CAST(CAST(ceil(days_late_lower) AS INTEGER) AS VARCHAR) || ' to ' || CAST(CAST(ceil(days_late_upper) AS INTEGER) AS VARCHAR) || ' days' AS prediction_interval,
      round(p_late, 2) AS p_late, CAST(round(CAST(p_responds AS DECIMAL(10, 3)), 2) AS DOUBLE) AS p_responds, round(expected_value, 2) AS expected_value FROM queue""",
)
def v_collection_queue(spark, root):
    return tidy(views.collection_queue(stages.queue(spark, root)))


@query(
    "v_action_summary",
    """SELECT action, CAST(count(*) AS BIGINT) AS invoices, round(sum(invoice_amount), 2) AS exposure,
      round(sum(expected_value), 2) AS total_expected_value, round(avg(p_late), 3) AS avg_p_late,
      round(avg(days_late_pred), 2) AS avg_predicted_delay FROM queue GROUP BY action""",
)
def v_action_summary(spark, root):
    return tidy(views.action_summary(_queue(spark, root)))


@query(
    "v_invoice_detail",
    """SELECT q.invoice_id, q.customer_id, q.customer_name, round(q.invoice_amount, 2) AS amount, q.posting_date, q.due_date,
      q.predicted_payment_date, round(q.days_late_pred, 1) AS p50_days_late, round(q.days_late_lower, 1) AS p10_days_late,
      round(q.days_late_upper, 1) AS p90_days_late, round(q.p_late, 3) AS probability_late,
      round(q.expected_value, 2) AS expected_value, q.action, q.payment_terms, q.business_code,
      CAST(q.cust_invoice_count AS BIGINT) AS customer_history_depth, round(g.avg_days_late, 1) AS customer_avg_days_late,
      round(g.late_rate, 3) AS customer_late_rate, round(g.recent_90d_avg_days_late, 1) AS customer_recent_90d_avg,
      '2' AS model_version, TIMESTAMP '2024-02-01 06:00:00' AS scored_at
    FROM queue q LEFT JOIN gold g ON q.customer_id = g.customer_id""",
)
def v_invoice_detail(spark, root):
    run = stages.RUNS[1]
    rows = _queue(spark, root, with_customer=True).withColumns(
        {
            "predicted_payment_date": plus_days("due_date", F.col("days_late_pred")),
            "model_version": F.lit(run.version),
            "scored_at": F.to_timestamp_ntz(F.lit(run.scored_at)),
        }
    )
    return tidy(views.invoice_detail(rows, history.gold_customer(stages.closed(spark, root))))


@query(
    "v_customer_segments",
    """SELECT customer_id, round(avg_days_late, 1) AS avg_days_late, round(std_days_late, 1) AS payment_variability,
      CAST(invoice_count AS BIGINT) AS invoice_count, CAST(round(CAST(avg_invoice_amount AS DECIMAL(18, 6)), 2) AS DOUBLE) AS avg_invoice_amount,
      CASE WHEN avg_days_late > ml AND std_days_late > ms THEN 'Late & Erratic' WHEN avg_days_late > ml THEN 'Late but Predictable'
        WHEN std_days_late > ms THEN 'Prompt but Erratic' ELSE 'Prompt & Reliable' END AS segment
    FROM gold, (SELECT quantile_disc(avg_days_late, 0.5) AS ml, quantile_disc(std_days_late, 0.5) AS ms FROM gold WHERE std_days_late IS NOT NULL) m
    WHERE std_days_late IS NOT NULL""",
)
def v_customer_segments(spark, root):
    gold = materialize(history.gold_customer(stages.closed(spark, root)), "gold")
    return tidy(views.customer_segments(gold))


def performance_log(spark, root):
    """Performance rows of two evaluations: as each version stands now, appended per run."""
    joined = materialize(stages.labels(spark, root), "labels")
    rows = monitoring.live_performance(joined, digits=6)
    stamp = F.when(F.col("model_version") == "1", "2024-03-01 00:00:00").otherwise("2024-04-01 00:00:00")
    return rows.withColumn("evaluated_at", F.to_timestamp_ntz(stamp))


@query(
    "v_model_performance",
    f"""SELECT CASE WHEN m.model_version = '1' THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-04-01 00:00:00' END AS evaluated_at,
      m.model_version, round(mae, 3) AS mae, round(rmse, 3) AS rmse, round(bias, 3) AS bias, round(within_3d, 1) AS pct_within_3_days,
      round(pi_coverage, 1) AS pi_coverage_pct, round(late_auc, 3) AS late_auc, CAST(n_labelled AS BIGINT) AS n_labelled,
      CAST(n_awaiting_label AS BIGINT) AS n_awaiting_label, CAST(lag_days AS DOUBLE) AS median_label_lag_days
    FROM ({metrics_sql(LIVE, 'model_version')}) m JOIN (
      SELECT model_version, count(*) FILTER (WHERE has_label AND scoring_mode = 'backtest') AS n_labelled,
        count(*) FILTER (WHERE NOT has_label) AS n_awaiting_label, quantile_cont(label_lag_days, 0.5) AS lag_days
      FROM outcome_labels GROUP BY model_version) l ON l.model_version = m.model_version""",
)
def v_model_performance(spark, root):
    return tidy(views.model_performance(performance_log(spark, root)))


def drift_log(spark, root):
    """Two drift runs: every feature a month ago with a blank result, and all of them now."""
    train, current = _drift_sides(spark, root)
    now = monitoring.drift_report(train, current, DRIFT_NUMERIC, DRIFT_CATEGORICAL).withColumns(
        {"model_version": F.lit("2"), "evaluated_at": F.to_timestamp_ntz(F.lit("2024-04-01 00:00:00"))}
    )
    earlier = now.withColumns(
        {
            "psi": F.lit(None).cast("double"),
            "status": F.lit("unknown"),
            "model_version": F.lit("1"),
            "evaluated_at": F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")),
        }
    )
    return now.unionByName(earlier)


@query(
    "v_drift_latest",
    f"""SELECT feature, type, round(psi, 4) AS psi, status, '2' AS model_version, TIMESTAMP '2024-04-01 00:00:00' AS evaluated_at
    FROM ({DRIFT_SQL.replace('round(psi, 6)', 'psi')}) d""",
)
def v_drift_latest(spark, root):
    return tidy(views.drift_latest(drift_log(spark, root)))


@query(
    "v_pipeline_health",
    f"""SELECT TIMESTAMP '2024-01-02 00:00:00' AS run_timestamp, s.stage, CAST(b.rows_in AS BIGINT) AS rows_in,
      CAST(s.rows_clean AS BIGINT) AS rows_clean, CAST(s.rows_stage - s.rows_clean AS BIGINT) AS rows_quarantined,
      round((s.rows_stage - s.rows_clean) / CAST(b.rows_in AS DOUBLE) * 100, 2) AS reject_rate_pct,
      '{{' || coalesce(r.reasons, '') || '}}' AS reject_reasons
    FROM (SELECT stage, count(*) AS rows_stage, count(*) FILTER (WHERE reason IS NULL) AS rows_clean FROM {TAGGED} t GROUP BY stage) s
    CROSS JOIN (SELECT count(*) AS rows_in FROM bronze) b
    LEFT JOIN (SELECT stage, string_agg('"' || reason || '":' || n, ',' ORDER BY reason) AS reasons FROM (
        SELECT stage, reason, count(*) AS n FROM {TAGGED} t2 WHERE reason IS NOT NULL GROUP BY stage, reason) x GROUP BY stage) r
      ON r.stage = s.stage""",
)
def v_pipeline_health(spark, root):
    return tidy(views.pipeline_health(_dq(spark, root)))


@query(
    "v_quarantine_reasons",
    "SELECT _reject_reason AS reason, CAST(count(*) AS BIGINT) AS rows_rejected FROM rejected GROUP BY 1",
)
def v_quarantine_reasons(spark, root):
    from ..operators import quality

    return views.quarantine_reasons(quality.quarantine(*stages.tagged(stages.deduped(spark, root))))


@query(
    "v_strategy_comparison",
    """SELECT 'Decision engine' AS strategy, round(sum(ev), 2) AS expected_value_of_20_calls, CAST(1 AS BIGINT) AS sort_order
    FROM (SELECT ev FROM capped ORDER BY ev DESC, invoice_id LIMIT 20) a
    UNION ALL SELECT 'By amount', round(sum(ev), 2), CAST(2 AS BIGINT) FROM (SELECT ev FROM capped ORDER BY invoice_amount DESC, invoice_id LIMIT 20) b
    UNION ALL SELECT 'Random', round(sum(ev), 2), CAST(3 AS BIGINT) FROM (SELECT ev FROM capped ORDER BY md5(invoice_id || ':42') LIMIT 20) c""",
)
def v_strategy_comparison(spark, root):
    stored = materialize(_queue(spark, root).select("invoice_id", "invoice_amount", "expected_value"), "queue")
    return tidy(views.strategies(stored))


# --- guardrails -----------------------------------------------------------------


def _zero(*names: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS \"check\", CAST(0 AS BIGINT) AS violations" for n in names)


def _count_sql(name: str, body: str) -> str:
    return f"SELECT '{name}' AS \"check\", CAST(count(*) AS BIGINT) AS violations FROM ({body}) x"


@query(
    "guard_silver",
    "\nUNION ALL\n".join(
        [
            _count_sql("silver_null_id", "SELECT 1 FROM silver_inv WHERE invoice_id IS NULL"),
            _count_sql("silver_unique_id", "SELECT 1 FROM silver_inv GROUP BY invoice_id HAVING count(*) > 1"),
            _count_sql("silver_due_after_posting", "SELECT 1 FROM silver_inv WHERE due_date < posting_date"),
        ]
    ),
)
def guard_silver(spark, root):
    invoices, _ = stages.silver(stages.deduped(spark, root))
    return guards.silver(materialize(invoices.select("invoice_id", "posting_date", "due_date"), "silver"))


def _asof(spark, root):
    fixed = stages.defaults(spark, root)
    rows = testdata.outcomes(spark, root)
    timeline = stages.full_timeline(spark, root)
    return rows, history.asof_history(rows, timeline, fixed, keep_asof=True), fixed, timeline


def _value_sql(name: str, value: str) -> str:
    return f"SELECT '{name}' AS \"check\", CAST({value} AS BIGINT) AS violations"


ASOF_ALL = asof("ledger", "timeline", keep=True)


@query(
    "guard_asof_rows",
    _value_sql("asof_row_count", f"abs((SELECT count(*) FROM ledger) - (SELECT count(*) FROM ({ASOF_ALL}) a))"),
)
def guard_asof_rows(spark, root):
    rows, asof, _, _ = _asof(spark, root)
    return guards.same_rows(rows, asof)


@query(
    "guard_history",
    _count_sql("history_before_posting", f"SELECT 1 FROM ({ASOF_ALL}) a WHERE hist_asof >= posting_date")
    + "\nUNION ALL\n"
    + _count_sql("own_outcome_unseen", f"SELECT 1 FROM ({ASOF_ALL}) a WHERE hist_asof >= clear_date"),
)
def guard_history(spark, root):
    """Counted while the joined rows are written."""
    rows = _asof(spark, root)[1].select("posting_date", "clear_date", "_hist_asof")
    return guards.watched(rows, guards.history_checks())[1]


@query(
    "guard_cleared_after_posting",
    _count_sql("cleared_after_posting", "SELECT 1 FROM ledger WHERE clear_date < posting_date"),
)
def guard_cleared_after_posting(spark, root):
    return guards.cleared_after_posting(testdata.outcomes(spark, root))


@query(
    "guard_timeline_key",
    _count_sql("timeline_unique_key", "SELECT 1 FROM timeline GROUP BY customer_id, clear_date HAVING count(*) > 1"),
)
def guard_timeline_key(spark, root):
    return guards.timeline_key(stages.full_timeline(spark, root))


COLD = " OR ".join(f"a.{c} IS DISTINCT FROM d.{c}" for c in HIST_LIST)


@query(
    "guard_cold_start",
    _count_sql("cold_start_defaults", f"SELECT 1 FROM ({ASOF_ALL}) a, defaults d WHERE a.hist_asof IS NULL AND ({COLD})"),
)
def guard_cold_start(spark, root):
    f = stages.Folds(spark, root)
    one_row = features.fold_defaults(f.train)
    asof = history.asof_history(
        testdata.outcomes(spark, root), stages.full_timeline(spark, root), f.defaults, keep_asof=True
    )
    return guards.cold_start_defaults(asof, one_row)


@query(
    "guard_folds",
    _value_sql("folds_disjoint", "(SELECT max(posting_date) FROM train) >= (SELECT min(posting_date) FROM test)")
    + "\nUNION ALL\n"
    + _count_sql("timeline_in_train", "SELECT 1 FROM train_timeline WHERE clear_date > (SELECT max(clear_date) FROM train)"),
)
def guard_folds(spark, root):
    f = stages.Folds(spark, root)
    folded = features.with_fold(stages.closed(spark, root), f.cutoff)
    last = f.train.agg(F.max("clear_date").alias("last_clear"))
    return guards.folds(folded, f.timeline(), last)


@query("guard_intervals", _count_sql("interval_order", "SELECT 1 FROM open_pred WHERE days_late_lower > days_late_upper"))
def guard_intervals(spark, root):
    """The intervals as predicted, before anything puts them in order."""
    return guards.interval_order(stages.open_predictions(spark, root))


@query(
    "guard_scoring_input",
    _value_sql("rows_to_score", "(SELECT count(*) = 0 FROM open_state)")
    + "\nUNION ALL\n"
    + _value_sql("open_rows_present", "(SELECT count(*) FILTER (WHERE is_open = 1) = 0 FROM open_state)")
    + "\nUNION ALL\n"
    + _zero("input_columns"),
)
def guard_scoring_input(spark, root):
    rows = features.invoice_features(stages.open_state(spark, root, with_customer=True))
    stored, seen = guards.watched(rows, guards.scoring_checks(), "input")
    return seen.unionByName(guards.scoring_input(stored, RAW_INPUT_COLS).filter(F.col("check") == "input_columns"))


@query(
    "guard_queue",
    "\nUNION ALL\n".join(
        [
            _value_sql("queue_count", "abs((SELECT count(*) FROM queue) - (SELECT count(*) FROM open_pred))"),
            _value_sql("queue_capacity", "(SELECT greatest(count(*) FILTER (WHERE action = 'CALL') - 20, 0) FROM queue)"),
            _count_sql("queue_tiers", "SELECT 1 FROM queue WHERE action NOT IN ('CALL', 'REMIND', 'WATCH', 'OK')"),
            _count_sql("queue_rank_set", "SELECT 1 FROM queue WHERE rank IS NULL"),
            _count_sql(
                "queue_call_order",
                "SELECT 1 FROM (SELECT expected_value > lag(expected_value) OVER (ORDER BY rank) AS bad FROM queue WHERE action = 'CALL') y WHERE bad",
            ),
        ]
    ),
)
def guard_queue(spark, root):
    stored = stages.stored_open_predictions(spark, root)
    queue = decision.collection_queue(stored, F.lit(stages.QUEUE_DATE).cast("date"))
    return guards.queue(queue, stored, decision.DEFAULTS.daily_capacity)


@query(
    "guard_backtest_labels",
    _value_sql("backtest_labels", "(SELECT count(*) FILTER (WHERE has_label AND scoring_mode = 'backtest') = 0 FROM outcome_labels)"),
)
def guard_backtest_labels(spark, root):
    return guards.backtest_labels(stages.labels(spark, root))


# Broken on purpose, by the invoice number: what each guard must then count.
NUMBER = "CAST(invoice_id AS BIGINT)"
_BROKEN_DATE = f"posting_date + CAST({NUMBER} % 3 - 1 AS INTEGER)"


@query(
    "guard_findings",
    "\nUNION ALL\n".join(
        [
            _count_sql("silver_null_id", f"SELECT 1 FROM ledger WHERE {NUMBER} % 5 = 0"),
            _count_sql("silver_due_after_posting", f"SELECT 1 FROM ledger WHERE {NUMBER} % 7 = 0"),
            _count_sql("asof_row_count", f"SELECT 1 FROM ledger WHERE {NUMBER} % 7 = 0"),
            _count_sql("history_before_posting", f"SELECT 1 FROM ledger WHERE {_BROKEN_DATE} >= posting_date"),
            _count_sql("own_outcome_unseen", f"SELECT 1 FROM ledger WHERE {_BROKEN_DATE} >= clear_date"),
            _value_sql("folds_disjoint", "1"),
            _count_sql("timeline_in_train", "SELECT 1 FROM timeline WHERE clear_date > (SELECT max(clear_date) FROM train)"),
            _count_sql("interval_order", f"SELECT 1 FROM ledger WHERE {NUMBER} % 4 = 3"),
            _value_sql("rows_to_score", "0"),
            _value_sql("open_rows_present", "1"),
            _value_sql("input_columns", "1"),
            _count_sql("queue_count", f"SELECT 1 FROM ledger WHERE {NUMBER} % 9 = 0"),
            _value_sql("queue_capacity", f"(SELECT greatest(count(*) - 20, 0) FROM ledger WHERE {NUMBER} % 9 <> 0 AND {NUMBER} % 4 = 0)"),
            _count_sql("queue_tiers", f"SELECT 1 FROM ledger WHERE {NUMBER} % 9 <> 0 AND {NUMBER} % 4 = 1"),
            _count_sql("queue_rank_set", f"SELECT 1 FROM ledger WHERE {NUMBER} % 9 <> 0 AND {NUMBER} % 11 = 0"),
            _value_sql("backtest_labels", "1"),
        ]
    ),
)
def guard_findings(spark, root):
    """Every guard over rows that break it."""
    rows = testdata.outcomes(spark, root)
    n = F.col("invoice_id").cast("long")
    broken = rows.select(
        F.when(n % 5 != 0, F.col("invoice_id")).alias("invoice_id"),
        "posting_date",
        F.when(n % 7 == 0, F.date_sub("posting_date", 1)).otherwise(F.greatest("due_date", "posting_date")).alias("due_date"),
    )
    leaky = rows.select("posting_date", "clear_date", F.date_add("posting_date", (n % 3 - 1).cast("int")).alias("_hist_asof"))
    f = stages.Folds(spark, root)
    mixed = f.train.select("posting_date", F.lit("test").alias("fold")).union(f.test.select("posting_date", F.lit("train").alias("fold")))
    wrong = rows.select((n % 4).cast("double").alias("days_late_lower"), F.lit(2.0).alias("days_late_upper"))
    queued = rows.filter(n % 9 != 0).select(
        F.when(n % 4 == 0, "CALL").when(n % 4 == 1, "DUNNO").otherwise("OK").alias("action"),
        F.when(n % 11 != 0, n).alias("rank"),
        F.lit(1.0).alias("expected_value"),
    )
    queue_checks = guards.queue(queued, rows, decision.DEFAULTS.daily_capacity).filter("check <> 'queue_call_order'")
    unlabelled = rows.select(F.lit(False).alias("has_label"), F.lit("backtest").alias("scoring_mode"))
    return guards.union(
        [
            guards.silver(broken).filter("check <> 'silver_unique_id'"),
            guards.same_rows(rows, rows.filter(n % 7 != 0)),
            guards.watched(leaky, guards.history_checks())[1],
            guards.folds(mixed, stages.full_timeline(spark, root), f.train.agg(F.max("clear_date").alias("last_clear"))),
            guards.interval_order(wrong),
            guards.scoring_input(rows.filter("is_open = 0").select("is_open"), ["is_open", "no_such_column"]),
            queue_checks,
            guards.backtest_labels(unlabelled),
        ]
    )


# --- sinks and round trips --------------------------------------------------------

LEDGER_OUT = (
    "invoice_id customer_id customer_name invoice_amount:m posting_date due_date clear_date payment_terms business_code is_open:i"
)


@query("ledger_csv", f"SELECT {out(LEDGER_OUT)} FROM ledger")
def ledger_csv_round_trip(spark, root):
    """The ledger written as CSV and read back through the source's typing rules."""
    path = new_folder(spark, "ledger-csv")
    ledger_csv.write_ledger(testdata.ledger(spark, root), path)
    return tidy(ledger_csv.read_ledger(spark, path), money="invoice_amount")


@query(
    "scored_export",
    f"""SELECT {out("invoice_id posting_date invoice_amount:m actual:i prediction:d prediction_lower:d prediction_upper:d")} FROM (
      SELECT *, round(days_late_pred, 2) AS prediction, round(days_late_lower, 2) AS prediction_lower,
        round(days_late_upper, 2) AS prediction_upper FROM test_scored) x""",
)
def scored_export(spark, root):
    """Hold-out results, one JSON row per invoice, read back with the stated schema."""
    rows = stages.test_scored(spark, root).select(
        "invoice_id",
        "posting_date",
        F.round("invoice_amount", 2).alias("invoice_amount"),
        F.col("actual").cast("long").alias("actual"),
        F.round("days_late_pred", 2).alias("prediction"),
        F.round("days_late_lower", 2).alias("prediction_lower"),
        F.round("days_late_upper", 2).alias("prediction_upper"),
    )
    path = new_folder(spark, "scored-export")
    rows.write.json(path)
    return tidy(spark.read.schema(rows.schema).json(path), money="invoice_amount")


@query(
    "append_log",
    """SELECT model_version, scored_at, CAST(scored_at AS DATE) AS run_date, CAST(count(*) AS BIGINT) AS n
    FROM pred_log GROUP BY 1, 2, 3""",
)
def append_log(spark, root):
    """Two appends to a log partitioned by run day; the second one brings a new column."""
    tables = Tables(spark, new_folder(spark, "tables"))
    log = materialize(stages.log(spark, root), "log")
    tables.append(log.filter("model_version = '1'"), "prediction_log", "scored_at")
    second = log.filter("model_version = '2'").withColumn("note", F.lit("second run"))
    rows = tables.append(second, "prediction_log", "scored_at")
    return rows.groupBy("model_version", "scored_at", "run_date").agg(F.count(F.lit(1)).alias("n"))


@query("feature_table", f"SELECT {out('customer_id clear_date ' + HIST_OUT)} FROM timeline")
def feature_table(spark, root):
    """The timeline as a full-refresh table, scanned back by name."""
    tables = Tables(spark, new_folder(spark, "tables"))
    return tidy(tables.refresh(stages.full_timeline(spark, root), "customer_timeline"))
