"""Scoring and decision queries."""

from pyspark.sql import functions as F

from ..functions import scoring as S
from ..operators import decision, history, ordering
from ..schemas import TIERS
from ..session import materialize
from ..sources import testdata
from . import stages
from .registry import query, tidy
from .sqlkit import TIER_NO, out

PRED = "days_late_pred:d days_late_lower:d days_late_upper:d"


@query("baseline_predict", f"SELECT {out('invoice_id ' + PRED)} FROM open_pred")
def baseline_predict(spark, root):
    rows = stages.open_predictions(spark, root)
    return tidy(rows.select("invoice_id", "days_late_pred", "days_late_lower", "days_late_upper"))


@query(
    "expected_value",
    f"""SELECT {out("invoice_id p_late:d responsiveness:d benefit_if_success:d expected_benefit:d call_cost:d expected_value:m")} FROM (
      SELECT invoice_id, p_late, p_responds AS responsiveness, 0.0009::DOUBLE * abs(invoice_amount) AS benefit_if_success,
        p_late * p_responds * 0.0009::DOUBLE * abs(invoice_amount) AS expected_benefit, 15.0 AS call_cost, ev AS expected_value
      FROM open_valued) x""",
)
def expected_value(spark, root):
    rows = decision.value_breakdown(stages.open_predictions(spark, root))
    return tidy(
        rows.select(
            "invoice_id",
            "p_late",
            "responsiveness",
            "benefit_if_success",
            "expected_benefit",
            "call_cost",
            "expected_value",
        ),
        money="expected_value",
    )


@query("action_tiers", "SELECT invoice_id, tier AS action FROM open_valued")
def action_tiers(spark, root):
    return decision.value_predictions(stages.open_predictions(spark, root)).select("invoice_id", "action")


QUEUE_OUT = (
    "rank:i invoice_id customer_id invoice_amount:m due_date days_late_pred:d p_late:d p_responds:d "
    "expected_value:m action queue_date"
)


@query("collection_queue", f"SELECT {out(QUEUE_OUT)} FROM queue")
def collection_queue(spark, root):
    rows = stages.queue(spark, root, with_customer=False)
    return tidy(rows.select(*[t.partition(":")[0] for t in QUEUE_OUT.split()]), money="invoice_amount expected_value")


# The flagship runs from raw events: dedupe, validation, outcome join, history, scoring, cap.
CALL_SQL = f"""
, tl AS (
  SELECT DISTINCT customer_id, clear_date, avg(days_late) OVER w AS cust_avg_days_late,
    coalesce(stddev_samp(days_late) OVER w, 0.0) AS cust_std_days_late,
    count(days_late) OVER w AS cust_invoice_count
  FROM silver_out WHERE clear_date IS NOT NULL WINDOW w AS (PARTITION BY customer_id ORDER BY clear_date)),
dflt AS (SELECT avg(days_late) AS a, stddev_samp(days_late) AS s FROM silver_out WHERE clear_date IS NOT NULL),
st AS (
  SELECT r.invoice_id, r.customer_id, r.customer_name, r.invoice_amount, r.due_date,
    coalesce(t.cust_avg_days_late, a) AS cust_avg_days_late, coalesce(t.cust_std_days_late, s) AS cust_std_days_late,
    coalesce(t.cust_invoice_count, 0) AS cust_invoice_count
  FROM (SELECT * FROM silver_out WHERE is_open = 1) r
  ASOF LEFT JOIN tl t ON r.customer_id = t.customer_id AND r.posting_date > t.clear_date CROSS JOIN dflt),
"""


def _call_sql() -> str:
    from .sqlkit import baseline, sql, valued

    base = sql("SELECT * FROM silver_out")
    head = base[: base.rindex("SELECT * FROM silver_out")]
    return (
        head.rstrip()
        + CALL_SQL.rstrip().rstrip(",")
        + f", pr AS ({baseline('st')}), va AS ({valued('pr')}), "
        + """ca AS (SELECT *, ev AS expected_value, CASE WHEN tier = 'CALL'
          AND row_number() OVER (PARTITION BY tier ORDER BY ev DESC, invoice_id) > 20 THEN 'REMIND' ELSE tier END AS action FROM va) """
        + f"SELECT CAST(row_number() OVER (ORDER BY {TIER_NO}, expected_value DESC, invoice_id) AS BIGINT) AS rank, "
        + out(
            "invoice_id customer_id customer_name invoice_amount:m due_date cust_invoice_count:d "
            + PRED
            + " p_late:d p_responds:d expected_value:m action"
        )
        + f" FROM ca ORDER BY {TIER_NO}, expected_value DESC, invoice_id LIMIT 20"
    )


@query("call_list")
def call_list(spark, root):
    """Which open invoices should be called first, and why? From raw events to the top of the queue."""
    from ..operators.features import fold_defaults
    from ..operators.outcomes import labelled, open_book

    rows = materialize(stages.silver_outcomes(stages.deduped(spark, root)), "silver")
    paid = labelled(rows)
    state = history.history_before(open_book(rows), paid, fold_defaults(paid))
    stored = materialize(decision.baseline_predict(state), "predictions")
    head = decision.top_of_queue(stored, 20)
    return tidy(
        head.select(
            "rank",
            "invoice_id",
            "customer_id",
            "customer_name",
            "invoice_amount",
            "due_date",
            "cust_invoice_count",
            "days_late_pred",
            "days_late_lower",
            "days_late_upper",
            "p_late",
            "p_responds",
            "expected_value",
            "action",
        ),
        money="invoice_amount expected_value",
    )


def _register_call_list() -> None:
    from .registry import ORACLES

    ORACLES["call_list"] = _call_sql()


_register_call_list()


@query(
    "date_range",
    """SELECT invoice_id, due_date, due_date + CAST(ceil(days_late_pred) AS INTEGER) AS predicted_payment_date,
      due_date + CAST(ceil(days_late_lower) AS INTEGER) AS payment_date_lower,
      due_date + CAST(ceil(days_late_upper) AS INTEGER) AS payment_date_upper FROM open_pred""",
)
def date_range(spark, root):
    rows = decision.date_range(stages.open_predictions(spark, root))
    return rows.select(
        "invoice_id", "due_date", "predicted_payment_date", "payment_date_lower", "payment_date_upper"
    )


@query(
    "work_order",
    f"""SELECT {out("calls:i total_expected_value:m value_at_risk:m mean_p_late:d mean_p_responds:d")} FROM (
      SELECT count(*) AS calls, sum(expected_value) AS total_expected_value, sum(invoice_amount) AS value_at_risk,
        avg(p_late) AS mean_p_late, avg(p_responds) AS mean_p_responds FROM capped WHERE action = 'CALL') x""",
)
def work_order(spark, root):
    return tidy(decision.work_order(stages.capped(spark, root)), money="total_expected_value value_at_risk")


STRATEGY = """
SELECT strategy, round(daily_ev, 2) AS daily_ev, round(daily_ev * 250, 2) AS annual_ev,
  round((max(CASE WHEN sort_order = 1 THEN daily_ev END) OVER () - daily_ev) * 250, 2) AS annual_gap_to_engine,
  CAST(sort_order AS BIGINT) AS sort_order
FROM (
  SELECT 'Decision engine' AS strategy, sum(ev) AS daily_ev, 1 AS sort_order FROM (SELECT ev FROM open_valued ORDER BY ENGINE_ORDER LIMIT 20) a
  UNION ALL SELECT 'By amount', sum(ev), 2 FROM (SELECT ev FROM open_valued ORDER BY invoice_amount DESC, invoice_id LIMIT 20) b
  UNION ALL SELECT 'Random', sum(ev), 3 FROM (SELECT ev FROM open_valued ORDER BY md5(invoice_id || ':42') LIMIT 20) c) s
"""


def _stored_values(spark, root, *extra):
    rows = decision.value_predictions(stages.open_predictions(spark, root))
    return materialize(rows.select("invoice_id", "invoice_amount", "expected_value", "action", *extra), "valued")


@query("strategy_comparison", STRATEGY.replace("ENGINE_ORDER", "ev DESC, invoice_id"))
def strategy_comparison(spark, root):
    return tidy(
        decision.strategy_comparison(_stored_values(spark, root)), money="daily_ev annual_ev annual_gap_to_engine"
    )


@query(
    "strategy_queue_head",
    STRATEGY.replace("open_valued", "capped").replace("ENGINE_ORDER", f"{TIER_NO}, ev DESC, invoice_id"),
)
def strategy_queue_head(spark, root):
    """The variant that takes the head of the ranked queue instead of the top by expected value."""
    rows = decision.cap_calls(_stored_values(spark, root))
    compared = decision.strategy_comparison(materialize(rows, "capped"), engine="queue_head")
    return tidy(compared, money="daily_ev annual_ev annual_gap_to_engine")


@query(
    "v1_priority",
    f"""SELECT {out("rank:i invoice_id customer_id invoice_amount:m days_late_pred:d prediction_interval p_late:d expected_value:m recommendation priority")}
    FROM (SELECT *, row_number() OVER (ORDER BY expected_value DESC, invoice_id) AS rank,
        CASE WHEN row_number() OVER (ORDER BY expected_value DESC, invoice_id) <= 20 THEN 'HIGH' ELSE 'LOW' END AS priority,
        CASE WHEN expected_value > 0 THEN 'CALL' ELSE 'SKIP' END AS recommendation,
        printf('[%.0f, %.0f]', days_late_lower, days_late_upper) AS prediction_interval
      FROM (SELECT * EXCLUDE (p_late), late AS p_late,
              round(late * greatest(least(1.0::DOUBLE - cust_std_days_late / 20.0::DOUBLE, 0.8::DOUBLE), 0.2::DOUBLE)
                * (3.0::DOUBLE * 0.0003::DOUBLE * invoice_amount) - 15.0::DOUBLE, 6) AS expected_value
            FROM (SELECT *, 0 AS p_late, CASE WHEN days_late_upper < 0 THEN 0.05::DOUBLE WHEN days_late_lower > 5 THEN 0.95::DOUBLE
                WHEN days_late_upper > days_late_lower
                THEN greatest(least(days_late_upper / (days_late_upper - days_late_lower), 1.0::DOUBLE), 0.0::DOUBLE)
                ELSE 0.5::DOUBLE END AS late FROM open_pred) a) b) c""",
)
def v1_priority(spark, root):
    return tidy(decision.v1_priority(stages.open_predictions(spark, root)), money="invoice_amount expected_value")


FACTORS = [0.1, 0.25, 0.5, 1.0, 2.0, 4.0, 10.0]


def _sweep_sql() -> str:
    from .sqlkit import valued

    swept = (
        "(SELECT p.* REPLACE (p.invoice_amount * factor AS invoice_amount), factor FROM open_pred p, "
        f"(SELECT unnest({FACTORS!r}::DOUBLE[]) AS factor) f)"
    )
    tiers = ", ".join(f"CAST(count(*) FILTER (WHERE tier = '{t}') AS BIGINT) AS n_{t.lower()}" for t in TIERS)
    return (
        f"SELECT factor, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE ev > 0) AS BIGINT) AS worth_calling, "
        f"round(sum(ev), 2) AS total_ev, {tiers} FROM ({valued(swept + ' sw')}) v GROUP BY factor"
    )


@query("ev_sweep", _sweep_sql())
def ev_sweep(spark, root):
    return tidy(decision.ev_sweep(stages.open_predictions(spark, root), FACTORS), money="total_ev")


@query(
    "break_even",
    "SELECT invoice_id, CASE WHEN p_late > 0 THEN round(15.0::DOUBLE / (p_late * p_responds * (3.0::DOUBLE * 0.0003::DOUBLE)), 2) END AS break_even_amount FROM open_valued",
)
def break_even(spark, root):
    rows = decision.break_even(stages.open_predictions(spark, root))
    return tidy(rows.select("invoice_id", "break_even_amount"), money="break_even_amount")


SEGMENT_CASE = """
CASE WHEN avg_days_late > ml AND std_days_late > ms THEN 'high_risk' WHEN avg_days_late > ml THEN 'consistently_late'
  WHEN std_days_late > ms THEN 'volatile' ELSE 'reliable' END"""
SEGMENT_NAMES = (
    "(VALUES ('reliable', 'Prompt & Reliable'), ('consistently_late', 'Late but Predictable'), "
    "('volatile', 'Prompt but Erratic'), ('high_risk', 'Late & Erratic')) s(segment_id, segment)"
)


@query(
    "segments",
    f"""SELECT s.segment_id, s.segment, CAST(count(g.customer_id) AS BIGINT) AS customers,
      round(coalesce(avg(avg_days_late), 0), 6) AS avg_days_late, round(coalesce(avg(std_days_late), 0), 6) AS avg_std,
      round(coalesce(avg(avg_invoice_amount), 0), 2) AS avg_amount
    FROM {SEGMENT_NAMES} LEFT JOIN (
      SELECT *, {SEGMENT_CASE} AS segment_id FROM gold,
        (SELECT quantile_cont(avg_days_late, 0.5) AS ml, quantile_cont(std_days_late, 0.5) AS ms FROM gold WHERE std_days_late IS NOT NULL) m
      WHERE std_days_late IS NOT NULL) g ON g.segment_id = s.segment_id
    GROUP BY s.segment_id, s.segment""",
)
def segments(spark, root):
    gold = materialize(history.gold_customer(stages.closed(spark, root)), "gold")
    return tidy(decision.segment_summary(decision.segment_customers(gold)), money="avg_amount")


@query(
    "segment_scatter",
    f"""SELECT customer_id, round(greatest(least(avg_days_late, 40), -25), 2) AS x, round(greatest(least(std_days_late, 45), 0), 2) AS y,
      {SEGMENT_CASE} AS segment_id, CAST(invoice_count AS BIGINT) AS invoice_count
    FROM gold, (SELECT quantile_cont(avg_days_late, 0.5) AS ml, quantile_cont(std_days_late, 0.5) AS ms FROM gold WHERE std_days_late IS NOT NULL) m
    WHERE std_days_late IS NOT NULL""",
)
def segment_scatter(spark, root):
    gold = materialize(history.gold_customer(stages.closed(spark, root)), "gold")
    rows = decision.segment_customers(gold)
    return tidy(rows.select("customer_id", "x", "y", "segment_id", "invoice_count"))


@query(
    "portfolio_kpis",
    f"""SELECT {out("open_invoices:i total_outstanding:m oldest_age_days:i")} FROM (
      SELECT count(*) AS open_invoices, sum(invoice_amount) AS total_outstanding,
        max(greatest(date_diff('day', posting_date, DATE '2001-01-01'), 0)) AS oldest_age_days FROM opened) x""",
)
def portfolio_kpis(spark, root):
    rows = testdata.outcomes(spark, root).filter("is_open = 1")
    return tidy(decision.portfolio_kpis(rows, F.lit("2001-01-01").cast("date")), money="total_outstanding")


def _post_sql() -> str:
    per = ", ".join(
        f"count(*) FILTER (WHERE action = '{t}') AS n_{t.lower()}, "
        f"coalesce(sum(invoice_amount) FILTER (WHERE action = '{t}'), 0) AS exposure_{t.lower()}, "
        f"coalesce(sum(invoice_amount) FILTER (WHERE action = '{t}'), 0) / sum(invoice_amount) AS share_{t.lower()}"
        for t in TIERS
    )
    cols = " ".join(f"n_{t.lower()}:i exposure_{t.lower()}:m share_{t.lower()}:d" for t in TIERS)
    return f"""SELECT {out("mean_days_late_ceil:i predicted_late:i call_ev:m mean_interval_width:d value_at_risk:m " + cols)} FROM (
      SELECT ceil(avg(days_late_pred)) AS mean_days_late_ceil, count(*) FILTER (WHERE days_late_pred > 0) AS predicted_late,
        coalesce(sum(expected_value) FILTER (WHERE action = 'CALL'), 0) AS call_ev,
        avg(abs(days_late_upper - days_late_lower)) AS mean_interval_width,
        coalesce(sum(invoice_amount) FILTER (WHERE days_late_pred > 0), 0) AS value_at_risk, {per}
      FROM capped) x"""


@query("post_kpis", _post_sql())
def post_kpis(spark, root):
    money = "call_ev value_at_risk " + " ".join(f"exposure_{t.lower()}" for t in TIERS)
    return tidy(decision.post_prediction_kpis(stages.capped(spark, root)), money=money)


@query(
    "display_bands",
    """SELECT delay_band, risk_band, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT CASE WHEN ceil(days_late_pred) > 7 THEN 'high' WHEN ceil(days_late_pred) >= 3 THEN 'mid'
          WHEN ceil(days_late_pred) >= 1 THEN 'low' ELSE 'ok' END AS delay_band,
        CASE WHEN p_late >= 0.7 THEN 'high' WHEN p_late >= 0.4 THEN 'mid' ELSE 'low' END AS risk_band FROM open_valued) x
    GROUP BY delay_band, risk_band""",
)
def display_bands(spark, root):
    rows = decision.value_predictions(stages.open_predictions(spark, root))
    return rows.groupBy(
        S.delay_band(F.ceil("days_late_pred")).alias("delay_band"), S.risk_band(F.col("p_late")).alias("risk_band")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "page_of_invoices",
    """SELECT invoice_id, customer_id, round(invoice_amount, 2) AS invoice_amount, posting_date, CAST(2 AS BIGINT) AS page,
      (SELECT count(*) FROM opened) AS total, CAST(ceil((SELECT count(*) FROM opened) / 50.0) AS BIGINT) AS pages
    FROM opened ORDER BY posting_date, invoice_id LIMIT 50 OFFSET 50""",
)
def page_of_invoices(spark, root):
    rows = testdata.outcomes(spark, root).filter("is_open = 1")
    rows = rows.select("invoice_id", "customer_id", "invoice_amount", "posting_date")
    return tidy(
        ordering.page(rows, 2, 50, F.col("posting_date"), F.col("invoice_id")), money="invoice_amount"
    )
