"""Building blocks for the check SQL: named CTEs that are pulled in by name, with their own
dependencies, and a short notation for typed result columns."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


def _needed(text: str, seen: set[str]) -> set[str]:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", text):
            seen.add(name)
            _needed(CTES[name], seen)
    return seen


def sql(body: str) -> str:
    """``body`` preceded by every CTE it mentions, directly or through another CTE."""
    used = _needed(body, set())
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in used]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def out(spec: str) -> str:
    """``name`` as is, ``name:i`` BIGINT, ``name:d`` DOUBLE to 6 digits, ``name:m`` to cents."""
    forms = {
        "i": "CAST({n} AS BIGINT) AS {n}",
        "d": "round(CAST({n} AS DOUBLE), 6) AS {n}",
        "m": "round(CAST({n} AS DOUBLE), 2) AS {n}",
        "s": "{n}",
    }
    cells = []
    for token in spec.split():
        name, _, kind = token.partition(":")
        cells.append(forms[kind or "s"].format(n=name))
    return ", ".join(cells)


HIST = "cust_avg_days_late cust_std_days_late cust_invoice_count cust_min_late cust_max_late cust_avg_amount"
HIST_OUT = (
    "cust_avg_days_late:d cust_std_days_late:d cust_invoice_count:d cust_min_late:d cust_max_late:d "
    "cust_avg_amount:d"
)
HIST_LIST = HIST.split()


def asof(rows: str, timeline: str, defaults: str = "defaults", keep: bool = False) -> str:
    """As-of join of a row source with a timeline, strictly before the posting date."""
    cells = ", ".join(f"coalesce(t.{c}, d.{c}) AS {c}" for c in HIST_LIST)
    extra = ", t.clear_date AS hist_asof" if keep else ""
    return (
        f"SELECT r.*, {cells}{extra} FROM {rows} r ASOF LEFT JOIN {timeline} t "
        f"ON r.customer_id = t.customer_id AND r.posting_date > t.clear_date CROSS JOIN {defaults} d"
    )


# Exact for whole days: integer sums carry no order-dependent rounding, so equal histories give
# equal values. Bin edges coincide with such values, and noise would move rows across them.
EXACT_STD = """coalesce(sqrt(greatest(CAST(sum(days_late * days_late) OVER w AS DOUBLE)
      - CAST(sum(days_late) OVER w AS DOUBLE) * CAST(sum(days_late) OVER w AS DOUBLE) / count(days_late) OVER w, 0.0::DOUBLE)
      / nullif(CAST(count(days_late) OVER w - 1 AS DOUBLE), 0)), 0.0)"""


def _timeline(source: str, std: str = EXACT_STD) -> str:
    return f"""
  SELECT DISTINCT customer_id, clear_date,
    avg(days_late) OVER w AS cust_avg_days_late,
    {std} AS cust_std_days_late,
    CAST(count(days_late) OVER w AS DOUBLE) AS cust_invoice_count,
    CAST(min(days_late) OVER w AS DOUBLE) AS cust_min_late,
    CAST(max(days_late) OVER w AS DOUBLE) AS cust_max_late,
    sum(CAST(invoice_amount AS DECIMAL(38, 2))) OVER w / count(invoice_amount) OVER w AS cust_avg_amount
  FROM {source} WHERE clear_date IS NOT NULL
  WINDOW w AS (PARTITION BY customer_id ORDER BY clear_date)"""


cte(
    "ledger",
    """
  SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    c_name AS customer_name, c_mktsegment AS business_code,
    CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice ELSE o_totalprice END AS invoice_amount,
    posting AS posting_date, posting + allowed AS due_date, o_orderpriority AS payment_terms,
    CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open,
    CASE WHEN o_orderstatus <> 'O' THEN lag_days END AS days_late,
    CASE WHEN o_orderstatus <> 'O' THEN posting + allowed + lag_days END AS clear_date
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS posting,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 15 WHEN '2' THEN 20 WHEN '3' THEN 30
            WHEN '4' THEN 45 ELSE 60 END AS allowed,
          CAST((7 * o_orderkey + 13 * o_custkey) % 41 - 10
            + CASE WHEN o_orderkey % 53 = 0 THEN 60 ELSE 0 END AS INTEGER) AS lag_days
        FROM orders) o
  LEFT JOIN customer ON o_custkey = c_custkey""",
)
cte("labelled", "SELECT * FROM ledger WHERE is_open = 0 AND days_late IS NOT NULL")
cte("opened", "SELECT * FROM ledger WHERE is_open = 1")
cte("paid", "SELECT invoice_id, clear_date FROM ledger WHERE is_open = 0")
cte(
    "feed",
    """
  SELECT substr(sha1('created:' || invoice_id), 1, 24) AS _event_id, 'ledger' AS _source,
    'invoice_created' AS event_type, strftime(posting_date, '%Y-%m-%d') || 'T00:00:00' AS event_timestamp,
    invoice_id, customer_id, customer_name, invoice_amount,
    strftime(posting_date, '%Y-%m-%d') AS posting_date, strftime(due_date, '%Y-%m-%d') AS due_date,
    payment_terms, business_code, CAST(NULL AS VARCHAR) AS clear_date
  FROM ledger
  UNION ALL
  SELECT substr(sha1('paid:' || invoice_id), 1, 24), 'ledger', 'invoice_paid',
    strftime(clear_date, '%Y-%m-%d') || 'T00:00:00', invoice_id, customer_id, NULL, NULL, NULL, NULL, NULL, NULL,
    strftime(clear_date, '%Y-%m-%d')
  FROM ledger WHERE clear_date IS NOT NULL""",
)
cte(
    "defects",
    """
  SELECT * REPLACE (
      CASE WHEN defect = 1 THEN '31/02/2020' ELSE posting_date END AS posting_date,
      CASE WHEN defect = 2 THEN NULL ELSE invoice_amount END AS invoice_amount,
      CASE WHEN defect = 3 THEN '1990-01-01' ELSE due_date END AS due_date,
      CASE WHEN defect = 4 THEN NULL ELSE invoice_id END AS invoice_id,
      CASE WHEN defect > 0 THEN _event_id || '-bad' ELSE _event_id END AS _event_id)
  FROM (SELECT *, CAST(invoice_id AS BIGINT) % 50 = 0 AS again,
          CASE WHEN event_type = 'invoice_created' AND CAST(invoice_id AS BIGINT) % 100 BETWEEN 1 AND 4
            THEN CAST(invoice_id AS BIGINT) % 100 ELSE 0 END AS defect FROM feed) f""",
)
cte(
    "bronze",
    """
  SELECT * EXCLUDE (again, defect), TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at FROM defects
  UNION ALL
  SELECT * EXCLUDE (again, defect), TIMESTAMP '2024-01-02 00:00:00' FROM defects WHERE again""",
)
cte(
    "deduped",
    "SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY _event_id ORDER BY _ingested_at DESC) = 1",
)
cte(
    "inv_tagged",
    """
  SELECT *, CASE WHEN invoice_id IS NULL THEN 'null_invoice_id'
      WHEN customer_id IS NULL THEN 'null_customer_id'
      WHEN posting_date IS NULL THEN 'unparseable_posting_date'
      WHEN due_date IS NULL THEN 'unparseable_due_date'
      WHEN due_date < posting_date THEN 'due_before_posting'
      WHEN invoice_amount IS NULL THEN 'null_amount'
      WHEN abs(invoice_amount) > 1e8 THEN 'implausible_amount' END AS reason
  FROM (SELECT * REPLACE (CAST(try_strptime(posting_date, '%Y-%m-%d') AS DATE) AS posting_date,
                          CAST(try_strptime(due_date, '%Y-%m-%d') AS DATE) AS due_date)
        FROM deduped WHERE event_type = 'invoice_created') e""",
)
cte("inv_tagged_raw", CTES["inv_tagged"].replace("deduped", "bronze"))
cte(
    "pay_tagged",
    """
  SELECT *, CASE WHEN invoice_id IS NULL THEN 'null_invoice_id'
      WHEN clear_date IS NULL THEN 'unparseable_clear_date' END AS reason
  FROM (SELECT * REPLACE (CAST(try_strptime(clear_date, '%Y-%m-%d') AS DATE) AS clear_date)
        FROM deduped WHERE event_type = 'invoice_paid') e""",
)
cte("pay_tagged_raw", CTES["pay_tagged"].replace("deduped", "bronze"))
cte(
    "rejected",
    """
  SELECT _event_id, event_type, invoice_id, reason AS _reject_reason, _ingested_at FROM inv_tagged WHERE reason IS NOT NULL
  UNION ALL
  SELECT _event_id, event_type, invoice_id, reason, _ingested_at FROM pay_tagged WHERE reason IS NOT NULL""",
)
cte(
    "silver_inv",
    """
  SELECT invoice_id, customer_id, customer_name, invoice_amount, posting_date, due_date, payment_terms,
    business_code, _event_id, _ingested_at FROM inv_tagged WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY _ingested_at DESC, _event_id) = 1""",
)
cte(
    "silver_pay",
    """
  SELECT invoice_id, clear_date, _event_id, _ingested_at FROM pay_tagged WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY _ingested_at DESC, _event_id) = 1""",
)
cte(
    "silver_out",
    """
  SELECT i.*, p.clear_date, date_diff('day', i.due_date, p.clear_date) AS days_late,
    CASE WHEN p.clear_date IS NULL THEN 1 ELSE 0 END AS is_open
  FROM silver_inv i LEFT JOIN silver_pay p ON i.invoice_id = p.invoice_id""",
)
cte("timeline", _timeline("labelled"))
cte("timeline_builtin_std", _timeline("labelled", "coalesce(stddev_samp(days_late) OVER w, 0.0)"))
cte("cut", "SELECT quantile_disc(posting_date, 0.8) AS cutoff_date FROM labelled")
cte("cut90", "SELECT quantile_disc(posting_date, 0.9) AS cutoff_date FROM labelled")
cte(
    "folded",
    "SELECT l.*, CASE WHEN posting_date < cutoff_date THEN 'train' ELSE 'test' END AS fold FROM labelled l, cut",
)
cte("train", "SELECT * EXCLUDE (fold) FROM folded WHERE fold = 'train'")
cte("test", "SELECT * EXCLUDE (fold) FROM folded WHERE fold = 'test'")
cte("train_timeline", _timeline("train"))
cte(
    "defaults",
    """
  SELECT coalesce(avg(days_late), 0.0) AS cust_avg_days_late, coalesce(stddev_samp(days_late), 0.0) AS cust_std_days_late,
    CAST(0.0 AS DOUBLE) AS cust_invoice_count, CAST(coalesce(min(days_late), 0) AS DOUBLE) AS cust_min_late,
    CAST(coalesce(max(days_late), 0) AS DOUBLE) AS cust_max_late, coalesce(avg(invoice_amount), 0.0) AS cust_avg_amount
  FROM train""",
)
cte(
    "gold",
    """
  SELECT customer_id, avg(days_late) AS avg_days_late, stddev_samp(days_late) AS std_days_late,
    quantile_disc(days_late, 0.5) AS median_days_late, avg(CAST(days_late > 0 AS DOUBLE)) AS late_rate,
    count(*) AS invoice_count, avg(invoice_amount) AS avg_invoice_amount, max(days_late) AS max_days_late,
    avg(days_late) FILTER (WHERE clear_date >= as_of - 90) AS recent_90d_avg_days_late,
    avg(CAST(days_late > 0 AS DOUBLE)) FILTER (WHERE clear_date >= as_of - 30) AS recent_30d_late_rate,
    any_value(as_of) AS as_of_date
  FROM labelled, (SELECT max(clear_date) AS as_of FROM labelled) m GROUP BY customer_id""",
)
cte(
    "enc",
    """
  SELECT col AS "column", value, dense_rank() OVER (PARTITION BY col ORDER BY value) - 1 AS code
  FROM (SELECT DISTINCT 'payment_terms' AS col, payment_terms AS value FROM train WHERE payment_terms IS NOT NULL
        UNION ALL SELECT DISTINCT 'business_code', business_code FROM train WHERE business_code IS NOT NULL) v""",
)
CALENDAR = """ln(1 + abs(invoice_amount)) AS amount_log, month(posting_date) AS month, isodow(posting_date) - 1 AS day_of_week,
    CASE WHEN day(posting_date) > 25 THEN 1 ELSE 0 END AS is_month_end,
    CASE WHEN month(posting_date) = 12 THEN 1 ELSE 0 END AS is_year_end"""
cte("train_state", asof("train", "train_timeline"))
cte("test_state", asof("test", "train_timeline"))
cte("open_state", asof("opened", "timeline"))


def features(state: str) -> str:
    return f"""
  SELECT s.*, {CALENDAR}, coalesce(a.code, -1) AS payment_terms_encoded, coalesce(b.code, -1) AS business_code_encoded
  FROM {state} s LEFT JOIN enc a ON a."column" = 'payment_terms' AND a.value = s.payment_terms
  LEFT JOIN enc b ON b."column" = 'business_code' AND b.value = s.business_code"""


cte("train_features", features("train_state"))
cte("test_features", features("test_state"))
cte("open_features", features("open_state"))


def p_late(lower: str, upper: str) -> str:
    lo, hi = f"least({lower}, {upper})", f"greatest({lower}, {upper})"
    return (
        f"CASE WHEN {hi} < 0 THEN 0.05::DOUBLE WHEN {lo} > 5 THEN 0.95::DOUBLE "
        f"ELSE greatest(least({hi} / greatest({hi} - {lo}, 1.0::DOUBLE), 1.0::DOUBLE), 0.0::DOUBLE) END"
    )


P_RESPONDS = "greatest(least(1.0::DOUBLE - cust_std_days_late / 20.0::DOUBLE, 0.8::DOUBLE), 0.2::DOUBLE)"
BENEFIT = "(3.0::DOUBLE * 0.0003::DOUBLE) * abs(invoice_amount)"


def valued(rows: str) -> str:
    late = p_late("days_late_lower", "days_late_upper")
    return f"""
  SELECT * REPLACE (round(ev, 2) AS ev) FROM (
    SELECT *, p_late * p_responds * {BENEFIT} - 15.0::DOUBLE AS ev,
      CASE WHEN ceil(days_late_pred) <= 0 THEN 'OK' WHEN ceil(days_late_pred) > 7 THEN 'CALL'
        WHEN ceil(days_late_pred) < 3 THEN 'WATCH' WHEN abs(invoice_amount) > 50000 THEN 'CALL'
        ELSE 'REMIND' END AS tier
    FROM (SELECT *, {late} AS p_late, {P_RESPONDS} AS p_responds FROM {rows}) a) b"""


def baseline(state: str, z: str = "1.2816") -> str:
    half = f"{z}::DOUBLE * cust_std_days_late"
    return (
        f"SELECT *, cust_avg_days_late AS days_late_pred, cust_avg_days_late - {half} AS days_late_lower, "
        f"cust_avg_days_late + {half} AS days_late_upper FROM {state}"
    )


cte("open_pred", baseline("open_state"))
cte("test_pred", baseline("test_state"))
cte("test_scored", "SELECT *, days_late AS actual FROM test_pred")
cte("open_valued", valued("open_pred"))
cte(
    "capped",
    """
  SELECT *, CASE WHEN tier = 'CALL' AND row_number() OVER (PARTITION BY tier ORDER BY ev DESC, invoice_id) > 20
      THEN 'REMIND' ELSE tier END AS action, ev AS expected_value FROM open_valued""",
)
TIER_NO = "CASE action WHEN 'CALL' THEN 0 WHEN 'REMIND' THEN 1 WHEN 'WATCH' THEN 2 ELSE 3 END"
cte(
    "queue",
    f"""
  SELECT * REPLACE (round(p_responds, 3) AS p_responds),
    row_number() OVER (ORDER BY {TIER_NO}, expected_value DESC, invoice_id) AS rank,
    DATE '2024-02-01' AS queue_date,
    due_date + CAST(ceil(days_late_pred) AS INTEGER) AS predicted_payment_date
  FROM capped""",
)
cte(
    "scope",
    """
  SELECT l.*, CASE WHEN is_open = 1 THEN 'open' ELSE 'backtest' END AS scoring_mode FROM ledger l, cut
  WHERE is_open = 1 OR posting_date >= cutoff_date""",
)
cte("scope_state", asof("scope", "timeline"))
cte(
    "pred_log",
    f"""
  SELECT *, {p_late("days_late_lower", "days_late_upper")} AS p_late FROM (
    SELECT s.*, ln(1 + abs(invoice_amount)) AS amount_log, cust_avg_days_late AS days_late_pred,
      cust_avg_days_late - z * cust_std_days_late AS days_late_lower,
      cust_avg_days_late + z * cust_std_days_late AS days_late_upper,
      due_date + CAST(ceil(cust_avg_days_late) AS INTEGER) AS predicted_payment_date,
      'baseline' AS model_name, version AS model_version, run_id AS model_run_id, scored_at
    FROM scope_state s, cut90, (VALUES (1.0::DOUBLE, '1', 'run-1', TIMESTAMP '2024-01-01 06:00:00'),
                              (1.2816::DOUBLE, '2', 'run-2', TIMESTAMP '2024-02-01 06:00:00')) r(z, version, run_id, scored_at)
    WHERE version = '1' OR is_open = 1 OR posting_date >= cut90.cutoff_date) x""",
)
cte(
    "latest_open_log",
    "SELECT * FROM pred_log WHERE scoring_mode = 'open' QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY scored_at DESC) = 1",
)
cte(
    "latest_mode_log",
    "SELECT * FROM pred_log QUALIFY row_number() OVER (PARTITION BY invoice_id, scoring_mode ORDER BY scored_at DESC) = 1",
)
cte(
    "outcome_labels",
    """
  SELECT l.* EXCLUDE (clear_date), p.clear_date, date_diff('day', l.due_date, p.clear_date) AS actual_days_late,
    p.clear_date IS NOT NULL AS has_label, date_diff('day', l.posting_date, p.clear_date) AS label_lag_days
  FROM latest_mode_log l LEFT JOIN paid p ON l.invoice_id = p.invoice_id""",
)
