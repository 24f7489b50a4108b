"""Customer-history and feature queries."""

import uuid

from pyspark.sql import functions as F

from ..operators import features, history
from ..schemas import HIST_COLS, RAW_INPUT_COLS
from ..session import new_folder
from ..sources import testdata
from ..sources.tables import Tables
from . import stages
from .registry import query, tidy
from .sqlkit import CALENDAR, HIST_OUT, asof, out


@query("customer_timeline", f"SELECT {out('customer_id clear_date ' + HIST_OUT)} FROM timeline_builtin_std")
def customer_timeline(spark, root):
    return tidy(stages.full_timeline(spark, root))


@query(
    "asof_history",
    f"""SELECT {out('invoice_id customer_id posting_date is_open:i ' + HIST_OUT)}, hist_asof
    FROM ({asof("ledger", "timeline", keep=True)}) s""",
)
def asof_history(spark, root):
    rows = history.asof_history(
        testdata.outcomes(spark, root),
        stages.full_timeline(spark, root),
        stages.defaults(spark, root),
        keep_asof=True,
    )
    return tidy(
        rows.select(
            "invoice_id", "customer_id", "posting_date", "is_open", *HIST_COLS, F.col("_hist_asof").alias("hist_asof")
        )
    )


@query(
    "event_asof",
    """SELECT CAST(p.event_id AS BIGINT) AS event_id, CAST(p.user_id AS BIGINT) AS user_id, p.day,
      e.day AS seen_on, CAST(e.errors_so_far AS BIGINT) AS errors_so_far
    FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, day, sum(n) OVER (PARTITION BY user_id ORDER BY day) AS errors_so_far
        FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1, 2) d) e
    ON p.user_id = e.user_id AND p.day > e.day""",
)
def event_asof(spark, root):
    """The as-of join on another table: each purchase sees the user's error count up to the day before."""
    from pyspark.sql import Window

    rows = testdata.table(spark, root, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type"
    )
    upto = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    errors = (
        rows.filter("event_type = 'error'")
        .groupBy("user_id", "day")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("user_id", "day", F.sum("n").over(upto).alias("errors_so_far"))
    )
    purchases = rows.filter("event_type = 'purchase'").drop("event_type")
    return history.asof_join(purchases, errors, "user_id", "day", "day", ["errors_so_far"]).select(
        "event_id", "user_id", "day", F.col("_hist_asof").alias("seen_on"), "errors_so_far"
    )


@query(
    "event_asof_time",
    """SELECT CAST(p.event_id AS BIGINT) AS event_id, CAST(p.user_id AS BIGINT) AS user_id, p.ts, e.ts AS seen_at,
      CAST(e.last_error AS BIGINT) AS last_error
    FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS last_error FROM events WHERE event_type = 'error' GROUP BY 1, 2) e
    ON p.user_id = e.user_id AND p.ts > e.ts""",
)
def event_asof_time(spark, root):
    """To the microsecond: each purchase sees the user's last error strictly before it."""
    rows = testdata.table(spark, root, "events").select("event_id", "user_id", "ts", "event_type")
    errors = rows.filter("event_type = 'error'").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_error"))
    purchases = rows.filter("event_type = 'purchase'").drop("event_type")
    return history.asof_join_ranges(purchases, errors, "user_id", "ts", "ts", ["last_error"]).select(
        "event_id", "user_id", "ts", F.col("_hist_asof").alias("seen_at"), "last_error"
    )


@query(
    "feature_store",
    f"""SELECT l.invoice_id, {out('customer_id ' + HIST_OUT)} FROM (SELECT invoice_id, customer_id FROM ledger) l
    LEFT JOIN (SELECT * FROM timeline QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY clear_date DESC) = 1) s
    USING (customer_id)""",
)
def feature_store(spark, root):
    """Every invoice with its customer's latest state from a table bucketed by customer: the stored
    side is read in its buckets, only the invoices are shuffled."""
    tables = Tables(spark, new_folder(spark, "features"))
    name = f"customer_state_{uuid.uuid4().hex}"
    stored = tables.feature_table(history.latest_state(stages.full_timeline(spark, root)), name, "customer_id", 16)
    rows = testdata.outcomes(spark, root).select("invoice_id", "customer_id")
    # Broadcasting the table would need no buckets; at the size it is meant for it is not broadcast.
    joined = rows.join(stored.hint("merge"), "customer_id", "left")
    return tidy(joined.select("invoice_id", "customer_id", *HIST_COLS))


@query(
    "latest_state",
    f"""SELECT {out('customer_id ' + HIST_OUT)} FROM timeline
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY clear_date DESC) = 1""",
)
def latest_state(spark, root):
    return tidy(history.latest_state(stages.full_timeline(spark, root)))


GOLD_OUT = (
    "customer_id avg_days_late:d std_days_late:d median_days_late:i late_rate:d invoice_count:i "
    "avg_invoice_amount:d max_days_late:i recent_90d_avg_days_late:d recent_30d_late_rate:d as_of_date"
)


@query("gold_customer", f"SELECT {out(GOLD_OUT)} FROM gold")
def gold_customer(spark, root):
    return tidy(history.gold_customer(stages.closed(spark, root)))


@query(
    "static_history",
    f"""SELECT {out('customer_id ' + HIST_OUT + ' cust_total_amount:m')} FROM (
      SELECT customer_id, avg(days_late) AS cust_avg_days_late, coalesce(stddev_samp(days_late), 0) AS cust_std_days_late,
        count(days_late) AS cust_invoice_count, min(days_late) AS cust_min_late, max(days_late) AS cust_max_late,
        avg(invoice_amount) AS cust_avg_amount, sum(invoice_amount) AS cust_total_amount
      FROM labelled GROUP BY customer_id) s""",
)
def static_history(spark, root):
    return tidy(history.static_history(stages.closed(spark, root)), money="cust_total_amount")


@query(
    "loo_history",
    f"""SELECT {out('invoice_id customer_id ' + HIST_OUT)} FROM (
      SELECT invoice_id, customer_id,
        CASE WHEN n > 1 THEN (s - days_late) / CAST(n - 1 AS DOUBLE) ELSE 0 END AS cust_avg_days_late,
        CASE WHEN n > 1 THEN sqrt(greatest((ss - days_late * days_late) / CAST(n - 1 AS DOUBLE)
          - power((s - days_late) / CAST(n - 1 AS DOUBLE), 2), 0)) ELSE 0 END AS cust_std_days_late,
        n - 1 AS cust_invoice_count, lo AS cust_min_late, hi AS cust_max_late, amt AS cust_avg_amount
      FROM (SELECT *, count(days_late) OVER w AS n, sum(days_late) OVER w AS s, sum(days_late * days_late) OVER w AS ss,
              min(days_late) OVER w AS lo, max(days_late) OVER w AS hi, avg(invoice_amount) OVER w AS amt
            FROM labelled WINDOW w AS (PARTITION BY customer_id)) x) y""",
)
def loo_history(spark, root):
    rows = history.loo_history(stages.closed(spark, root))
    return tidy(rows.select("invoice_id", "customer_id", *HIST_COLS))


@query(
    "leaky_vs_pit",
    f"""SELECT {out('invoice_id customer_id posting_date days_late:i leaky_avg:d pit_avg:d pit_count:d')} FROM (
      SELECT s.invoice_id, s.customer_id, s.posting_date, s.days_late, h.leaky_avg, s.cust_avg_days_late AS pit_avg,
        s.cust_invoice_count AS pit_count
      FROM ({asof("labelled", "timeline")}) s
      LEFT JOIN (SELECT customer_id, avg(days_late) AS leaky_avg FROM labelled GROUP BY customer_id) h
        ON h.customer_id = s.customer_id) x""",
)
def leaky_vs_pit(spark, root):
    return tidy(
        history.leaky_vs_point_in_time(
            stages.closed(spark, root), stages.full_timeline(spark, root), stages.defaults(spark, root)
        )
    )


@query(
    "history_audit",
    """SELECT strftime(l.posting_date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS invoices,
      CAST(sum(coalesce(h.n, 0)) AS BIGINT) AS history_rows_seen, CAST(0 AS BIGINT) AS future_history
    FROM ledger l LEFT JOIN (
      SELECT a.invoice_id, count(*) AS n FROM ledger a JOIN labelled b
        ON a.customer_id = b.customer_id AND b.clear_date < a.posting_date GROUP BY a.invoice_id) h
      ON h.invoice_id = l.invoice_id
    GROUP BY 1""",
)
def history_audit(spark, root):
    """Evidence every invoice saw, per month: the check SQL recounts it with the theta join over
    all earlier payments, Spark reads it off the as-of state."""
    zero = {c: 0.0 for c in HIST_COLS}
    rows = history.asof_history(
        testdata.outcomes(spark, root), stages.full_timeline(spark, root), zero, keep_asof=True
    )
    return rows.groupBy(F.date_format("posting_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("invoices"),
        F.sum("cust_invoice_count").cast("long").alias("history_rows_seen"),
        F.count_if(F.col("_hist_asof") >= F.col("posting_date")).alias("future_history"),
    )


@query(
    "invoice_features",
    f"""SELECT {out("invoice_id posting_date amount_log:d month:i day_of_week:i is_month_end:i is_year_end:i")}
    FROM (SELECT *, {CALENDAR} FROM ledger) x""",
)
def invoice_features(spark, root):
    rows = features.invoice_features(testdata.outcomes(spark, root))
    return tidy(
        rows.select("invoice_id", "posting_date", "amount_log", "month", "day_of_week", "is_month_end", "is_year_end")
    )


@query("encoder_fit", 'SELECT "column", value, CAST(code AS BIGINT) AS code FROM enc')
def encoder_fit(spark, root):
    return tidy(stages.Folds(spark, root, with_customer=True).encoders())


@query(
    "encoder_apply",
    """SELECT l.invoice_id, CAST(coalesce(a.code, -1) AS BIGINT) AS payment_terms_encoded,
      CAST(coalesce(b.code, -1) AS BIGINT) AS business_code_encoded
    FROM (SELECT invoice_id, CASE WHEN CAST(invoice_id AS BIGINT) % 40 = 7 THEN 'UNSEEN' ELSE payment_terms END AS pt,
            CASE WHEN CAST(invoice_id AS BIGINT) % 60 <> 11 THEN business_code END AS bc FROM ledger) l
    LEFT JOIN enc a ON a."column" = 'payment_terms' AND a.value = l.pt
    LEFT JOIN enc b ON b."column" = 'business_code' AND b.value = l.bc""",
)
def encoder_apply(spark, root):
    """Encoders on the whole ledger, with some categories made unknown or missing."""
    number = F.col("invoice_id").cast("long")
    rows = testdata.ledger(spark, root).withColumns(
        {
            "payment_terms": F.when(F.pmod(number, F.lit(40)) == 7, "UNSEEN").otherwise(F.col("payment_terms")),
            "business_code": F.when(F.pmod(number, F.lit(60)) != 11, F.col("business_code")),
        }
    )
    coded = features.encode(rows, stages.Folds(spark, root, with_customer=True).encoders())
    return tidy(coded.select("invoice_id", "payment_terms_encoded", "business_code_encoded"))


@query("fold_defaults", f"SELECT {out(HIST_OUT)} FROM defaults")
def fold_defaults(spark, root):
    return tidy(features.fold_defaults(stages.Folds(spark, root).train))


@query(
    "chronological_split",
    """SELECT fold, CAST(count(*) AS BIGINT) AS n, min(posting_date) AS first_posting, max(posting_date) AS last_posting
    FROM folded GROUP BY fold""",
)
def chronological_split(spark, root):
    rows = features.with_fold(stages.closed(spark, root), stages.cutoff_date(spark, root))
    return features.fold_summary(rows)


MATRIX = (
    "invoice_id amount_log:d month:i day_of_week:i is_month_end:i is_year_end:i payment_terms_encoded:i "
    "business_code_encoded:i " + HIST_OUT
)


@query("feature_matrix", f"SELECT {out(MATRIX)} FROM open_features")
def feature_matrix(spark, root):
    f = stages.Folds(spark, root, with_customer=True)
    state = stages.open_state(spark, root, with_customer=True, fitted=f)
    rows = features.encode(features.invoice_features(state), f.encoders())
    return tidy(rows.select(*[t.partition(":")[0] for t in MATRIX.split()]))


@query("input_contract", f"""SELECT {out("amount_log:d month:i day_of_week:i is_month_end:i is_year_end:i " + HIST_OUT)},
    payment_terms, business_code, invoice_id FROM open_features""")
def input_contract(spark, root):
    """Payload of a scorer: source column names in, agreed names and order out."""
    rows = features.invoice_features(stages.open_state(spark, root, with_customer=True)).withColumnsRenamed(
        {"payment_terms": "cust_payment_terms", "invoice_id": "document_id"}
    )
    aliases = {"cust_payment_terms": "payment_terms", "document_id": "invoice_id"}
    return tidy(features.input_contract(rows, [*RAW_INPUT_COLS, "invoice_id"], aliases))
