"""Expected value, action tiers, the capacity-limited queue and its comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..functions.dates import plus_days
from ..params import DecisionParams, ScoringRun
from ..schemas import HIST_COLS, TIERS
from ..session import scalar_row
from .ordering import bracketed_quantiles, rank_rows, sample_n, top_n

DEFAULTS = DecisionParams()


def baseline_predict(df: DataFrame, z: float = 1.2816) -> DataFrame:
    """Closed-form stand-in for a model: customer mean, and mean -/+ z standard deviations."""
    mean, std = F.col("cust_avg_days_late"), F.col("cust_std_days_late")
    return df.withColumns(
        {
            "days_late_pred": mean,
            "days_late_lower": mean - z * std,
            "days_late_upper": mean + z * std,
        }
    )


def order_interval(df: DataFrame) -> DataFrame:
    """Put crossed quantiles in order and add P(late)."""
    lo = F.least("days_late_lower", "days_late_upper")
    hi = F.greatest("days_late_lower", "days_late_upper")
    return df.withColumns({"days_late_lower": lo, "days_late_upper": hi, "p_late": S.p_late(lo, hi)})


LOG_COLS = [
    "invoice_id",
    "customer_id",
    "customer_name",
    "invoice_amount",
    "posting_date",
    "due_date",
    *HIST_COLS,
    "amount_log",
    "payment_terms",
    "business_code",
    "scoring_mode",
    "days_late_pred",
    "days_late_lower",
    "days_late_upper",
    "p_late",
    "predicted_payment_date",
    "model_name",
    "model_version",
    "model_run_id",
    "scored_at",
]


def prediction_log(scored: DataFrame, run: ScoringRun) -> DataFrame:
    """Stamp predictions for the append-only log. All history features are kept, so drift can
    be measured on every one of them."""
    return (
        order_interval(scored)
        .withColumns(
            {
                "predicted_payment_date": plus_days("due_date", F.col("days_late_pred")),
                "model_name": F.lit(run.model_name),
                "model_version": F.lit(run.version),
                "model_run_id": F.lit(run.run_id),
                "scored_at": F.to_timestamp_ntz(F.lit(run.scored_at)),
            }
        )
        .select(*LOG_COLS)
    )


def score_runs(features: DataFrame, runs: list[ScoringRun]) -> DataFrame:
    """Several baseline runs over one feature pass: each row fans out to one row per run."""
    stamps = F.array(
        *[
            F.struct(
                F.lit(r.z).alias("z"),
                F.lit(r.model_name).alias("model_name"),
                F.lit(r.version).alias("model_version"),
                F.lit(r.run_id).alias("model_run_id"),
                F.to_timestamp_ntz(F.lit(r.scored_at)).alias("scored_at"),
            )
            for r in runs
        ]
    )
    mean, std = F.col("cust_avg_days_late"), F.col("cust_std_days_late")
    scored = features.select("*", F.inline(stamps)).withColumns(
        {
            "days_late_pred": mean,
            "days_late_lower": mean - F.col("z") * std,
            "days_late_upper": mean + F.col("z") * std,
            "predicted_payment_date": plus_days("due_date", mean),
        }
    )
    return order_interval(scored).select(*LOG_COLS)


def value_predictions(df: DataFrame, p: DecisionParams = DEFAULTS) -> DataFrame:
    """Add P(late), P(responds), expected value (cents) and the uncapped action tier."""
    amount, lower, upper = (F.col(c) for c in ("invoice_amount", "days_late_lower", "days_late_upper"))
    std = F.col("cust_std_days_late")
    return df.withColumns(
        {
            "p_late": S.p_late(lower, upper),
            "p_responds": S.p_responds(std),
            "expected_value": S.rounded(S.expected_value(amount, lower, upper, std, p), 2),
            "action": S.action_tier(F.col("days_late_pred"), amount, p),
        }
    )


def value_breakdown(df: DataFrame, p: DecisionParams = DEFAULTS) -> DataFrame:
    """The parts an expected value is made of, per invoice."""
    amount, std = F.col("invoice_amount"), F.col("cust_std_days_late")
    benefit = S.call_benefit(amount, p)
    late = S.p_late(F.col("days_late_lower"), F.col("days_late_upper"))
    return df.withColumns(
        {
            "p_late": late,
            "responsiveness": S.p_responds(std),
            "benefit_if_success": benefit,
            "expected_benefit": late * S.p_responds(std) * benefit,
            "call_cost": F.lit(p.call_cost),
            "expected_value": late * S.p_responds(std) * benefit - p.call_cost,
        }
    )


def cap_calls(valued: DataFrame, p: DecisionParams = DEFAULTS) -> DataFrame:
    """Keep the ``daily_capacity`` most valuable calls, demote the rest to REMIND.

    ``invoice_id`` must be unique. The kept ids are a distributed top-k of ``daily_capacity`` rows.
    """
    calls = valued.filter("action = 'CALL'").select("invoice_id", "expected_value")
    kept = top_n(
        calls, p.daily_capacity, F.col("expected_value").desc(), F.col("invoice_id").asc()
    ).select("invoice_id", F.lit(True).alias("_kept"))
    over = (F.col("action") == "CALL") & F.col("_kept").isNull()
    return (
        valued.join(kept, "invoice_id", "left")
        .withColumn("action", F.when(over, "REMIND").otherwise(F.col("action")))
        .drop("_kept")
    )


def queue_order() -> list[Column]:
    return [
        S.tier_order(F.col("action")).asc(),
        F.col("expected_value").desc(),
        F.col("invoice_id").asc(),
    ]


def collection_queue(
    predictions: DataFrame, queue_date: Column | None = None, p: DecisionParams = DEFAULTS
) -> DataFrame:
    """Every open invoice with its action and global rank (tier, then expected value).

    ``predictions`` is read twice (the capacity cap, then the ranking), so pass a stored table.
    """
    capped = cap_calls(value_predictions(predictions, p), p).withColumns(
        {
            "p_responds": S.rounded(F.col("p_responds"), 3),
            "queue_date": queue_date if queue_date is not None else F.current_date(),
        }
    )
    return rank_rows(capped, queue_order())


def top_of_queue(
    predictions: DataFrame, n: int, p: DecisionParams = DEFAULTS
) -> DataFrame:
    """The first n rows of the queue only: no full ranking is needed for those."""
    capped = cap_calls(value_predictions(predictions, p), p)
    head = top_n(capped, n, *queue_order())
    # n rows: numbering them in one task is fine.
    return head.withColumn(
        "rank", F.row_number().over(Window.orderBy(*queue_order())).cast("long")
    )


def date_range(df: DataFrame) -> DataFrame:
    """Payment date with its interval bounds."""
    return df.withColumns(
        {
            "predicted_payment_date": plus_days("due_date", F.col("days_late_pred")),
            "payment_date_lower": plus_days("due_date", F.col("days_late_lower")),
            "payment_date_upper": plus_days("due_date", F.col("days_late_upper")),
        }
    )


def work_order(queue: DataFrame) -> DataFrame:
    """Totals of the CALL slice."""
    return queue.filter("action = 'CALL'").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("expected_value").alias("total_expected_value"),
        F.sum("invoice_amount").alias("value_at_risk"),
        F.avg("p_late").alias("mean_p_late"),
        F.avg("p_responds").alias("mean_p_responds"),
    )


def _ev_of(df: DataFrame, n: int, strategy: str) -> DataFrame:
    ident = F.col("invoice_id").asc()
    chosen = {
        "engine": lambda: top_n(df, n, F.col("expected_value").desc(), ident),
        "amount": lambda: top_n(df, n, F.col("invoice_amount").desc(), ident),
        "random": lambda: sample_n(df, n, "invoice_id"),
        "queue_head": lambda: top_n(df, n, *queue_order()),
    }[strategy]()
    return chosen.agg(F.sum("expected_value").alias("daily_ev"))


def strategy_comparison(
    queue: DataFrame, n: int | None = None, engine: str = "engine", p: DecisionParams = DEFAULTS
) -> DataFrame:
    """Expected value of n calls chosen by the engine, by amount and at random.

    ``engine="queue_head"`` takes the head of the ranked queue (tier first) instead of the top
    by expected value. Each strategy is a distributed top-k over the stored queue.
    """
    n = n or p.daily_capacity
    names = [("Decision engine", engine, 1), ("By amount", "amount", 2), ("Random", "random", 3)]
    rows = [
        _ev_of(queue, n, how).select(
            F.lit(name).alias("strategy"), "daily_ev", F.lit(order).alias("sort_order")
        )
        for name, how, order in names
    ]
    stacked = reduce(DataFrame.union, rows)
    best = scalar_row(rows[0].select("daily_ev"))["daily_ev"]
    return stacked.withColumns(
        {
            "annual_ev": F.col("daily_ev") * p.business_days_per_year,
            "annual_gap_to_engine": (best - F.col("daily_ev")) * p.business_days_per_year,
        }
    )


def v1_priority(df: DataFrame, p: DecisionParams = DEFAULTS) -> DataFrame:
    """First-generation rule: signed amount, zero-width interval means 0.5, call when EV > 0;
    the top ``daily_capacity`` rows by EV are HIGH priority. Every row gets its EV rank."""
    lower, upper = F.col("days_late_lower"), F.col("days_late_upper")
    width = upper - lower
    late = (
        F.when(upper < 0, 0.05)
        .when(lower > 5, 0.95)
        .when(width > 0, S.clip(upper / width, 0.0, 1.0))
        .otherwise(0.5)
    )
    benefit = p.days_accelerated * p.daily_capital_rate * F.col("invoice_amount")
    ev = S.rounded(late * S.p_responds(F.col("cust_std_days_late")) * benefit - p.call_cost, 6)
    valued = df.withColumns({"p_late": late, "expected_value": ev}).select(
        "invoice_id",
        "customer_id",
        "invoice_amount",
        "days_late_pred",
        F.format_string("[%.0f, %.0f]", "days_late_lower", "days_late_upper").alias("prediction_interval"),
        "p_late",
        "expected_value",
        F.when(F.col("expected_value") > 0, "CALL").otherwise("SKIP").alias("recommendation"),
    )
    ranked = rank_rows(valued, [F.col("expected_value").desc(), F.col("invoice_id").asc()])
    return ranked.withColumn(
        "priority", F.when(F.col("rank") <= p.daily_capacity, "HIGH").otherwise("LOW")
    )


def ev_sweep(df: DataFrame, factors: list[float], p: DecisionParams = DEFAULTS) -> DataFrame:
    """How the open book would be valued if every amount were scaled: calls worth making, total
    EV and tier counts per factor. Each row fans out to the fixed list of factors."""
    swept = df.select(
        "days_late_pred",
        "days_late_lower",
        "days_late_upper",
        "cust_std_days_late",
        "invoice_amount",
        F.explode(F.array(*[F.lit(float(f)) for f in factors])).alias("factor"),
    ).withColumn("invoice_amount", F.col("invoice_amount") * F.col("factor"))
    valued = value_predictions(swept, p)
    return valued.groupBy("factor").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("expected_value") > 0).alias("worth_calling"),
        F.sum("expected_value").alias("total_ev"),
        *[F.count_if(F.col("action") == t).alias(f"n_{t.lower()}") for t in TIERS],
    )


def break_even(df: DataFrame, p: DecisionParams = DEFAULTS) -> DataFrame:
    """Invoice size at which a call on each invoice would just pay for itself."""
    rate = (
        S.p_late(F.col("days_late_lower"), F.col("days_late_upper"))
        * S.p_responds(F.col("cust_std_days_late"))
        * (p.days_accelerated * p.daily_capital_rate)
    )
    return df.withColumn("break_even_amount", F.try_divide(F.lit(p.call_cost), rate))


# Segment ids and labels by (late above median, std above median).
SEGMENTS = {
    (False, False): ("reliable", "Prompt & Reliable"),
    (True, False): ("consistently_late", "Late but Predictable"),
    (False, True): ("volatile", "Prompt but Erratic"),
    (True, True): ("high_risk", "Late & Erratic"),
}


def segment_customers(gold: DataFrame, interpolate: bool = True) -> DataFrame:
    """Median split on lateness and on variability; customers without a std are left out. The exact
    medians lie between the two middle values or, without ``interpolate``, are observed values."""
    known = gold.filter(F.col("std_days_late").isNotNull())
    pairs = F.array(*[F.struct(F.lit(c).alias("m"), F.col(c).alias("v")) for c in ("avg_days_late", "std_days_late")])
    medians = bracketed_quantiles(known.select(F.inline(pairs)), "v", [0.5], by="m", interpolate=interpolate)
    late, std = (F.lit(medians[c][0] if medians else None) for c in ("avg_days_late", "std_days_late"))
    is_late, is_erratic = F.col("avg_days_late") > late, F.col("std_days_late") > std

    def pick(i: int) -> Column:
        return (
            F.when(is_late & is_erratic, SEGMENTS[True, True][i])
            .when(is_late, SEGMENTS[True, False][i])
            .when(is_erratic, SEGMENTS[False, True][i])
            .otherwise(SEGMENTS[False, False][i])
        )

    return known.withColumns(
        {
            "segment_id": pick(0),
            "segment": pick(1),
            "x": S.rounded(S.clip(F.col("avg_days_late"), -25.0, 40.0), 2),
            "y": S.rounded(S.clip(F.col("std_days_late"), 0.0, 45.0), 2),
        }
    )


def segment_summary(segmented: DataFrame) -> DataFrame:
    """One row for each of the four segments, zeros where a segment is empty."""
    per = []
    for ident, label in SEGMENTS.values():
        mine = F.col("segment_id") == ident
        mean = lambda c: F.coalesce(F.avg(F.when(mine, F.col(c))), F.lit(0.0))  # noqa: B023, E731
        per.append(
            F.struct(
                F.lit(ident).alias("segment_id"),
                F.lit(label).alias("segment"),
                F.count_if(mine).alias("customers"),
                mean("avg_days_late").alias("avg_days_late"),
                mean("std_days_late").alias("avg_std"),
                mean("avg_invoice_amount").alias("avg_amount"),
            )
        )
    return segmented.agg(F.array(*per).alias("s")).select(F.inline("s"))


def portfolio_kpis(open_rows: DataFrame, as_of: Column) -> DataFrame:
    age = F.greatest(F.datediff(as_of, F.col("posting_date")), F.lit(0))
    return open_rows.agg(
        F.count(F.lit(1)).alias("open_invoices"),
        F.sum("invoice_amount").alias("total_outstanding"),
        F.max(age).alias("oldest_age_days"),
    )


def post_prediction_kpis(queue: DataFrame) -> DataFrame:
    """Headline figures after scoring; all four tiers are always present."""
    amount = F.col("invoice_amount")
    aggs = [
        F.ceil(F.avg("days_late_pred")).cast("long").alias("mean_days_late_ceil"),
        F.count_if(F.col("days_late_pred") > 0).alias("predicted_late"),
        F.coalesce(F.sum(F.when(F.col("action") == "CALL", F.col("expected_value"))), F.lit(0.0)).alias("call_ev"),
        F.avg(F.abs(F.col("days_late_upper") - F.col("days_late_lower"))).alias("mean_interval_width"),
        F.coalesce(F.sum(F.when(F.col("days_late_pred") > 0, amount)), F.lit(0.0)).alias("value_at_risk"),
        F.sum(amount).alias("_all"),
    ]
    for t in TIERS:
        mine = F.col("action") == t
        aggs += [
            F.count_if(mine).alias(f"n_{t.lower()}"),
            F.coalesce(F.sum(F.when(mine, amount)), F.lit(0.0)).alias(f"exposure_{t.lower()}"),
        ]
    out = queue.agg(*aggs)
    shares = {
        f"share_{t.lower()}": F.try_divide(F.col(f"exposure_{t.lower()}"), F.col("_all")) for t in TIERS
    }
    return out.withColumns(shares).drop("_all")
