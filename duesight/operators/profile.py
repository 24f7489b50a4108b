"""Exploratory profiles of a ledger, each one aggregation."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scalar_row
from .ordering import quantiles


def _late_rate() -> Column:
    return F.avg((F.col("days_late") > 0).cast("double"))


def column_profile(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Type, nulls and distinct values per column, in one aggregation."""
    names = columns or df.columns
    types = dict(df.dtypes)
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"{c}__set") for c in names],
        *[distinct(F.col(c)).alias(f"{c}__distinct") for c in names],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("dtype"),
            (F.col("_rows") - F.col(f"{c}__set")).alias("nulls"),
            (F.try_divide(F.col("_rows") - F.col(f"{c}__set"), F.col("_rows")) * 100).alias("null_pct"),
            F.col(f"{c}__distinct").alias("n_unique"),
        )
        for c in names
    ]
    return stats.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column; exact quartiles for all in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    tall = df.select(F.inline(pairs)).filter("value is not null")
    moments = tall.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    cuts = quantiles(tall, "value", [0.25, 0.5, 0.75], by="column_name")
    wide = cuts.groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("q") == q, F.col("value"))).alias(name)
            for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
    )
    # One row per described column.
    return moments.join(F.broadcast(wide), "column_name")


def shape_stats(closed: DataFrame) -> DataFrame:
    """Shares of late, on-time and very late rows; population skewness and excess kurtosis."""
    late = F.col("days_late")
    return closed.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((late > 0).cast("double")).alias("late_share"),
        F.avg((late <= 0).cast("double")).alias("on_time_share"),
        F.avg((late > 30).cast("double")).alias("very_late_share"),
        F.skewness(late).alias("skewness"),
        F.kurtosis(late).alias("kurtosis"),
    )


def grouped_rates(closed: DataFrame, key: str, min_rows: int = 1) -> DataFrame:
    """Lateness per category, for categories with at least ``min_rows`` rows."""
    return (
        closed.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("days_late").alias("avg_late"),
            _late_rate().alias("late_rate"),
            F.avg("invoice_amount").alias("avg_amount"),
        )
        .filter(F.col("n") >= min_rows)
    )


def concentration(closed: DataFrame, thresholds: list[int] = [1, 2, 5, 10]) -> DataFrame:  # noqa: B006
    """Customers with at most t invoices and the share of rows they cover."""
    per = closed.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    rows = []
    for t in thresholds:
        small = F.col("n") <= t
        rows.append(
            F.struct(
                F.lit(t).alias("max_invoices"),
                F.count_if(small).alias("customers"),
                (F.try_divide(F.sum(F.when(small, F.col("n")).otherwise(0)), F.sum("n")) * 100).alias("pct_rows"),
            )
        )
    return per.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def monthly(closed: DataFrame) -> DataFrame:
    """Lateness per posting month, labelled by month end; months without rows are present."""
    month = F.trunc("posting_date", "month")
    per = closed.groupBy(month.alias("month")).agg(
        F.avg("days_late").alias("avg_late"), F.count(F.lit(1)).alias("n")
    )
    span = closed.agg(F.min(month).alias("a"), F.max(month).alias("b")).filter("a is not null")
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return spine.join(per, "month", "left").select(
        F.last_day("month").alias("month_end"), "avg_late", F.coalesce("n", F.lit(0)).alias("n")
    )


def histogram(df: DataFrame, value: Column, low: float, high: float, width: float) -> DataFrame:
    """Counts per fixed-width bin; values are clipped into ``[low, high]``."""
    clipped = F.greatest(F.least(value.cast("double"), F.lit(float(high))), F.lit(float(low)))
    last = int(round((high - low) / width)) - 1
    bin_no = F.least(F.floor((clipped - low) / width), F.lit(last)).cast("int")
    return (
        df.filter(value.isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(float(low)) + F.col("bin") * F.lit(float(width)))
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every pair of columns with its Pearson correlation (NULL for a constant column).

    Each pair uses the rows that have both values. A row becomes its pairs, which are summed
    before the shuffle: one row for each pair leaves a task.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    cells = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for a, b in pairs
    ]
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y = F.when(both, F.col("x")), F.when(both, F.col("y"))
    found = df.select(F.inline(F.array(*cells))).groupBy("feature_a", "feature_b")
    return found.agg(F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y))).alias("corr"))


def sanity_counts(features: DataFrame) -> DataFrame:
    """Cold starts, unseen categories and open rows in a scored frame."""
    return features.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("cust_invoice_count") == 0).alias("cold_start"),
        F.count_if(F.col("payment_terms_encoded") == -1).alias("unseen_terms"),
        F.count_if(F.col("business_code_encoded") == -1).alias("unseen_codes"),
        F.count_if(F.col("is_open") == 1).alias("open_rows"),
    )


def single_invoice_demo(closed: DataFrame, history: DataFrame) -> DataFrame:
    """Customers with one closed invoice: their leaky mean equals the label on every row."""
    single = history.filter("cust_invoice_count = 1").select("customer_id", "cust_avg_days_late")
    return closed.join(single, "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.every(F.col("days_late") == F.col("cust_avg_days_late")), F.lit(True)).alias("feature_is_label"),
    )


def entity_drill(timeline: DataFrame, closed: DataFrame, low: int = 6, high: int = 12) -> DataFrame:
    """Timeline of one example customer: the smallest id with ``low``..``high`` cleared rows."""
    eligible = (
        closed.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(low, high))
    )
    chosen = scalar_row(eligible.agg(F.min("customer_id").alias("c")))["c"]
    return timeline.filter(F.col("customer_id") == chosen)


def coverage_summary(ledger: DataFrame) -> DataFrame:
    """What a ledger contains: open and closed rows, posting range, whether there is a book to score."""
    return ledger.agg(
        F.count(F.lit(1)).alias("invoices"),
        F.count_if(F.col("is_open") == 1).alias("open_invoices"),
        F.count_if(F.col("is_open") == 0).alias("closed_invoices"),
        F.min("posting_date").alias("first_posting"),
        F.max("posting_date").alias("last_posting"),
    ).withColumn("has_open", F.col("open_invoices") > 0)
