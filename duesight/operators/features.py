"""Leakage-safe feature assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import invoice_calendar
from ..schemas import CATEGORY_COLS, HIST_COLS
from ..session import scalar_row
from .history import asof_history, exact_std
from .ordering import rank_rows


def invoice_features(df: DataFrame) -> DataFrame:
    """Features known the moment an invoice is raised."""
    return df.withColumns(
        {"amount_log": F.log1p(F.abs("invoice_amount")), **invoice_calendar("posting_date")}
    )


def fold_defaults(train: DataFrame) -> DataFrame:
    """Cold-start values from the training fold, as one lazy row.

    Days and amounts are summed as whole numbers and decimals: sums of doubles depend on the order in
    which tasks finish, and a value worked out again must be the very one that rows were given.
    """
    late = F.col("days_late")
    days, amount = late.cast("long"), F.col("invoice_amount").cast("decimal(28,6)")
    values = {
        "cust_avg_days_late": F.avg(late),
        "cust_std_days_late": exact_std(F.count(days), F.sum(days), F.sum(days * days)),
        "cust_invoice_count": F.lit(0.0),
        "cust_min_late": F.min(late),
        "cust_max_late": F.max(late),
        "cust_avg_amount": F.try_divide(F.sum(amount).cast("double"), F.count(amount)),
    }
    return train.agg(
        *[F.coalesce(values[c].cast("double"), F.lit(0.0)).alias(c) for c in HIST_COLS]
    )


def fit_encoders(train: DataFrame, columns: list[str] = CATEGORY_COLS) -> DataFrame:
    """Rows ``(column, value, code)``: sorted distinct values numbered from 0 per column."""
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
        )
    )
    distinct = train.select(pairs.alias("p")).select("p.*").filter("value is not null").distinct()
    ranked = rank_rows(distinct, [F.col("column"), F.col("value")], "_rank")
    # One row per encoded column.
    first = F.broadcast(ranked.groupBy("column").agg(F.min("_rank").alias("_first")))
    return ranked.join(first, "column").select(
        "column", "value", (F.col("_rank") - F.col("_first")).cast("int").alias("code")
    )


def encode(df: DataFrame, encoders: DataFrame, columns: list[str] = CATEGORY_COLS) -> DataFrame:
    """Add ``<column>_encoded``; values not seen in training become -1.

    No broadcast hint: the lookup is small in practice, but only its real size decides.
    """
    for c in columns:
        codes = encoders.filter(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias(f"{c}_encoded")
        )
        df = df.join(codes, c, "left").withColumn(
            f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(-1))
        )
    return df


def cutoff(labelled: DataFrame, test_fraction: float = 0.2) -> DataFrame:
    """One row with the first posting date of the test fold (an observed date).

    The exact percentile works on whole days, of which there are few thousand.
    """
    share = round(1.0 - test_fraction, 9)
    day = F.expr(f"percentile_disc({share}D) WITHIN GROUP (ORDER BY unix_date(posting_date))")
    return labelled.agg(F.date_from_unix_date(day.cast("int")).alias("cutoff_date"))


def with_fold(labelled: DataFrame, cutoff_date: Column) -> DataFrame:
    """Tag each row: strictly before the cutoff is training, the rest is test."""
    return labelled.withColumn(
        "fold", F.when(F.col("posting_date") < cutoff_date, "train").otherwise("test")
    )


def chronological_split(labelled: DataFrame, test_fraction: float = 0.2) -> tuple[DataFrame, DataFrame]:
    day = scalar_row(cutoff(labelled, test_fraction))["cutoff_date"]
    return (
        labelled.filter(F.col("posting_date") < day),
        labelled.filter(F.col("posting_date") >= day),
    )


def random_split(df: DataFrame, key: str = "invoice_id", test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Hash-bucket folds, for the leakage contrast only: they ignore time."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return df.withColumn("fold", F.when(bucket < test_percent, "test").otherwise("train"))


def fold_summary(folded: DataFrame) -> DataFrame:
    return folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("posting_date").alias("first_posting"),
        F.max("posting_date").alias("last_posting"),
    )


def feature_matrix(
    invoices: DataFrame, timeline: DataFrame, defaults: DataFrame | dict, encoders: DataFrame
) -> DataFrame:
    """All model features of every invoice, history as of its posting date."""
    return encode(invoice_features(asof_history(invoices, timeline, defaults)), encoders)


def input_contract(
    df: DataFrame, required: list[str], aliases: dict[str, str] | None = None
) -> DataFrame:
    """Rename aliases, fail loudly on missing columns, return the agreed order."""
    out = df.withColumnsRenamed(aliases or {})
    missing = [c for c in required if c not in out.columns]
    if missing:
        raise ValueError(f"missing input columns: {missing}")
    return out.select(*required)
