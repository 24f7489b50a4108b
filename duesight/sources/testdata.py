"""Adapter from the shared test tables to a receivables ledger.

The tables hold orders, not invoices, so due dates, payments and defects are derived by integer
arithmetic that any SQL engine reproduces. They are fixtures, never observed outcomes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .events import inject_faults, ledger_events, with_replays

INGESTED_AT = "2024-01-01 00:00:00"
REPLAYED_AT = "2024-01-02 00:00:00"


# Column types of the tables used. Stated, so that no scan starts with a job that
# reads file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """One row per order as an invoice with its outcome; needs the orders table only."""
    o = table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    posting = F.col("o_orderdate").cast("date")
    # Days allowed per order priority 1..5.
    allowed = F.element_at(
        F.array(*[F.lit(d) for d in (15, 20, 30, 45, 60)]), F.substring("o_orderpriority", 1, 1).cast("int")
    )
    lag = F.pmod(7 * key + 13 * cust, F.lit(41)) - 10 + F.when(F.pmod(key, F.lit(53)) == 0, 60).otherwise(0)
    is_open = (F.col("o_orderstatus") == "O").cast("int")
    return (
        o.select(
            key.cast("string").alias("invoice_id"),
            cust.cast("string").alias("customer_id"),
            F.when(F.pmod(key, F.lit(97)) == 0, -F.col("o_totalprice"))
            .otherwise(F.col("o_totalprice"))
            .alias("invoice_amount"),
            posting.alias("posting_date"),
            F.date_add(posting, allowed).alias("due_date"),
            F.col("o_orderpriority").alias("payment_terms"),
            is_open.alias("is_open"),
            F.when(is_open == 0, lag.cast("int")).alias("days_late"),
        )
        .withColumn("clear_date", F.date_add("due_date", F.col("days_late")))
    )


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The same with customer name and business code."""
    c = table(spark, root, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("business_code"),
    )
    return outcomes(spark, root).join(c, "customer_id", "left")


def payments(spark: SparkSession, root: str) -> DataFrame:
    return outcomes(spark, root).filter("is_open = 0").select("invoice_id", "clear_date")


def bronze(spark: SparkSession, root: str) -> DataFrame:
    """Events with defects and replays, as an at-least-once feed would deliver them."""
    events = ledger_events(ledger(spark, root))
    number = F.col("invoice_id").cast("long")
    # The id may be blanked by a defect, so the replay flag is taken before.
    flagged = events.withColumn("_again", F.pmod(number, F.lit(50)) == 0)
    return with_replays(inject_faults(flagged, number), F.col("_again"), INGESTED_AT, REPLAYED_AT).drop("_again")
