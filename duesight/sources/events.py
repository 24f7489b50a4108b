"""Ledger rows to invoice and payment events, with optional fault injection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import event_id
from ..schemas import CREATED, EVENT_SCHEMA, PAID

_COLS = EVENT_SCHEMA.fieldNames()


def ledger_events(ledger: DataFrame, source: str = "ledger") -> DataFrame:
    """One ``invoice_created`` event per row and one ``invoice_paid`` event per cleared row.

    Both come out of a single pass. Dates become ISO text; missing ids stay NULL.
    """

    def event(kind: str, name: str, stamp: Column, **fields: Column) -> Column:
        values = {
            "_event_id": event_id(kind, "invoice_id"),
            "_source": F.lit(source),
            "event_type": F.lit(name),
            "event_timestamp": F.concat(stamp.cast("string"), F.lit("T00:00:00")),
            "invoice_id": F.col("invoice_id"),
            "customer_id": F.col("customer_id"),
            **fields,
        }
        return F.struct(
            *[
                values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in EVENT_SCHEMA.fields
            ]
        )

    created = event(
        "created",
        CREATED,
        F.col("posting_date"),
        customer_name=F.col("customer_name"),
        invoice_amount=F.col("invoice_amount"),
        posting_date=F.col("posting_date"),
        due_date=F.col("due_date"),
        payment_terms=F.col("payment_terms"),
        business_code=F.col("business_code"),
    )
    paid = event("paid", PAID, F.col("clear_date"), clear_date=F.col("clear_date"))
    emitted = F.when(F.col("clear_date").isNotNull(), F.array(created, paid)).otherwise(F.array(created))
    return ledger.select(F.inline(emitted))


def inject_faults(events: DataFrame, number: Column, early_due: str = "1990-01-01") -> DataFrame:
    """Corrupt 4 % of creation events: bad date, no amount, due before posting, no id.

    ``number`` is an integer per event; which event breaks and how depends on it alone.
    """
    kind = F.when(F.col("event_type") == CREATED, F.pmod(number, F.lit(100)))
    # Defect per residue.
    return (
        events.withColumn("_defect", F.when(kind.between(1, 4), kind))
        .withColumns(
            {
                "posting_date": F.when(F.col("_defect") == 1, "31/02/2020").otherwise(F.col("posting_date")),
                "invoice_amount": F.when(F.coalesce(F.col("_defect"), F.lit(0)) != 2, F.col("invoice_amount")),
                "due_date": F.when(F.col("_defect") == 3, early_due).otherwise(F.col("due_date")),
                "invoice_id": F.when(F.coalesce(F.col("_defect"), F.lit(0)) != 4, F.col("invoice_id")),
                "_event_id": F.when(
                    F.col("_defect").isNotNull(), F.concat("_event_id", F.lit("-bad"))
                ).otherwise(F.col("_event_id")),
            }
        )
        .drop("_defect")
    )


def with_ingestion(events: DataFrame, ingested_at: str) -> DataFrame:
    return events.withColumn("_ingested_at", F.to_timestamp_ntz(F.lit(ingested_at)))


def with_replays(events: DataFrame, replayed: Column, ingested_at: str, again_at: str) -> DataFrame:
    """Stamp ingestion times; rows matching ``replayed`` arrive a second time later."""
    times = F.when(replayed, F.array(F.lit(ingested_at), F.lit(again_at))).otherwise(
        F.array(F.lit(ingested_at))
    )
    return events.withColumn("_ingested_at", F.explode(times)).withColumn(
        "_ingested_at", F.to_timestamp_ntz("_ingested_at")
    )
