"""Ledger CSV source: explicit text schema, then safe typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import safe_date

# Header of the ledger export and the date formats seen in it.
LEDGER_COLUMNS = [
    "invoice_id",
    "cust_number",
    "name_customer",
    "total_open_amount",
    "posting_date",
    "due_in_date",
    "clear_date",
    "cust_payment_terms",
    "business_code",
    "isOpen",
]
MIXED_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "dd-MM-yyyy"]
DUE_FORMAT = "yyyyMMdd"

RENAMED = {
    "cust_number": "customer_id",
    "name_customer": "customer_name",
    "total_open_amount": "invoice_amount",
    "due_in_date": "due_date",
    "cust_payment_terms": "payment_terms",
    "isOpen": "is_open",
}


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Read the export by header name; columns beyond the contract are ignored.

    Everything is read as text, so one bad cell never fails a file: due dates like
    ``20200131.0`` and mixed posting formats become dates, bad clear dates become NULL.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    missing = [c for c in LEDGER_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"ledger header lacks {missing}")
    return type_ledger(raw.select(*LEDGER_COLUMNS))


def type_ledger(raw: DataFrame) -> DataFrame:
    due = F.regexp_replace(F.col("due_in_date").cast("string"), r"\.0$", "")
    return raw.withColumns(
        {
            "posting_date": safe_date("posting_date", *MIXED_FORMATS),
            "due_in_date": safe_date(due, DUE_FORMAT),
            "clear_date": safe_date("clear_date", *MIXED_FORMATS),
            "total_open_amount": F.col("total_open_amount").try_cast("double"),
            "isOpen": F.col("isOpen").try_cast("int"),
        }
    ).withColumnsRenamed(RENAMED)


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Export in the same layout (the inverse of ``read_ledger``)."""
    back = {new: old for old, new in RENAMED.items()}
    out = ledger.withColumns({"due_date": F.date_format("due_date", DUE_FORMAT)}).withColumnsRenamed(back)
    out.select(*LEDGER_COLUMNS).write.option("header", True).csv(path)
