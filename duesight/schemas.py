"""Column contracts shared by every stage.

Event schemas are explicit, never inferred: inference would depend on which files arrive
first. Dates travel as strings in events and are parsed (safely) in the silver stage.
"""

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The event contract, history columns and model feature order.
EVENT_SCHEMA = StructType(
    [
        StructField("_event_id", StringType(), False),
        StructField("_source", StringType(), True),
        StructField("event_type", StringType(), False),
        StructField("event_timestamp", StringType(), True),
        StructField("invoice_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("customer_name", StringType(), True),
        StructField("invoice_amount", DoubleType(), True),
        StructField("posting_date", StringType(), True),
        StructField("due_date", StringType(), True),
        StructField("payment_terms", StringType(), True),
        StructField("business_code", StringType(), True),
        StructField("clear_date", StringType(), True),
    ]
)

CREATED = "invoice_created"
PAID = "invoice_paid"

INVOICE_COLS = [
    "invoice_id",
    "customer_id",
    "customer_name",
    "invoice_amount",
    "posting_date",
    "due_date",
    "payment_terms",
    "business_code",
    "_event_id",
    "_ingested_at",
]
PAYMENT_COLS = ["invoice_id", "clear_date", "_event_id", "_ingested_at"]
QUARANTINE_COLS = ["_event_id", "event_type", "invoice_id", "_reject_reason", "_ingested_at"]

HIST_COLS = [
    "cust_avg_days_late",
    "cust_std_days_late",
    "cust_invoice_count",
    "cust_min_late",
    "cust_max_late",
    "cust_avg_amount",
]
CALENDAR_COLS = ["amount_log", "month", "day_of_week", "is_month_end", "is_year_end"]
CATEGORY_COLS = ["payment_terms", "business_code"]
ENCODED_COLS = [f"{c}_encoded" for c in CATEGORY_COLS]
FEATURE_COLS = CALENDAR_COLS + ENCODED_COLS + HIST_COLS
# What a caller hands to a fitted model: raw categories, the model encodes them itself.
RAW_INPUT_COLS = CALENDAR_COLS + HIST_COLS + CATEGORY_COLS

FEATURE_CATEGORY = {
    "amount_log": "amount",
    "month": "temporal",
    "day_of_week": "temporal",
    "is_month_end": "temporal",
    "is_year_end": "temporal",
    "payment_terms_encoded": "categorical",
    "business_code_encoded": "categorical",
    "cust_avg_days_late": "customer_history",
    "cust_std_days_late": "customer_history",
    "cust_invoice_count": "customer_history",
    "cust_min_late": "customer_history",
    "cust_max_late": "customer_history",
    "cust_avg_amount": "customer_history",
}

DRIFT_NUMERIC = [
    "invoice_amount",
    "amount_log",
    "cust_avg_days_late",
    "cust_std_days_late",
    "cust_invoice_count",
]
DRIFT_CATEGORICAL = ["payment_terms", "business_code"]

TIERS = ["CALL", "REMIND", "WATCH", "OK"]
