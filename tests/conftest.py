import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from duesight.session import local_session  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__sql__ansi__enabled="true",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    return ROOT


def day(text):
    return dt.date.fromisoformat(text) if text else None


OUTCOME_SCHEMA = (
    "customer_id string, invoice_id string, posting_date date, due_date date, clear_date date, "
    "invoice_amount double, days_late int, is_open int"
)


def outcome_rows(spark, rows):
    """Rows ``(customer, invoice, posting, due, clear, amount)`` with the derived label."""
    full = []
    for customer, invoice, posting, due, clear, amount in rows:
        late = (day(clear) - day(due)).days if clear else None
        full.append((customer, invoice, day(posting), day(due), day(clear), float(amount), late, 0 if clear else 1))
    return spark.createDataFrame(full, OUTCOME_SCHEMA)


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
