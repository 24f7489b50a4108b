"""Date expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd"


def safe_date(col: Column | str, *formats: str) -> Column:
    """Parse to date, NULL on malformed or impossible input, never an error under ANSI mode.

    A format is always given: without one Spark would accept ``2020`` or even ``12:00``.
    Several formats are tried in order.
    """
    text = F.col(col) if isinstance(col, str) else col
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in (formats or (ISO,))]
    return F.coalesce(*tried)


def invoice_calendar(day: Column | str) -> dict[str, Column]:
    """Calendar features known when an invoice is raised (Monday = 0)."""
    return {
        "month": F.month(day).cast("int"),
        "day_of_week": F.weekday(day).cast("int"),
        "is_month_end": (F.dayofmonth(day) > 25).cast("int"),
        "is_year_end": (F.month(day) == 12).cast("int"),
    }


def plus_days(day: Column | str, days: Column) -> Column:
    """``day + ceil(days)``: a promise is rounded up to a whole day, never down."""
    return F.date_add(day, F.ceil(days).cast("int"))
