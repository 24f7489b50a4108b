"""Deterministic keys: event ids and sampling order."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_id(kind: str, invoice_id: Column | str) -> Column:
    """Same id for every replay of an event, so duplicates stay detectable."""
    ident = F.col(invoice_id) if isinstance(invoice_id, str) else invoice_id
    return F.substring(F.sha1(F.concat(F.lit(f"{kind}:"), ident)), 1, 24)


def sample_order(key: Column | str, seed: int) -> Column:
    """A shuffled order that depends on the key and seed only, not on partitioning."""
    ident = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(ident.cast("string"), F.lit(f":{seed}")))
