"""Latest row per key and duplicate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], *newest: Column) -> DataFrame:
    """One row per key: the first by ``newest``; a hash of the whole row settles ties.

    ``row_number() = 1`` lets Spark cut every key to one row per task before the shuffle, so
    a key with very many copies stays cheap.
    """
    settle = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    order = Window.partitionBy(*keys).orderBy(*newest, *settle)
    return df.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def dedupe_events(bronze: DataFrame) -> DataFrame:
    """Latest ingestion of every event id. Replays share an id, so they collapse here. Events
    without an id are told apart by what they say, so that validation can count each of them."""
    newest = [F.col("_ingested_at").desc_nulls_last()]
    if "event_timestamp" in bronze.columns:
        newest.append(F.col("event_timestamp").desc_nulls_last())
    said = [F.col(f"`{c}`") for c in bronze.columns if not c.startswith("_")] or [F.lit(0)]
    nameless = F.when(F.col("_event_id").isNull(), F.xxhash64(*said))
    keyed = bronze.withColumn("_nameless", nameless)
    return latest_per_key(keyed, ["_event_id", "_nameless"], *newest).drop("_nameless")


def dedupe_business_key(rows: DataFrame, key: str = "invoice_id") -> DataFrame:
    """One row per invoice; latest ingestion, then smallest event id."""
    return latest_per_key(rows, [key], F.col("_ingested_at").desc_nulls_last(), F.col("_event_id").asc())


def latest_prediction(log: DataFrame, *keys: str) -> DataFrame:
    """Newest scoring per key; the model version settles equal stamps."""
    return latest_per_key(log, list(keys), F.col("scored_at").desc(), F.col("model_version").desc())


def duplicate_report(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count (combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
