"""Streaming twins of batch operators. On a drained stream each gives the batch result."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import split, tag_invoices, tag_payments
from ..schemas import CREATED, INVOICE_COLS, PAID, PAYMENT_COLS, QUARANTINE_COLS


_STATE = "spark.sql.streaming.stateStore"
_ON_DISK = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Counting rows reads every key before it is written.
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams begun within keep their state in RocksDB: a state of all invoices is larger than what
    executors hold, and the default store holds two versions of it as objects. Their progress does not
    count the rows in the state."""
    before = {k: spark.conf.get(k, None) for k in _ON_DISK}
    for k, v in _ON_DISK.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def event_time(events: DataFrame, column: str = "event_timestamp") -> DataFrame:
    return events.withColumn("event_time", F.try_to_timestamp(column, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def dedupe_stream(events: DataFrame, delay: str = "10 days") -> DataFrame:
    """One row per event id; state for an id is dropped once the watermark passes it. Events without
    an id are told apart by what they say, as in ``dedupe_events``."""
    said = [F.col(f"`{c}`") for c in events.columns if not c.startswith("_")] or [F.lit(0)]
    return (
        event_time(events)
        .withColumn("_nameless", F.when(F.col("_event_id").isNull(), F.xxhash64(*said)))
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["_event_id", "_nameless"])
        .drop("event_time", "_nameless")
    )


def _in_time(longest: str) -> Column:
    """Whether payment ``p`` lies within the time bound of invoice ``i``."""
    since, at = F.col("i.event_time"), F.col("p.event_time")
    return (at >= since) & (at <= since + F.expr(longest))


def _labels(joined: DataFrame) -> DataFrame:
    return joined.select(
        "i.invoice_id",
        "i.customer_id",
        F.col("i.due_date").alias("due_date"),
        F.col("p.clear_date").alias("clear_date"),
        F.datediff(F.col("p.clear_date").cast("date"), F.col("i.due_date").cast("date")).alias("days_late"),
    )


def label_stream(
    created: DataFrame, paid: DataFrame, delay: str = "1 day", longest: str = "interval 400 days"
) -> DataFrame:
    """Stream-stream left join of invoices with payments that arrive up to ``longest`` later.

    Unpaid invoices come out, without a label, once no payment can arrive for them any more.
    Invoices whose payment lies outside that bound come out so, too: ``late_labels`` has their labels.
    """
    left = (
        event_time(created.filter(F.col("event_type") == CREATED))
        .withWatermark("event_time", delay)
        .select("invoice_id", "customer_id", "due_date", "event_time")
        .alias("i")
    )
    right = (
        event_time(paid.filter(F.col("event_type") == PAID))
        .withWatermark("event_time", delay)
        .select("invoice_id", "clear_date", "event_time")
        .alias("p")
    )
    same = F.col("i.invoice_id") == F.col("p.invoice_id")
    return _labels(left.join(right, same & _in_time(longest), "left_outer"))


CLOSING = "closing"


def closing_events(spark: SparkSession, at: str) -> DataFrame:
    """An invoice and a payment of id ``CLOSING`` dated ``at``, a time beyond all others: dropped into
    the landing folder of a stream that ends, they let unpaid invoices come out."""
    kinds = spark.range(2).select(F.when(F.col("id") == 0, CREATED).otherwise(PAID).alias("event_type"))
    return kinds.select(
        F.concat(F.lit(f"{CLOSING}-{at}-"), "event_type").alias("_event_id"),
        "event_type",
        F.lit(CLOSING).alias("invoice_id"),
        F.lit(at).alias("event_timestamp"),
    )


def past(query: StreamingQuery, at: str) -> bool:
    """Did the last batch of a drained query run with a watermark beyond ``at`` (and drop what is older)?"""
    last = query.lastProgress
    return bool(last) and (last["eventTime"].get("watermark") or "") > at


def late_labels(created: DataFrame, paid: DataFrame, longest: str = "interval 400 days") -> DataFrame:
    """Labels that ``label_stream`` leaves out: of payments dated before their invoice, more than
    ``longest`` after it, or with a time missing on either side. Any payment may still come, so both
    sides stay in the state and no row is dropped by a watermark."""
    left, right = event_time(created.filter(F.col("event_type") == CREATED)), event_time(paid.filter(F.col("event_type") == PAID))
    same = F.col("i.invoice_id") == F.col("p.invoice_id")
    return _labels(left.alias("i").join(right.alias("p"), same & ~F.coalesce(_in_time(longest), F.lit(False))))


def validate_stream(
    events: DataFrame, clean_path: str, payments_path: str, rejected_path: str, checkpoint: str
) -> StreamingQuery:
    """Validate each micro-batch; clean invoices, clean payments and rejected rows go to a table each.

    The batch number is part of the folder name, so a batch that is repeated after a failure
    replaces its own output instead of adding to it.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # read by four branches
        invoices, bad_invoices = split(tag_invoices(batch))
        payments, bad_payments = split(tag_payments(batch))
        rejected = bad_invoices.select(*QUARANTINE_COLS).unionByName(bad_payments.select(*QUARANTINE_COLS))
        invoices.select(*INVOICE_COLS).write.mode("overwrite").parquet(f"{clean_path}/batch={number}")
        payments.select(*PAYMENT_COLS).write.mode("overwrite").parquet(f"{payments_path}/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        batch.unpersist()

    query = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def window_counts(events: DataFrame, time: str, label: str, window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Rows and missing values per tumbling window and label."""
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, window).alias("w"), label)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("n_missing"))
        .select(F.col("w.start").alias("window_start"), label, "n", "n_missing")
    )


def drain_updates(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain a windowed aggregate. Update mode reports a window whenever it changes; each batch
    overwrites its own folder, and the latest batch per window is the final one."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        result.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
