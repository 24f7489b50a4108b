"""Ingestion of JSON event files into the bronze table, exactly once per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import EVENT_SCHEMA


def read_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming scan of a landing folder with the stated schema and ingestion columns."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_ingest_date": F.current_date(),
        }
    )


def drain(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table, then stop.

    The checkpoint tracks files, so a second run without new files appends nothing.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = writer.start()
    query.awaitTermination()
    return query


def progress(query: StreamingQuery) -> dict:
    """Batch id and row count of the last non-empty batch (0 rows when nothing arrived)."""
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    last = batches[-1] if batches else query.lastProgress
    return {
        "batch_id": last["batchId"] if last else None,
        "rows": sum(p["numInputRows"] for p in batches),
    }


_PROGRESS = "run_id string, batch_id long, rows long, dropped_late long, state_rows long, watermark string"


def progress_table(query: StreamingQuery) -> DataFrame:
    """A row for each micro-batch of a drained query: rows read, rows that a watermark dropped as too
    late, rows held in the state. Append it to a log to keep the history of a stream; Spark itself
    remembers the last ``spark.sql.streaming.numRecentProgressUpdates`` batches."""
    batches = []
    for p in query.recentProgress:
        states = p["stateOperators"]
        late, held = (sum(int(s[k]) for s in states) for k in ("numRowsDroppedByWatermark", "numRowsTotal"))
        batches.append((str(p["runId"]), int(p["batchId"]), int(p["numInputRows"]), late, held, p["eventTime"].get("watermark")))
    return SparkSession.active().createDataFrame(batches, _PROGRESS)
