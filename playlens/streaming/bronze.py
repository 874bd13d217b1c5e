"""Message stream into the raw layer, and the history of a stream's batches."""

from datetime import datetime

from pyspark.sql import functions as F

from playlens.schemas import WATCH_EVENT
from playlens.sources.messages import STREAM, ingest


def message_source(spark, fmt="kafka", path=None, **options):
    """A stream with the message bytes in ``body``.

    Broker formats deliver them as ``value`` (or already as ``body``); ``text`` reads
    one message per line from files that arrive in a folder.
    """
    reader = spark.readStream.format(fmt).options(**options)
    messages = reader.load(path) if path else reader.load()
    if "body" in messages.columns:
        return messages
    return messages.select(F.col("value").cast("binary").alias("body"))


def start_ingest(messages, path, checkpoint, fmt="parquet", schema=WATCH_EVENT,
                 source=STREAM, trigger=None):
    """Append parsed, stamped messages to the raw table at ``path``.

    The checkpoint holds the offsets: a restarted query continues after the last
    committed batch and adds no row twice. Copies sent twice by a producer are
    removed later, by the silver layer, so the stream keeps no state.
    """
    writer = (ingest(messages, schema, source=source).writeStream
              .format(fmt)
              .outputMode("append")
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


def ingest_available(messages, path, checkpoint, log=None, **kwargs):
    """Ingest all that has arrived, then stop; returns the finished query.

    ``log`` is a table to which the progress of every batch is appended."""
    query = start_ingest(messages, path, checkpoint, trigger={"availableNow": True}, **kwargs)
    progress = followed(query)
    if log is not None:
        save_progress(messages.sparkSession, progress, log)
    return query


def status(query):
    """State and the rows of the last batch."""
    last = query.lastProgress
    return {
        "active": query.isActive,
        "message": query.status["message"],
        "last_batch": last["batchId"] if last else None,
        "last_rows": last["numInputRows"] if last else 0,
    }


def followed(query, every=0.5):
    """Wait for the end of ``query``; returns the progress of all its batches, oldest first.

    Spark keeps the last hundred, so they are fetched while the query runs. An error that ends
    the query is raised."""
    seen = {}

    def gather():
        seen.update(((p["runId"], p["batchId"]), p) for p in query.recentProgress)

    while not query.awaitTermination(every):
        gather()
    gather()
    return list(seen.values())


#: A row per batch.
PROGRESS = ("query_id string, run_id string, batch_id long, started_at timestamp, "
            "duration_ms long, input_rows long, late_rows long, state_rows long, "
            "watermark timestamp")


def progress_rows(spark, progress):
    """Progress records (``followed``, or ``recentProgress`` of a running query) as a table.

    ``late_rows`` came behind the watermark and were dropped; ``state_rows`` are held."""
    def time(text):
        return datetime.fromisoformat(text) if text else None

    rows = []
    for p in progress:
        state = p["stateOperators"]
        rows.append((
            str(p["id"]), str(p["runId"]), p["batchId"], time(p["timestamp"]), p["batchDuration"],
            p["numInputRows"], sum(s["numRowsDroppedByWatermark"] for s in state),
            sum(s["numRowsTotal"] for s in state), time(p["eventTime"].get("watermark"))))
    return spark.createDataFrame(rows, PROGRESS)


def save_progress(spark, progress, path):
    """Append progress records to the table at ``path``: the history over restarts."""
    progress_rows(spark, progress).coalesce(1).write.mode("append").parquet(path)


def stream_history(spark, path):
    """Per run of each query in a progress table: its batches, rows and state at the end."""
    rows = spark.read.schema(PROGRESS).parquet(path)
    return rows.groupBy("query_id", "run_id").agg(
        F.min("started_at").alias("started_at"), F.count("*").alias("batches"),
        F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"),
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.max_by("state_rows", "batch_id").alias("state_rows"),
        F.max("watermark").alias("watermark"))
