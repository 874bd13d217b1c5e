"""The hourly pulse as a stream: views, users and completed views of each hour, once it is over.

Two stateful steps, both bounded by the watermark. Copies of an event are dropped first. Then
an hour is counted per user, and when the watermark has passed its end these rows, one per user,
are added up, so unique users are exact and a busy hour is spread over its users. An hour is
written once, in append mode, and never changed. Events further behind the watermark than
``lateness`` are dropped and counted (``late_rows`` of ``bronze.progress_rows``); an event
without a readable time is in no hour.
"""

from pyspark.sql import functions as F

from playlens.streaming.bronze import followed, save_progress

LATENESS, HOUR = "2 hours", "1 hour"


def hourly_pulse(events, lateness=LATENESS):
    """Rows (event_hour_start, total_views, completed_views, unique_users) of hours that are over.

    ``events`` are streamed rows as ``silver.clean`` leaves them."""
    timely = (events.select("event_id", "event_timestamp", "user_id", "is_completed")
              .withWatermark("event_timestamp", lateness)
              .dropDuplicatesWithinWatermark(["event_id"]))
    per_user = timely.groupBy(F.window("event_timestamp", HOUR), "user_id").agg(
        F.count("event_id").alias("total_views"), F.sum("is_completed").alias("completed_views"))
    hours = per_user.groupBy(F.window(F.window_time("window"), HOUR)).agg(
        F.sum("total_views").alias("total_views"),
        F.sum("completed_views").alias("completed_views"),
        F.count("user_id").alias("unique_users"))
    return hours.select(F.col("window.start").alias("event_hour_start"), "total_views",
                        "completed_views", "unique_users")


def start_pulse(events, path, checkpoint, lateness=LATENESS, fmt="parquet", trigger=None):
    """Append finished hours to the table at ``path``; a restart goes on after the last batch."""
    writer = (hourly_pulse(events, lateness).writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


def pulse_available(events, path, checkpoint, log=None, **kwargs):
    """Take in all that has arrived, then stop; returns the progress of the batches."""
    query = start_pulse(events, path, checkpoint, trigger={"availableNow": True}, **kwargs)
    progress = followed(query)
    if log is not None:
        save_progress(events.sparkSession, progress, log)
    return progress
