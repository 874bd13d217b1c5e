"""Message coding shared by batch and stream: stamp, encode, decode, publish."""

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.schemas import WATCH_EVENT
from playlens.session import observed

CORRUPT = "_corrupt_record"
# Source labels of the two ways into the raw layer.
BULK = "bulk_history"
STREAM = "message_stream"


def stamp(df, source, at=None):
    """Add load time (now, unless ``at`` is given) and source label."""
    return df.withColumns({
        "ingested_at": F.current_timestamp() if at is None else at,
        "source": F.lit(source),
    })


def encode(df, key="event_id"):
    """One message per row: ``key`` and the row as JSON in ``value``."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct("*")).alias("value"))


def decode(messages, schema=WATCH_EVENT, body="body"):
    """Message bodies (binary or text) as columns of ``schema``.

    A message with a field of another type keeps its other fields, and any message that was
    not read whole keeps its text in ``_corrupt_record``. Rows come out of a generator, below
    which no filter is pushed, so each message is parsed once.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(body).cast("string"), with_corrupt,
                         {"columnNameOfCorruptRecord": CORRUPT})
    return messages.select(F.inline(F.array(parsed)))


def _nothing_read(rows):
    """Whether no field of a message was read; load columns are not fields of messages."""
    fields = [c for c in rows.columns if c not in (CORRUPT, "ingested_at", "source")]
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in fields], F.lit(True))


def readable(rows):
    """Rows of which at least one field was read, without the column for the others."""
    if CORRUPT not in rows.columns:
        return rows
    return rows.filter(F.col(CORRUPT).isNull() | ~_nothing_read(rows)).drop(CORRUPT)


def unreadable(rows):
    """Text of the messages of which nothing was read."""
    return rows.filter(F.col(CORRUPT).isNotNull() & _nothing_read(rows)).select(CORRUPT)


def rejected(rows):
    """Rows ``(reason, messages)``: of which nothing, or not all, was read; and empty ones."""
    whole = rows if CORRUPT in rows.columns else rows.withColumn(
        CORRUPT, F.lit(None).cast("string"))
    nothing, bad = _nothing_read(whole), F.col(CORRUPT).isNotNull()
    counts = whole.agg(
        F.count_if(bad & nothing).alias("unreadable"),
        F.count_if(bad & ~nothing).alias("partly_readable"),
        F.count_if(~bad & nothing).alias("empty"))
    return counts.unpivot([], ["unreadable", "partly_readable", "empty"], "reason", "messages")


def ingest(messages, schema=WATCH_EVENT, body="body", source=STREAM):
    """Raw-layer rows of a batch or a stream of messages.

    The raw layer keeps unreadable messages with their text; silver leaves out those of which
    nothing was read.
    """
    return stamp(decode(messages, schema, body), source)


def combine(bulk, stream=None):
    """Bulk and stream rows of the raw layer in one table; bulk alone before any stream."""
    if stream is None:
        return bulk
    return bulk.unionByName(stream, allowMissingColumns=True)


def publish(messages, fmt="kafka", max_bytes=None, rejects=None, path=None, **options):
    """Write encoded messages to a sink and count them.

    All messages are sent. Where the sink has a limit, ``max_bytes`` says it, and messages
    without a body or above it are counted as failed and appended to the Parquet table
    ``rejects``. ``fmt`` is the broker's format where its connector is on the classpath, or
    a file format with ``path``.
    """
    if (max_bytes is None) != (rejects is None):
        raise ValueError("max_bytes and rejects go together")
    fits = F.lit(True) if max_bytes is None else F.coalesce(
        F.octet_length("value") <= max_bytes, F.lit(False))
    seen = Observation()
    counted = messages.observe(seen, F.count_if(fits).alias("success_count"),
                               F.count_if(~fits).alias("failed_count"))
    sent = counted.filter(fits)
    if fmt == "text":
        sent = sent.select("value")
    sent.write.format(fmt).mode("append").options(**options).save(path)
    if rejects is not None:
        messages.filter(~fits).write.mode("append").parquet(rejects)
    done = observed(seen)
    return {"status": "complete", **{c: done[c] for c in ("success_count", "failed_count")}}
