"""Silver layer: one row per event, cleaned, with derived columns."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.functions import features
from playlens.functions.measures import aggregate
from playlens.schemas import PERCENT
from playlens.sources.messages import readable


# What decides between copies of an event, where a table has it.
_ORDER = ("ingested_at", "source", "event_timestamp")


def deduplicate(df, keys=("event_id",), order=None):
    """Keep one row per key: the first by ``order``, then by all other columns in turn.

    So the row that stays does not depend on how rows are dealt to tasks; rows that are equal
    in every column are the same row.

    The ranking plans a per-task limit below the shuffle, so many copies of one key
    leave each map task as a single row. NULL keys count as equal. On wide rows this
    takes about half the time of ``dropDuplicates``, which aggregates every column.
    """
    order = [c for c in _ORDER if c in df.columns] if order is None else list(order)
    if unknown := [c for c in order if c not in df.columns]:
        raise ValueError(f"no such columns to order by: {unknown}")
    rest = [c for c in df.columns if c not in {*order, *keys}]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(
        *order, *rest, *(() if order or rest else keys)))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def _is_text(df, name):
    return isinstance(df.schema[name].dataType, T.StringType)


def clean(df):
    """Clean and derive columns; each rule applies where its input column exists."""
    tidy = {
        "genre": features.tidy_upper("genre"),
        "device_type": features.tidy_upper("device_type"),
        "region": features.tidy_upper("region"),
        "content_title": F.expr("trim(content_title)"),
    }
    if "completion_pct" in df.columns and df.schema["completion_pct"].dataType != PERCENT:
        # The decimal cannot hold every number that is sent; checks and categories use this.
        tidy["completion_raw"] = F.col("completion_pct").try_cast("double")
        tidy["completion_pct"] = F.col("completion_pct").try_cast(PERCENT)
    if "event_timestamp" in df.columns and _is_text(df, "event_timestamp"):
        tidy["event_timestamp"] = features.parse_time("event_timestamp")
    tidied = df.withColumns({c: e for c, e in tidy.items()
                             if c in df.columns or c == "completion_raw"})

    derived = {
        "completion_category": (("completion_pct",), lambda pct: features.completion_category(
            "completion_raw" if "completion_raw" in tidy else pct)),
        "device_category": (("device_type",), features.device_category),
        "event_date": (("event_timestamp",), lambda ts: F.expr(f"to_date({ts})")),
        "time_of_day": (("event_timestamp",), features.time_of_day),
        "engagement_score": (("completion_pct",), features.engagement_score),
        "revenue_per_view": (("subscription_price", "completion_pct"),
                             features.revenue_per_view),
    }
    present = set(df.columns)
    return tidied.withColumns({
        name: rule(*inputs) for name, (inputs, rule) in derived.items()
        if present.issuperset(inputs)
    })


def build_silver(bronze, order=None):
    """Readable events, deduplicated and cleaned, with their load time."""
    return clean(deduplicate(readable(bronze), order=order)).withColumn(
        "silver_timestamp", F.current_timestamp())


def summary(silver):
    """Rows and average completion per completion category."""
    return aggregate(
        silver, ["completion_category"], ["row_count", "avg_completion"],
        {"row_count": "total", "avg_completion": "avg_pct"},
    ).orderBy(F.desc("total"), "completion_category")
