"""Watch events made from the sample tables.

``events`` supplies one watch event per row; ``part`` describes the content and
``customer``/``nation``/``region`` the place. The joins are left joins on keys, so
each event stays exactly one row; small tables are sent to all executors when the
optimizer finds them small, and larger ones are shuffled under the adaptive
skew join.
"""

from pyspark.sql import functions as F

from playlens.functions import features
from playlens.schemas import PERCENT, WATCH_EVENT

# Fixed values, picked by id: age groups, device pairs, plans with prices.
AGE_GROUPS = ("18-24", "25-34", "35-44", "45-54", "55+")
BY_EVENT = {
    "device_type": ("SMARTTV", "MOBILE", "MOBILE", "LAPTOP", "TABLET"),
    "device_os": ("Android TV", "Android", "iOS", "Windows", "iOS"),
    "subscription_plan": ("BASIC", "STANDARD", "PREMIUM"),
    "subscription_price": (149, 299, 649),
}
# The number in props.
CONTENT_NO = "try_cast(get_json_object(props, '$.k') AS bigint)"


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def contents(spark, sf_dir):
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS content_no",
        "p_name AS content_title",
        "CASE WHEN p_size > 25 THEN 'Movie' ELSE 'Series' END AS content_type",
        "p_type AS genre",
        "p_brand AS language",
    )


def places(spark, sf_dir):
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    return (
        read(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .selectExpr(
            "c_custkey AS user_no",
            "n_name AS city",
            "concat('STATE_', string(n_nationkey % 10)) AS state",
            "r_name AS region",
        )
    )


def watch_events(spark, sf_dir, content=False, place=False):
    """Watch events with a typed ``event_timestamp`` and decimal ``completion_pct``.

    ``content`` and ``place`` add the columns that need a join. Some completions are above
    100, as a producer may send them.
    """
    pct = features.completion_pct("value", "100")
    source = read(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "value",
        F.expr("user_id AS user_no"),
        F.expr(f"{CONTENT_NO} AS content_no"),
        pct.alias("pct"),
    )
    if content:
        source = source.join(contents(spark, sf_dir), "content_no", "left")
    if place:
        source = source.join(places(spark, sf_dir), "user_no", "left")

    columns = {
        "event_id": F.expr("string(event_id)"),
        "event_timestamp": F.col("ts"),
        **features.calendar_features("ts"),
        "user_id": F.expr("string(user_no)"),
        "age_group": features.pick(
            AGE_GROUPS, f"pmod(event_id div 3, {len(AGE_GROUPS)})"),
        "content_id": F.expr("string(content_no)"),
        "action": F.col("event_type"),
        "watch_duration_mins": F.expr(f"cast(value AS {PERCENT.simpleString()})"),
        "total_duration_mins": F.expr("100"),
        "completion_pct": F.col("pct"),
        "is_completed": features.is_completed("pct"),
        "is_dropped": features.is_dropped("pct"),
        **{name: features.pick(values, f"pmod(event_id, {len(values)})")
           for name, values in BY_EVENT.items()},
    }
    for name in source.columns:
        if name in WATCH_EVENT.names:
            columns.setdefault(name, F.col(name))
    return source.select(*[columns[f].alias(f) for f in WATCH_EVENT.names if f in columns])


def seen_contents(spark, sf_dir):
    """Content columns of the contents that occur in the events, one row each.

    The attributes depend on the key alone, so the keys are made distinct before the
    join: it meets as many rows as there are contents, not events.
    """
    keys = read(spark, sf_dir, "events").select(F.expr(f"{CONTENT_NO} AS content_no"))
    return keys.distinct().join(contents(spark, sf_dir), "content_no", "left").selectExpr(
        "string(content_no) AS content_id", "content_title", "content_type", "genre", "language")


def seen_places(spark, sf_dir):
    """Place columns of the users that occur in the events, one row per user."""
    keys = read(spark, sf_dir, "events").select(F.expr("user_id AS user_no"))
    return keys.distinct().join(places(spark, sf_dir), "user_no", "left").select(
        "city", "state", "region")


def watch_records(spark, sf_dir):
    """All 27 fields as a producer sends them: the time as ISO text."""
    events = watch_events(spark, sf_dir, content=True, place=True)
    text = F.date_format(F.col("event_timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.withColumns({"event_timestamp": text,
                               "completion_pct": F.col("completion_pct").cast("double")})
