"""Fixed schemas; nothing in the package infers a schema from data."""

from pyspark.sql import types as T

PERCENT = T.DecimalType(12, 2)
SCORE = T.DecimalType(14, 4)

# Field names and order of a watch event.
WATCH_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_hour", T.IntegerType()),
    T.StructField("event_day", T.StringType()),
    T.StructField("event_month", T.IntegerType()),
    T.StructField("is_prime_time", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("age_group", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("content_title", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("action", T.StringType()),
    # Minutes are whole numbers at the producer; decimal also takes fractions.
    T.StructField("watch_duration_mins", PERCENT),
    T.StructField("total_duration_mins", T.IntegerType()),
    T.StructField("completion_pct", T.DoubleType()),
    T.StructField("is_completed", T.IntegerType()),
    T.StructField("is_dropped", T.IntegerType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("device_os", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("subscription_plan", T.StringType()),
    T.StructField("subscription_price", T.IntegerType()),
])

# The narrow stream schema. Three of its names (event_type,
# watch_duration, timestamp) are not sent by the producer and always parse to NULL.
NARROW_STREAM_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("watch_duration", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

# Dimension and fact columns.
DIM_CONTENT = ("content_id", "content_title", "content_type", "genre", "language")
DIM_USERS = ("user_id", "age_group", "subscription_plan", "subscription_price")
DIM_DEVICES = ("device_type", "device_os", "device_category")
DIM_LOCATIONS = ("city", "state", "region")
FACT = (
    "event_id", "event_timestamp", "event_date", "user_id", "content_id",
    "device_type", "city", "watch_duration_mins", "completion_pct",
    "subscription_plan", "subscription_price", "engagement_score",
    "revenue_per_view", "is_completed", "is_dropped", "is_prime_time",
    "is_weekend", "event_day", "time_of_day", "completion_category",
)
