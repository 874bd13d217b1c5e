"""Gold aggregates.

Only the names of these six tables are published; the definitions are ours.
"""

from pyspark.sql import functions as F

from playlens.functions.measures import aggregate, aggregate_star
from playlens.plans.reports import AGGREGATION_MEASURES, CONTENT_KEYS, CONTENT_MEASURES


def content_performance(fact, dim_content):
    """Content measures per content id."""
    return aggregate_star(fact, dim_content, "content_id", ["content_id", *CONTENT_KEYS],
                          CONTENT_MEASURES)


def user_engagement(silver):
    """Views, unique users and mean scores by age group and plan."""
    return aggregate(silver, ["age_group", "subscription_plan"],
                     ["total_views", "avg_completion", "avg_engagement"], users=True)


def device_analytics(silver):
    """Aggregation measures by device category and type."""
    return aggregate(silver, ["device_category", "device_type"], AGGREGATION_MEASURES)


def revenue_summary(silver):
    """Views and revenue by plan and region."""
    return aggregate(silver, ["subscription_plan", "region"], ["total_views", "total_revenue"])


def hourly_pulse(fact):
    """Views, unique users and completed views per hour."""
    hourly = fact.withColumn("event_hour_start", F.date_trunc("hour", "event_timestamp").cast(
        fact.schema["event_timestamp"].dataType))
    return aggregate(hourly, ["event_hour_start"], ["total_views", "completed_views"],
                     users=True)


def trending_content(fact, days=7, n=10):
    """The most viewed contents of the last ``days`` days before the latest event."""
    ts = F.col("event_timestamp")
    if "event_date" in fact.columns:
        # Where days are partitions, their maximum reads no column of the files, the time is
        # read of the last day only, and the rest of the days in reach.
        day = fact.agg(F.max("event_date").alias("day")).first().day
        if day is not None:
            last = F.lit(day)
            latest = fact.filter(F.col("event_date") == last).agg(F.max("event_timestamp")).scalar()
            fact = fact.filter(F.col("event_date") >= F.date_sub(last, days))
        else:
            latest = F.lit(None).cast("timestamp")
    else:
        latest = fact.agg(F.max("event_timestamp")).scalar()
    recent = fact.filter(ts > latest - F.make_dt_interval(F.lit(days)))
    return aggregate(recent, ["content_id"], ["total_views"]).orderBy(
        F.desc("total_views"), "content_id").limit(n)
