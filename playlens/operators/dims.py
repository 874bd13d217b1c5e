"""Dimension tables: distinct attribute rows of the silver layer."""

from pyspark.sql import functions as F

from playlens import schemas
from playlens.operators.expectations import expect_or_drop

# Rules a row must meet to enter a dimension.
CONTENT_RULES = {
    "valid_content_id": "content_id IS NOT NULL",
    "valid_content_title": "content_title IS NOT NULL",
}
USER_RULES = {"valid_user_id": "user_id IS NOT NULL"}
CITY_RULES = {"valid_city": "city IS NOT NULL"}


def _dimension(silver, columns, rules, created, dropped):
    rows = silver.select(*columns)
    if rules:
        rows = expect_or_drop(rows, rules, dropped)
    rows = rows.distinct()
    return rows.withColumn("created_at", F.current_timestamp()) if created else rows


# ``columns`` may name fewer attributes, and ``rules=None`` keeps every row. ``dropped`` is an
# ``Observation`` that counts the rows each rule drops.

def dim_content(silver, columns=schemas.DIM_CONTENT, rules=CONTENT_RULES, created=False,
                dropped=None):
    return _dimension(silver, columns, rules, created, dropped)


def dim_users(silver, columns=schemas.DIM_USERS, rules=USER_RULES, created=False,
              dropped=None):
    return _dimension(silver, columns, rules, created, dropped)


def dim_devices(silver, columns=schemas.DIM_DEVICES, rules=None, created=False,
              dropped=None):
    return _dimension(silver, columns, rules, created, dropped)


def dim_locations(silver, columns=schemas.DIM_LOCATIONS, rules=CITY_RULES, created=False,
              dropped=None):
    return _dimension(silver, columns, rules, created, dropped)


def dim_date(silver):
    """One row per calendar day with its parts; Sunday is day 1 of the week."""
    day = F.col("date")
    known = "event_date" in silver.columns
    dates = F.col("event_date") if known else F.to_date("event_timestamp")
    return silver.select(dates.alias("date")).distinct().select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.date_format(day, "MMMM").alias("month_name"),
    )
