from datetime import datetime
from decimal import Decimal

import pytest

from playlens.functions import features


def column(spark, expression, values, kind):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_completion_boundaries(spark):
    pct = [9.99, 10.0, 49.99, 50.0, 89.99, 90.0, 100.0, None]
    assert column(spark, features.completion_category("x"), pct, "double") == [
        "PARTIAL", "PARTIAL", "PARTIAL", "MAJORITY", "MAJORITY", "COMPLETED", "COMPLETED",
        "PARTIAL"]
    assert column(spark, features.is_completed("x"), pct, "double") == [0, 0, 0, 0, 0, 1, 1, 0]
    assert column(spark, features.is_dropped("x"), pct, "double") == [1, 0, 0, 0, 0, 0, 0, 0]


def test_device_category(spark):
    devices = ["MOBILE", "TABLET", "SMARTTV", "ROKU", "LAPTOP", "", None]
    assert column(spark, features.device_category("x"), devices, "string") == [
        "MOBILE", "MOBILE", "TV", "TV", "DESKTOP", "DESKTOP", "DESKTOP"]


def test_calendar(spark):
    stamps = [datetime(2024, 1, 5, 17, 59), datetime(2024, 1, 5, 18), datetime(2024, 1, 6, 23, 59),
              datetime(2024, 1, 7, 0), datetime(2024, 2, 29, 5)]
    wanted = {
        "event_hour": [17, 18, 23, 0, 5],
        "event_day": ["Friday", "Friday", "Saturday", "Sunday", "Thursday"],
        "event_month": [1, 1, 1, 1, 2],
        "is_prime_time": [0, 1, 1, 0, 0],
        "is_weekend": [0, 0, 1, 1, 0],
    }
    for name, expression in features.calendar_features("x").items():
        assert column(spark, expression, stamps, "timestamp_ntz") == wanted[name]


def test_time_of_day(spark):
    stamps = [datetime(2024, 1, 1, h) for h in (0, 4, 5, 11, 12, 17, 18, 23)]
    assert column(spark, features.time_of_day("x"), stamps, "timestamp_ntz") == [
        "NIGHT", "NIGHT", "MORNING", "MORNING", "AFTERNOON", "AFTERNOON", "EVENING", "EVENING"]


@pytest.mark.parametrize("watched, total, wanted", [
    (45, 90, "50.00"), (1, 3, "33.33"), (2, 3, "66.67"), (0, 30, "0.00"), (5, 0, None),
    (1, 32, "3.12"), (3, 32, "9.38"), (None, 30, None)])
def test_completion_pct_rounds_ties_to_even(spark, watched, total, wanted):
    row = spark.createDataFrame([(watched, total)], "w int, t int").select(
        features.completion_pct("w", "t")).first()
    assert row[0] == (None if wanted is None else Decimal(wanted))


def test_completion_pct_equals_float_rounding(spark):
    pairs = [(w, t) for t in range(30, 183) for w in range(1, t + 1)]
    frame = spark.createDataFrame(pairs, "w int, t int")
    rows = frame.select("w", "t", features.completion_pct("w", "t").cast("double").alias("p"))
    different = [r for r in rows.collect() if r.p != round(r.w / r.t * 100, 2)]
    assert different == []


def test_parse_time_takes_both_encodings_and_rejects_text(spark):
    texts = ["2024-01-05T20:15:00.000001", "2024-01-05 20:15:00", "not a time", None]
    assert column(spark, features.parse_time("x").cast("string"), texts, "string") == [
        "2024-01-05 20:15:00.000001", "2024-01-05 20:15:00", None, None]


def test_scores(spark):
    pct = ["0.00", "50.00", "89.99", "90.00", "100.00"]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pct)], "i int, p string")
    rows = frame.orderBy("i").select(
        features.engagement_score("p").cast("double"),
        features.revenue_per_view("149", "p").cast("double")).collect()
    assert [tuple(r) for r in rows] == [
        (0.0, 0.0), (35.0, 74.5), (62.993, 134.0851), (93.0, 134.1), (100.0, 149.0)]
