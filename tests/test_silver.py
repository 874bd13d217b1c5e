from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playlens.operators.quality import invalid_counts
from playlens.operators.silver import build_silver, clean, deduplicate, summary
from playlens.sources import sample
from playlens.sources.messages import BULK, STREAM, combine, stamp
from tests.conftest import SAMPLE, plan, values


def test_clean_tidies_text_and_derives(events):
    row = clean(events({"genre": " drama ", "device_type": " smartTV", "content_title": " A b ",
                        "region": "West", "completion_pct": 90.0})).first()
    assert (row.genre, row.device_type, row.content_title, row.region) == (
        "DRAMA", "SMARTTV", "A b", "WEST")
    assert row.event_timestamp == datetime(2024, 1, 5, 20, 15, 0, 1)
    assert (row.completion_category, row.device_category, row.time_of_day) == (
        "COMPLETED", "TV", "EVENING")
    assert row.completion_pct == Decimal("90.00")
    assert row.engagement_score == Decimal("93.0000")
    assert row.revenue_per_view == Decimal("134.1000")


def test_clean_keeps_bad_and_missing_values_as_null(events):
    row = clean(events({"event_timestamp": "yesterday", "completion_pct": None,
                        "device_type": None})).first()
    assert row.event_timestamp is None and row.event_date is None
    assert row.completion_category == "PARTIAL"
    assert row.device_category == "DESKTOP"
    assert row.engagement_score is None


def test_clean_accepts_typed_times(spark, events):
    text = clean(events({}))
    typed = clean(events({}).withColumn("event_timestamp", F.to_timestamp("event_timestamp")))
    assert values(text) == values(typed)


def test_deduplicate_keeps_the_first_by_order(spark):
    rows = [("a", "2024-01-02", STREAM, 1), ("a", "2024-01-01", BULK, 2),
            ("b", "2024-01-01", STREAM, 3), ("b", "2024-01-01", BULK, 4),
            (None, "2024-01-01", BULK, 5), (None, "2024-01-03", BULK, 6)]
    frame = spark.createDataFrame(rows, "event_id string, ingested_at string, source string, n int")
    assert values(deduplicate(frame), "event_id", "n") == values(
        spark.createDataFrame([("a", 2), ("b", 4), (None, 5)], "event_id string, n int"))


def test_survivor_does_not_depend_on_the_order_of_rows(spark):
    rows = [("a", "t", BULK, x) for x in ("PLAY", "COMPLETE", "STOP")]
    for turned in (rows, rows[::-1], rows[1:] + rows[:1]):
        frame = spark.createDataFrame(turned, "event_id string, ingested_at string, "
                                              "source string, action string")
        assert values(deduplicate(frame), "action") == [("COMPLETE",)]
    with pytest.raises(ValueError):
        deduplicate(frame, order=("loaded",))


def test_numbers_beyond_the_decimal_are_seen(events):
    sent = (1e12, float("inf"), float("nan"), 150.0, -1.0, 50.0, None)
    silver = clean(events(*[{"completion_pct": p} for p in sent]))
    assert invalid_counts(silver).first().invalid_completion == 5
    assert values(silver.filter("completion_raw > 1000"), "completion_category") == [
        ("COMPLETED",)] * 3


def test_deduplicate_without_order(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "event_id string, n int")
    assert values(deduplicate(frame, order=())) == [("a", 1), ("b", 2)]


def test_whole_sample_twice_is_reduced_to_once(spark):
    once = sample.watch_events(spark, SAMPLE)
    both = combine(stamp(once, BULK), stamp(once, STREAM))
    assert both.count() == 2 * once.count()
    kept = build_silver(both)
    assert kept.count() == once.count()
    assert kept.select("event_id").distinct().count() == once.count()


def test_deduplicate_limits_copies_before_the_shuffle(spark):
    frame = sample.watch_events(spark, SAMPLE).withColumn("ingested_at", F.current_timestamp())
    text = plan(deduplicate(frame))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_summary(events):
    silver = clean(events(*[{"completion_pct": p} for p in (90.0, 95.0, 60.0, 1.0, 2.0, None)]))
    assert [tuple(r) for r in summary(silver).collect()] == [
        ("PARTIAL", 3, 1.5), ("COMPLETED", 2, 92.5), ("MAJORITY", 1, 60.0)]
