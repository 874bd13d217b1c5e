import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from playlens.operators import dims
from playlens.operators.fact import build_fact
from playlens.operators.silver import clean
from playlens.plans import reports
from playlens.sources import sample
from tests.conftest import SAMPLE, values


@pytest.fixture(scope="module")
def tables(spark):
    silver = clean(sample.watch_events(spark, SAMPLE, content=True, place=True))
    return {"fact_watch_events": build_fact(silver), "dim_content": dims.dim_content(silver),
            "dim_locations": dims.dim_locations(silver)}


def half_up(total, n):
    return float((Decimal(total) / Decimal(n)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def by_hand(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def test_aggregation_by_hand(tables):
    fact = tables["fact_watch_events"]
    wanted = [(
        device, len(g), half_up(sum(r.completion_pct for r in g), len(g)),
        half_up(sum(r.engagement_score for r in g), len(g)),
        half_up(sum(r.revenue_per_view for r in g), 1),
        sum(r.is_completed for r in g), sum(r.is_dropped for r in g),
        half_up(100 * sum(r.is_completed for r in g), len(g)))
        for device, g in by_hand(fact.collect(), lambda r: r.device_type).items()]
    wanted.sort(key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in reports.aggregation(fact, "device_type").collect()] == wanted
    limited = reports.aggregation(fact, "device_type", limit=2)
    assert [tuple(r) for r in limited.collect()] == wanted[:2]


def test_location_by_hand(tables):
    places = {r.city: (r.city, r.state, r.region) for r in tables["dim_locations"].collect()}
    rows = tables["fact_watch_events"].collect()
    wanted = {(*places[c], len(g), len({r.user_id for r in g}))
              for c, g in by_hand(rows, lambda r: r.city).items()}
    got = reports.location_performance(tables["fact_watch_events"], tables["dim_locations"])
    assert {(r.city, r.state, r.region, r.total_views, r.unique_users)
            for r in got.collect()} == wanted
    west = reports.location_performance(tables["fact_watch_events"], tables["dim_locations"],
                                        region="ASIA", limit=2).collect()
    assert len(west) == 2 and {r.region for r in west} == {"ASIA"}


def test_city_in_two_regions_and_repeated_rows(spark, events):
    """Equal to joining first, with users counted once per group."""
    fact = build_fact(clean(events({"city": "a", "user_id": "u"}, {"city": "a", "user_id": "v"},
                                   {"city": "a", "user_id": "v"}, {"city": None})))
    dim = spark.createDataFrame([("a", "s", "R"), ("a", "s", "R"), ("a", "t", "R"),
                                 ("b", "s", "R")], "city string, state string, region string")
    got = reports.location_performance(fact, dim)
    joined = fact.join(dim, "city").groupBy("city", "state", "region").agg(
        F.count("event_id"), F.countDistinct("user_id"))
    assert values(got, "city", "state", "region", "total_views", "unique_users") == values(
        joined) == [("a", "s", "R", 6, 2), ("a", "t", "R", 3, 2)]


def test_content_order_and_limit(tables):
    fact, dim = tables["fact_watch_events"], tables["dim_content"]
    whole = reports.content_performance(fact, dim, order_by="total_revenue").collect()
    assert sum(r.total_views for r in whole) == fact.count()
    revenue = [r.total_revenue for r in whole]
    assert revenue == sorted(revenue, reverse=True)
    assert reports.content_performance(fact, dim, order_by="total_revenue",
                                       limit=3).collect() == whole[:3]
    one = reports.content_performance(fact, dim, genre="ECONOMY").collect()
    assert one and {r.genre for r in one} == {"ECONOMY"}


def test_ties_are_ordered_by_key(events):
    fact = build_fact(clean(events(*[{"device_type": d} for d in ("b", "c", "a", "c", "b")])))
    got = reports.aggregation(fact, "device_type", limit=2).collect()
    assert [(r.device_type, r.total_views) for r in got] == [("B", 2), ("C", 2)]


def test_filter_and_zero_limit(tables):
    fact = tables["fact_watch_events"]
    done = reports.aggregation(fact, "subscription_plan", F.col("is_completed") == 1, limit=0)
    assert sum(r.total_views for r in done.collect()) == fact.filter("is_completed = 1").count()
    assert {r.completion_rate_pct for r in done.collect()} == {100.0}


def test_time_range_is_inclusive_and_needs_both_ends(events):
    stamps = ["2024-01-05 00:00:00", "2024-01-06 00:00:00", "2024-01-06 00:00:01",
              "2024-01-04 23:59:59"]
    fact = build_fact(clean(events(*[{"event_timestamp": s, "event_day": s[8:10]}
                                     for s in stamps])))

    def days(**bounds):
        rows = reports.time_analysis(fact, "event_day", **bounds).collect()
        return [(r.event_day, r.total_views) for r in rows]

    assert days(start="2024-01-05", end="2024-01-06") == [("05", 1), ("06", 1)]
    assert days(start="2024-01-05") == days() == [("04", 1), ("05", 1), ("06", 2)]


def test_column_names_are_checked(tables):
    fact, dim = tables["fact_watch_events"], tables["dim_content"]
    with pytest.raises(ValueError):
        reports.aggregation(fact, "no_column")
    with pytest.raises(ValueError):
        reports.content_performance(fact, dim, order_by="1; drop table")
    with pytest.raises(ValueError):
        reports.time_analysis(fact, "no_column")


def test_values_are_never_read_as_sql(tables):
    odd = reports.content_performance(tables["fact_watch_events"], tables["dim_content"],
                                      genre="x' OR '1'='1")
    assert odd.collect() == []


def test_all_nine_run_and_one_failure_is_kept_apart(tables):
    chosen = reports.configured("ECONOMY", "ASIA")
    broken = reports.Report("broken", reports.aggregation, options={"by": "missing"})
    outcomes = reports.run_reports([broken, *chosen], tables)
    assert len(chosen) == 9
    assert not outcomes["broken"].ok and "missing" in outcomes["broken"].error
    assert all(outcomes[r.name].ok for r in chosen)
    assert len(outcomes["all_location_performance"].frame.collect()) == 8
    late = reports.Report("late", lambda fact: fact.select(F.raise_error(F.lit("late error"))))
    outcome = reports.run_reports([late], tables)["late"]
    assert not outcome.ok and "late error" in outcome.error
    missing_table = reports.run_reports(chosen, {})
    assert not any(o.ok for o in missing_table.values())


def test_hot_key_with_a_third_of_all_rows(spark, tables):
    """A skewed fact gives what a direct count gives."""
    rng = random.Random(3)
    contents = [r.content_id for r in tables["dim_content"].collect()]
    ids = [contents[0] if i % 3 == 0 else rng.choice(contents) for i in range(6000)]
    keys = spark.createDataFrame([(str(i), c) for i, c in enumerate(ids)],
                                 "event_id string, content_id string")
    fact = (tables["fact_watch_events"].drop("content_id")
            .join(keys, "event_id").repartition(8))
    titles = {r.content_id: r.content_title for r in tables["dim_content"].collect()}
    views = defaultdict(int)
    for r in fact.select("content_id").collect():
        views[titles[r.content_id]] += 1
    got = reports.content_performance(fact, tables["dim_content"])
    merged = defaultdict(int)
    for r in got.collect():
        merged[r.content_title] += r.total_views
    assert merged == views


def test_null_group_is_reported(events):
    fact = build_fact(clean(events({"subscription_plan": None}, {})))
    assert values(reports.aggregation(fact, "subscription_plan"),
                  "subscription_plan", "total_views") == [("BASIC", 1), (None, 1)]
