"""Dimensions, keys, fact, star analytics."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Observation
from pyspark.sql import functions as F

from playlens import schemas
from playlens.functions.measures import MEASURES, aggregate, aggregate_star
from playlens.operators import dims
from playlens.operators.expectations import expect_or_drop, failures
from playlens.operators.fact import build_fact
from playlens.operators.keys import dense_keys, new_keys
from playlens.operators.silver import clean
from playlens.plans import gold, star
from playlens.sources import sample
from tests.conftest import SAMPLE, values


def test_dimensions_are_distinct_and_ruled(events):
    silver = clean(events({}, {}, {"content_id": None}, {"content_title": None},
                          {"user_id": None}, {"city": None}, {"subscription_plan": "PREMIUM",
                                                              "subscription_price": 649}))
    assert values(dims.dim_content(silver)) == [("c-1", "First", "Movie", "DRAMA", "English")]
    assert values(dims.dim_users(silver)) == [("u-1", "25-34", "BASIC", 149),
                                              ("u-1", "25-34", "PREMIUM", 649)]
    assert values(dims.dim_locations(silver)) == [("Lyon", "Rhone", "WEST")]
    assert values(dims.dim_devices(silver)) == [("MOBILE", "iOS", "MOBILE")]
    assert dims.dim_content(silver, ("content_id", "genre"), rules=None).count() == 2
    assert dims.dim_content(silver, created=True).columns[-1] == "created_at"


def test_dim_date(events):
    silver = clean(events(*[{"event_timestamp": f"{d} 10:00:00"} for d in
                            ("2024-02-29", "2024-03-02", "2024-03-02", "2024-03-03")]))
    assert values(dims.dim_date(silver)) == [
        (dt.date(2024, 2, 29), 2024, 2, 29, 5, 0, "February"),
        (dt.date(2024, 3, 2), 2024, 3, 2, 7, 1, "March"),
        (dt.date(2024, 3, 3), 2024, 3, 3, 1, 1, "March")]


def test_all_month_names(spark, events):
    silver = clean(events(*[{"event_timestamp": f"2024-{m:02}-01 00:00:00"}
                            for m in range(1, 13)]))
    names = [r.month_name for r in dims.dim_date(silver).orderBy("month").collect()]
    assert names == ["January", "February", "March", "April", "May", "June", "July", "August",
                     "September", "October", "November", "December"]


def test_expectations_count_and_drop(spark):
    frame = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None)],
                                  "city string, n int")
    rules = {"valid_city": "city IS NOT NULL", "valid_n": "n > 1"}
    seen = Observation()
    assert values(expect_or_drop(frame, rules, seen)) == []
    assert seen.get == {"rows": 4, "valid_city": 2, "valid_n": 3}
    assert values(failures(frame, rules)) == [("valid_city", 2), ("valid_n", 3)]
    assert values(expect_or_drop(frame, {"valid_city": "city IS NOT NULL"}), "city") == [
        ("a",), ("b",)]


def test_dense_keys_equal_global_row_number(spark):
    rows = [(f"t{i * 37 % 1000:04}", i % 7) for i in range(1000)] + [(None, 3), (None, 1)]
    frame = spark.createDataFrame(rows, "title string, n int").repartition(16)
    keyed = dense_keys(frame, ["title", "n"], "title_key").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sorted((tuple(r)[2], tuple(r)[:2]) for r in keyed) == list(enumerate(order, 1))


def test_dense_keys_of_no_rows(spark):
    frame = spark.createDataFrame([], "title string")
    assert dense_keys(frame, ["title"], "k").collect() == []


def test_new_keys_leave_old_keys_as_they_are(spark):
    schema = "title string, n int"
    first = dense_keys(spark.createDataFrame([("b", 1), (None, 2)], schema), ["title", "n"], "k")
    later = spark.createDataFrame([("a", 1), ("b", 1), (None, 2), ("c", None)], schema)
    assert values(new_keys(later, first, ["title", "n"], "k")) == [("a", 1, 3), ("c", None, 4)]
    assert new_keys(first.drop("k"), first, ["title", "n"], "k").count() == 0


def test_fact_has_all_report_columns(events):
    fact = build_fact(clean(events({}, {})), stamped=True)
    assert fact.columns == [*schemas.FACT, "fact_key", "gold_timestamp"]
    assert fact.select("fact_key").distinct().count() == 2


def _fact(spark):
    return build_fact(clean(sample.watch_events(spark, SAMPLE, place=True)))


def test_star_aggregate_equals_join_then_aggregate(spark):
    """Also with dimensions that repeat a key or miss one, and with NULL keys."""
    fact = _fact(spark).withColumn(
        "user_id", F.when(F.col("event_id").cast("int") % 9 != 0, F.col("user_id")))
    dim = spark.createDataFrame(
        [(str(u), p, "x" if u % 3 else "y") for u in range(0, 100, 2) for p in "ab"[: 1 + u % 4]]
        + [(None, "a", "x")], "user_id string, p string, q string")
    measures = list(MEASURES)
    joined = fact.join(dim, "user_id")
    for keys in (["p"], ["p", "q"], ["user_id", "p"]):
        assert values(aggregate_star(fact, dim, "user_id", keys, measures)) == values(
            aggregate(joined, keys, measures))


def test_sums_beyond_a_hundred_trillion(spark):
    rows = spark.range(20_000).selectExpr(
        "string(id) AS event_id", "cast('9999999999.9999' AS decimal(14,4)) AS revenue_per_view",
        "1 AS g")
    got = aggregate(rows, ["g"], ["total_revenue"]).first().total_revenue
    assert got == float(Decimal("9999999999.9999") * 20_000)


def test_age_groups_of_a_user_do_not_multiply_revenue(events):
    silver = clean(events({"age_group": "18-24"}, {"age_group": "55+"}).withColumns({
        "subscription_plan": F.lit("STANDARD"), "subscription_price": F.lit(299)}))
    fact, users = build_fact(silver), dims.dim_users(silver)
    assert users.count() == 2
    for form in (star.revenue_by_plan_literal, star.revenue_by_plan):
        assert values(form(fact, users)) == [("STANDARD", 2, 598.0)]


def test_revenue_forms_differ_for_users_with_several_plans(events):
    silver = clean(events(
        {"user_id": "u1", "subscription_plan": "BASIC", "subscription_price": 149},
        {"user_id": "u1", "subscription_plan": "PREMIUM", "subscription_price": 649},
        {"user_id": "u2", "subscription_plan": "BASIC", "subscription_price": 149}))
    fact, users = build_fact(silver), dims.dim_users(silver)
    assert values(star.revenue_by_plan_literal(fact, users)) == [
        ("BASIC", 3, 947.0), ("PREMIUM", 2, 798.0)]
    assert values(star.revenue_by_plan(fact, users)) == [("BASIC", 2, 298.0),
                                                         ("PREMIUM", 1, 649.0)]


def test_genre_views_and_top_content(events):
    silver = clean(events({"completion_pct": 10.0}, {"completion_pct": 20.0},
                          {"content_id": "c-2", "content_title": "Second", "genre": "Comedy"}))
    fact, content = build_fact(silver), dims.dim_content(silver)
    assert [tuple(r) for r in star.genre_views(fact, content).collect()] == [
        ("DRAMA", 2, 15.0), ("COMEDY", 1, 50.0)]
    assert [tuple(r) for r in star.top_content(fact, content).collect()] == [
        ("First", 2), ("Second", 1)]


def test_trending_content_window_and_ties(events):
    days = ["2024-01-10 00:00:00", "2024-01-17 00:00:00", "2024-01-16 00:00:00",
            "2024-01-11 00:00:00"]
    fact = build_fact(clean(events(*[{"event_timestamp": d, "content_id": c}
                                     for d, c in zip(days, "abba")])))
    assert [tuple(r) for r in gold.trending_content(fact).collect()] == [("b", 2), ("a", 1)]


def test_hourly_pulse_keeps_rows_without_time(events):
    silver = clean(events({}, {"user_id": "u-2"}, {"event_timestamp": "never"}))
    rows = gold.hourly_pulse(build_fact(silver)).collect()
    assert sorted((str(r[0]), r.total_views, r.unique_users) for r in rows) == [
        ("2024-01-05 20:00:00", 2, 2), ("None", 1, 1)]


def test_dimensions_of_seen_keys_equal_those_of_all_events(spark):
    silver = clean(sample.watch_events(spark, SAMPLE, content=True, place=True))
    assert values(dims.dim_content(clean(sample.seen_contents(spark, SAMPLE)))) == values(
        dims.dim_content(silver))
    assert values(dims.dim_locations(clean(sample.seen_places(spark, SAMPLE)))) == values(
        dims.dim_locations(silver))


def test_content_number_of_usual_and_other_json(spark):
    texts = ['{"k": 69}', '{"k":7}', '{"a": 1, "k": 8}', '{"k": 9, "a": {"k": 1}}', '{"k": "12"}',
             '{"k": null}', '{"k": 1.5}', "{", "", None, '{"k": -3}', '{"k": 5 }']
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, props string")
    got = frame.orderBy("i").selectExpr(f"{sample.CONTENT_NO} AS n").collect()
    assert [r.n for r in got] == [69, 7, 8, 9, 12, None, None, None, None, None, -3, 5]
