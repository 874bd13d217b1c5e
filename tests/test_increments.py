"""Loads that change some days of stored layers, against loads of everything."""

import random

import pytest
from pyspark.sql import functions as F

from playlens import schemas
from playlens.plans import pipeline
from playlens.sources import messages, tables
from tests.conftest import values

DAYS = [f"2024-01-0{d} 10:00:00" for d in range(1, 7)]


def raw(events, rows, at, source=messages.STREAM):
    """Raw rows of one load at a day of February."""
    return messages.stamp(events(*rows), source, F.lit(f"2024-02-{at:02} 00:00:00").cast("timestamp"))


def silver_rows(table):
    return values(table.select(*sorted(c for c in table.columns if c != "silver_timestamp")))


def files(table):
    return {(r[0], r[1]) for r in table.select("event_date", "_metadata.file_path").distinct().collect()}


def load_all(loads, base):
    rows = loads[0]
    for more in loads[1:]:
        rows = rows.unionByName(more)
    return pipeline.load_silver(rows, None, pipeline.Lake(f"{base}/all"))


@pytest.mark.parametrize("seed", range(3))
def test_loads_one_by_one_equal_a_load_of_all(spark, base, events, seed):
    pick = random.Random(seed)
    loads = []
    for at in pick.sample(range(1, 20), 4):  # not in the order of their load times
        rows = [{"event_id": pick.choice([None, *[f"e{i}" for i in range(12)]]),
                 "event_timestamp": pick.choice([*DAYS, "no time"]),
                 "city": f"{at} {i}"} for i in range(10)]
        loads.append(raw(events, rows, at))
    lake = pipeline.Lake(f"{base}/one")
    for rows in loads:
        silver, days = pipeline.refresh_silver(rows, lake)
    assert silver_rows(silver) == silver_rows(load_all(loads, base))


def test_an_event_that_moves_to_another_day_empties_its_old_one(spark, base, events):
    lake = pipeline.Lake(base)
    late = raw(events, [{"event_timestamp": DAYS[0]}, {"event_timestamp": DAYS[1]}], 9)
    pipeline.refresh_silver(late, lake)
    early = raw(events, [{"event_timestamp": DAYS[2]}], 3)
    silver, days = pipeline.refresh_silver(early, lake)
    assert sorted(map(str, days)) == ["2024-01-01", "2024-01-03"]
    assert values(silver.select("event_id", F.col("event_date").cast("string"))) == [
        ("e0", "2024-01-03"), ("e1", "2024-01-02")]
    assert silver_rows(silver) == silver_rows(load_all([late, early], base))
    assert sorted(str(d) for d, _ in files(silver)) == ["2024-01-02", "2024-01-03"]


def test_days_that_are_not_touched_keep_their_files(spark, base, events):
    lake = pipeline.Lake(base)
    rows = [{"event_timestamp": d} for d in DAYS]
    first, none = pipeline.refresh_silver(raw(events, rows, 1), lake)
    before = files(first)
    assert none is None and len(before) == 6
    copies = raw(events, rows, 2)  # nothing but copies
    silver, days = pipeline.refresh_silver(copies, lake)
    assert days == [] and files(silver) == before
    silver, days = pipeline.refresh_silver(
        raw(events, [{"event_id": "new", "event_timestamp": DAYS[3]}], 3), lake)
    assert [str(d) for d in days] == ["2024-01-04"]
    assert {d for d, _ in files(silver) - before} == {d for d, _ in before - files(silver)} == set(days)
    nothing, days = pipeline.refresh_silver(copies.limit(0), lake)
    assert days == [] and nothing.count() == 7


def test_fact_keys_stay_over_loads(spark, base, events):
    lake = pipeline.Lake(base)

    def keys(gold):
        return dict(values(gold["fact_watch_events"].select("event_id", "fact_key")))

    first = keys(pipeline.load_increment(
        raw(events, [{"event_timestamp": d} for d in DAYS], 5), lake))
    # New events, a changed one that moves to another day, and an unchanged copy.
    more = [{"event_id": f"x{i}", "event_timestamp": DAYS[i % 2]} for i in range(20)]
    second = keys(pipeline.load_increment(raw(events, more, 6), lake))
    third = keys(pipeline.load_increment(raw(events, [{"event_timestamp": DAYS[5]}], 1), lake))
    assert {e: second[e] for e in first} == first and third == second
    assert len(set(third.values())) == len(third) == 26
    assert min(k for e, k in second.items() if e not in first) > max(first.values())
    fact = tables.scan_table(spark, f"{lake.gold}/fact_watch_events")
    assert [str(r[0]) for r in fact.filter("event_id = 'e0'").select("event_date").collect()] == ["2024-01-06"]
    # A load of everything keeps them too, and drops an event that is not there any more.
    silver = tables.scan_table(spark, lake.watch_obt).filter("event_id <> 'x3'")
    whole = keys(pipeline.load_gold(silver, lake))
    assert whole == {e: k for e, k in third.items() if e != "x3"}


def test_an_increment_gives_the_gold_of_a_load_of_all(spark, base, events):
    loads = [raw(events, [{"event_timestamp": DAYS[i % 3], "city": f"c{i % 4}", "user_id": f"u{i % 3}"}
                          for i in range(9)], 1),
             raw(events, [{"event_id": f"n{i}", "event_timestamp": DAYS[4], "city": f"c{i}"}
                          for i in range(6)], 2)]
    lake = pipeline.Lake(f"{base}/one")
    for rows in loads:
        gold = pipeline.load_increment(rows, lake)
    silver = load_all(loads, base)
    whole = pipeline.load_gold(silver, pipeline.Lake(f"{base}/all"))
    for name in gold:
        columns = [c for c in gold[name].columns if c not in (
            "gold_timestamp", "created_at") and not c.endswith("_key")]
        assert values(gold[name], *columns) == values(whole[name], *columns), name
    for name, (_, _, key) in pipeline.DIMENSIONS.items():
        got = sorted(r[0] for r in gold[name].select(key).collect())
        assert got == list(range(1, len(got) + 1)), name


def test_partitions_are_replaced_and_emptied(spark, base):
    path = f"{base}/t"
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "n int, p string")
    table = tables.write_table(rows, path, partition_by=("p",))
    fewer = table.filter("p = 'a'").withColumn("n", F.col("n") + 10)
    table = tables.replace_partitions(fewer, path, "p", ["a", "b", None])
    assert values(table) == [(11, "a"), (4, "c")]
    assert values(tables.replace_partitions(fewer.limit(0), path, "p", [])) == [(11, "a"), (4, "c")]
    empty = tables.replace_partitions(table.limit(0), path, "p", ["a", "c"])
    assert values(empty) == [] and empty.columns == ["n", "p"]


def test_no_hot_key_in_the_fact_join(spark, base, events):
    """Events without an id are one row of silver, so its null-safe join has no hot key."""
    lake = pipeline.Lake(base)
    rows = raw(events, [{"event_id": None}] * 50 + [{}], 1)
    gold = pipeline.load_increment(rows, lake)
    again = pipeline.load_increment(rows, lake)
    assert gold["fact_watch_events"].count() == again["fact_watch_events"].count() == 2
    assert set(schemas.FACT) < set(again["fact_watch_events"].columns)
