"""Bulk file and message stream to reports over written layers."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playlens import registry, schemas
from playlens.operators import quality
from playlens.operators.silver import clean
from playlens.plans import checks, pipeline, reports
from playlens.plans import gold as gold_plans
from playlens.sources import messages, sample, tables
from playlens.streaming import bronze
from tests.conftest import SAMPLE, plan, values


def test_layers_end_to_end(spark, base):
    lake = pipeline.Lake(base)
    records = sample.watch_records(spark, SAMPLE)
    records.write.json(f"{base}/history")
    messages.publish(messages.encode(records), "text", path=f"{base}/incoming")

    bulk = pipeline.load_bronze_bulk(
        tables.scan_json(spark, f"{base}/history", schemas.WATCH_EVENT), lake)
    bronze.ingest_available(bronze.message_source(spark, "text", f"{base}/incoming"),
                            lake.stream_events, f"{base}/checkpoint")
    stream = tables.scan_table(spark, lake.stream_events)
    silver = pipeline.load_silver(bulk, stream, lake)
    gold = pipeline.load_gold(silver, lake)

    n = records.count()
    assert (bulk.count(), stream.count(), silver.count()) == (n, n, n)
    assert gold["fact_watch_events"].select("fact_key").distinct().count() == n
    for name, (_, natural, key) in pipeline.DIMENSIONS.items():
        table = spark.table(name)
        assert table.select(*natural).distinct().count() == table.count()
        assert sorted(r[0] for r in table.select(key).collect()) == list(
            range(1, table.count() + 1))

    fact = gold["fact_watch_events"]
    for dim, key in (("dim_content", "content_id"), ("dim_locations", "city"),
                     ("dim_devices", "device_type")):
        assert values(quality.orphans(fact, gold[dim], key)) == [(0, 0)]
    loss = quality.layer_loss(messages.combine(bulk, stream), silver, fact).first()
    assert (loss.bronze_to_silver_pct, loss.silver_to_gold_pct) == (0.0, 0.0)

    checked = checks.check_lake(spark, lake)
    assert checked.missing == {}
    assert values(checked.profile) == [
        ("bulk_history", n, n, 0), ("fact_watch_events", n, n, 0), ("stream_events", n, n, 0),
        ("watch_obt", n, n, 0)]
    assert {r.null_count for r in checked.nulls["watch_obt"].collect()} == {0}
    assert checked.invalid.first().invalid_completion == records.filter(
        "completion_pct > 100").count()
    assert sum(r["count"] for r in checked.time_of_day.collect()) == n
    assert values(checked.orphans) == [("dim_content", 0, 0), ("dim_devices", 0, 0),
                                       ("dim_locations", 0, 0)]
    assert checked.loss.first().bronze_to_silver_ok

    # The sample's raw completion is not limited to 100, here and in the direct query.
    wanted = registry.report_views_by_device(spark, SAMPLE)
    assert values(reports.aggregation(fact, "device_type", limit=10)) == values(wanted)
    outcomes = reports.run_reports(reports.configured("ECONOMY", "ASIA"), gold)
    assert [name for name, o in outcomes.items() if not o.ok] == []


    for name in pipeline.AGGREGATES:
        assert spark.table(name).count() == gold[name].count() > 0


def test_lake_without_a_stream_and_a_second_load(spark, base, events):
    lake, drops = pipeline.Lake(base), {}
    bulk = pipeline.load_bronze_bulk(events({}, {"content_title": None}), lake)
    silver = pipeline.load_silver(bulk, None, lake)
    first = pipeline.load_gold(silver, lake, drops)
    assert drops["dim_content"]["valid_content_title"] == 1
    old = values(first["dim_content"].select("content_id", "content_key"))
    more = events({}, {"content_id": "c-0", "content_title": "Earlier"})
    second = pipeline.load_gold(
        pipeline.load_silver(pipeline.load_bronze_bulk(more, lake), None, lake), lake)
    new = values(second["dim_content"].select("content_id", "content_key"))
    assert new == [("c-0", 2), *old] and old == [("c-1", 1)]
    assert checks.check_lake(spark, lake).missing.keys() == {"stream_events"}


def test_lake_with_nothing_in_it(spark, base, events):
    lake = pipeline.Lake(base)
    none = events({}).limit(0)
    silver = pipeline.load_silver(pipeline.load_bronze_bulk(none, lake), None, lake)
    assert silver.count() == 0
    gold = pipeline.load_gold(silver, lake)
    assert all(t.count() == 0 for t in gold.values())
    checks.check_lake(spark, lake)


def test_loss_counts_both_ways_into_the_raw_layer(spark, base, events):
    lake = pipeline.Lake(base)
    bulk = pipeline.load_bronze_bulk(events(*[{"event_id": f"b{i}"} for i in range(10)]), lake)
    live = events(*[{"event_id": f"s{i}"} for i in range(10)])
    tables.write_table(messages.stamp(live, messages.STREAM), lake.stream_events)
    pipeline.load_gold(pipeline.load_silver(tables.scan_table(spark, lake.stream_events), None,
                                            lake), lake)
    loss = checks.check_lake(spark, lake).loss.first()
    assert (loss.bronze_events, loss.silver_rows, loss.bronze_to_silver_pct) == (20, 10, 50.0)
    assert not loss.bronze_to_silver_ok and bulk.count() == 10


def test_loss_of_one_raw_layer_takes_the_events_that_the_profile_counted(spark, base, events):
    lake = pipeline.Lake(base)
    rows = events(*[{"event_id": i} for i in ("a", "a", "b", None, None)])
    pipeline.load_gold(pipeline.load_silver(pipeline.load_bronze_bulk(rows, lake), None, lake), lake)
    loss = checks.check_lake(spark, lake).loss
    assert "hashpartitioning(event_id" not in plan(loss)
    found = loss.first()
    assert (found.bronze_events, found.silver_rows, found.gold_rows) == (3, 3, 3)
    # With a column for unread messages only the others are events.
    unread = rows.withColumn(messages.CORRUPT, F.lit(None).cast("string"))
    pipeline.load_bronze_bulk(unread, lake)
    assert checks.check_lake(spark, lake).loss.first().bronze_events == 3


def test_other_errors_are_not_called_missing(spark, base):
    lake = pipeline.Lake(base, fmt="no_such_format")
    with pytest.raises(Exception, match="(?i)no_such_format"):
        checks.check_lake(spark, lake)


def test_quality_run_scans_silver_and_fact_twice(spark, base, events):
    lake = pipeline.Lake(base)
    silver = pipeline.load_silver(pipeline.load_bronze_bulk(events({}, {}), lake), None, lake)
    pipeline.load_gold(silver, lake)
    checked = checks.check_lake(spark, lake)
    found = [checked.range_stats, checked.invalid, checked.completion, checked.time_of_day,
             checked.orphans, checked.loss, checked.nulls["watch_obt"]]
    for frame in found:
        scans = [line for line in plan(frame).splitlines() if "FileScan" in line]
        assert not any("watch_obt" in s or "fact_watch_events" in s for s in scans)


def test_trending_reads_the_last_days_only(spark, base, events):
    fact = tables.write_table(clean(events(*[{"event_timestamp": f"2024-01-{d:02} 10:00:00"}
                                             for d in range(1, 29)])), f"{base}/fact",
                              partition_by=("event_date",))
    assert "event_date#" in plan(gold_plans.trending_content(fact)).split("PartitionFilters: [")[1]
    assert gold_plans.trending_content(fact).first().total_views == 7


def test_time_range_reads_only_its_days(spark, base):
    events = sample.watch_events(spark, SAMPLE)
    dated = events.withColumn("event_date", F.to_date("event_timestamp")).withColumn(
        "engagement_score", F.lit(0).cast(schemas.SCORE))
    fact = tables.write_table(dated, f"{base}/fact", partition_by=("event_date",))
    report = reports.time_analysis(fact, "event_day", "2024-01-05", "2024-01-07")
    report.collect()
    text = report._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "event_timestamp" in scan.split("PushedFilters")[1]


def test_checks_of_an_incomplete_lake(spark, base, events):
    lake = pipeline.Lake(base)
    pipeline.load_bronze_bulk(events({}, {"event_id": "e0"}), lake)
    checked = checks.check_lake(spark, lake)
    assert values(checked.profile) == [("bulk_history", 2, 1, 1)]
    assert {"stream_events", "watch_obt", "fact_watch_events"} <= set(checked.missing)
    assert checked.invalid is None and checked.orphans is None and checked.loss is None
    assert list(checked.nulls) == ["bulk_history"]


def test_files_that_are_sent_are_compressed(spark):
    lake, silver = registry.filled_lake(spark, SAMPLE)
    for folder in ("history", "incoming"):
        sent = [p for p in Path(lake.base, folder).rglob("part-*") if p.stat().st_size]
        assert sent and all(p.name.endswith(".lz4") for p in sent)
    assert silver.count() == spark.read.parquet(f"{SAMPLE}/events.parquet").count()
