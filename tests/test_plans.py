"""Physical plans: what is read, shuffled and combined."""

import pytest
from pyspark.sql import functions as F

from playlens import registry
from playlens.functions.measures import aggregate_star
from playlens.sources import sample
from tests.conftest import SAMPLE, plan

# Queries that write while they are built have no plan of their own to look at.
WRITING = {"scan_json_bulk", "write_overwrite", "save_gold", "register_table", "stream_bronze",
           "dim_keys", "views_by_device_end_to_end", "publish_counts", "run_reports_status"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - WRITING))
def test_no_python_cross_join_or_global_window(spark, name):
    text = plan(registry.QUERIES[name](spark, SAMPLE))
    for word in ("Python", "Cartesian", "NestedLoop", "InMemory", "CollectLimit", "MapInPandas"):
        assert word not in text.replace("InMemoryFileIndex", ""), word


def test_only_needed_columns_are_read(spark):
    text = plan(registry.report_views_by_device(spark, SAMPLE))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
    assert text.count("FileScan") == 1


def test_time_range_reaches_the_scan(spark):
    text = plan(registry.report_time_range(spark, SAMPLE))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text
    assert "LessThanOrEqual(ts,2024-01-12T00:00)" in text


def test_genre_filter_reaches_the_dimension_scan(spark):
    text = plan(registry.report_genre(spark, SAMPLE))
    part_scan = next(line for line in text.splitlines()
                     if "FileScan" in line and "part.parquet" in line)
    assert "ECONOMY" in part_scan


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject(limit=10" in plan(registry.report_all_content(spark, SAMPLE))


def test_fact_is_reduced_before_the_star_join(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    fact = sample.watch_events(spark, SAMPLE)
    dim = sample.read(spark, SAMPLE, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), "c_mktsegment")
    text = plan(aggregate_star(fact, dim, "user_id", ["c_mktsegment"], ["total_views"]))
    join = text.index("SortMergeJoin")
    fact_side = text[join:]
    assert "partial_count(event_id" in fact_side
    # One shuffle by user on each side; the join reuses both.
    assert fact_side.count("Exchange hashpartitioning(user_id") == 2


def test_lookup_of_a_large_table_splits_a_hot_key(spark, request):
    """Where the looked-up table is too large to send around, adaptive execution splits
    the partition of a key that has a third of all rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)

    def reset():
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    request.addfinalizer(reset)
    events = sample.read(spark, SAMPLE, "events").select(
        "event_id", "user_id", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("n"),
    ).select(
        F.when(F.col("n") <= 14, F.lit(3)).otherwise(F.col("user_id")).alias("user_no"),
        F.sha2(F.concat_ws("-", "event_id", "n"), 256).alias("payload"))
    joined = events.repartition(12).join(sample.places(spark, SAMPLE), "user_no", "left")
    total = joined.groupBy("city").agg(F.count("payload").alias("rows"), F.max("payload"))
    assert sum(r["rows"] for r in total.collect()) == events.count()
    assert "SortMergeJoin(skew=true)" in plan(total)
