import pytest
from pyspark.sql import functions as F

from playlens.session import work_dir
from playlens.sources import sample, tables
from tests.conftest import SAMPLE, values


def test_overwrite_replaces_rows_and_schema(spark, base):
    tables.write_table(spark.range(5), f"{base}/t")
    again = tables.write_table(spark.range(2).withColumn("x", F.lit("a")), f"{base}/t")
    assert values(again) == [(0, "a"), (1, "a")]


def test_append(spark, base):
    tables.write_table(spark.range(2), f"{base}/t")
    assert tables.write_table(spark.range(1), f"{base}/t", mode="append").count() == 3


def test_view_reads_the_stored_keys(spark, base):
    frame = spark.range(100).repartition(5).withColumn("k", F.monotonically_increasing_id())
    saved = tables.save_gold(frame, base, "some_fact")
    stored = values(spark.read.parquet(f"{base}/some_fact"), "id", "k")
    assert values(spark.table("some_fact"), "id", "k") == stored == values(saved, "id", "k")


def test_register_replaces_and_falls_back(spark, base):
    first = tables.write_table(spark.range(3), f"{base}/a")
    tables.write_table(spark.range(4), f"{base}/b")
    assert values(tables.register_table(spark, "tests_db", "t", f"{base}/a",
                                        location=f"{base}/db")) == values(first)
    assert tables.register_table(spark, "tests_db", "t", f"{base}/b").count() == 4
    assert spark.sql("SELECT count(*) FROM tests_db.t").first()[0] == 4
    # No such catalog: the files are read instead.
    assert tables.registered_or_path(spark, "no_catalog.db", "t", f"{base}/a").count() == 3


def test_partitioned_write_splits_a_hot_day_and_keeps_all_rows(spark, base):
    days = spark.range(9000).withColumn(
        "event_date", F.when(F.col("id") % 3 == 0, F.col("id") % 20).otherwise(1))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    try:
        table = tables.write_table(days, f"{base}/d", partition_by=("event_date",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.count() == 9000
    files = table.select("event_date", F.input_file_name().alias("f")).distinct()
    per_day = {r.event_date: r["count"] for r in files.groupBy("event_date").count().collect()}
    assert per_day[1] > 1
    # Far from one file per map task and day.
    assert sum(per_day.values()) < 8 * len(per_day) / 2


def test_preview_and_frequency(spark):
    frame = sample.read(spark, SAMPLE, "events")
    assert [r.event_id for r in tables.preview(frame, "event_id").collect()] == [0, 1, 2, 3, 4]
    words = spark.createDataFrame([(w,) for w in "b a c b a d".split()], "w string")
    assert [tuple(r) for r in tables.most_frequent(words, "w", 3).collect()] == [
        ("a", 2), ("b", 2), ("c", 1)]
    assert tables.most_frequent(words, "w").count() == 4


def test_work_dir_is_new_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(f"{base}/playlens/x/")


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})

    with pytest.raises(RuntimeError):
        work_dir(Session(), "x")
