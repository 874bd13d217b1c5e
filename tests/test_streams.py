"""Streams over several deliveries: the hourly pulse, restarts, failures and their history."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from playlens.operators.expectations import LOG, save_expected
from playlens.operators.silver import clean
from playlens.sources import messages, tables
from playlens.streaming import bronze, pulse
from tests.conftest import EVENT, values


def deliver(folder, name, *changes):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({**EVENT, **c}) for c in changes]
    (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")


def at(hour, minute=0, **more):
    return {"event_id": f"{hour}:{minute}", "event_timestamp": f"2024-01-05T{hour:02}:{minute:02}:00",
            **more}


@pytest.fixture
def run(spark, base, tmp_path):
    def once(lateness="2 hours"):
        incoming = bronze.message_source(spark, "text", str(tmp_path / "in"))
        events = clean(messages.readable(messages.decode(incoming)))
        pulse.pulse_available(events, f"{base}/pulse", f"{base}/checkpoint", f"{base}/log",
                              lateness=lateness)
        hours = spark.read.parquet(f"{base}/pulse").withColumn(
            "event_hour_start", F.hour("event_hour_start"))
        late = spark.read.parquet(f"{base}/log").agg(F.sum("late_rows")).first()[0]
        return values(hours), late
    return once


def test_an_hour_is_written_once_when_the_watermark_has_passed_it(run, tmp_path):
    incoming = tmp_path / "in"
    deliver(incoming, "a", at(10, 5, user_id="a", is_completed=1), at(10, 6, user_id="a"),
            at(10, 7, user_id="b"), at(10, 8, user_id=None), at(12, 59, user_id="b"))
    assert run() == ([], 0)
    # The watermark is 10:59: a timely row and copies of known ones.
    deliver(incoming, "b", at(11, 30, user_id="c"), at(12, 59, user_id="b"), at(13, 0))
    assert run() == ([(10, 4, 1, 2)], 0)
    # 11:00 by now: too late for 10:30, in time for 11:45.
    deliver(incoming, "c", at(10, 30), at(11, 45, user_id="c"), at(16, 1))
    done, late = run()
    assert done == [(10, 4, 1, 2), (11, 2, 0, 1), (12, 1, 0, 1), (13, 1, 0, 1)] and late == 1
    assert run()[0] == done


def test_unreadable_times_are_in_no_hour(run, tmp_path):
    deliver(tmp_path / "in", "a", at(10), {"event_id": "x", "event_timestamp": "never"},
            at(10, 5, is_completed=None), at(20))
    assert run()[0] == [(10, 2, 0, 1)]


def test_state_is_dropped_behind_the_watermark(spark, base, run, tmp_path):
    for day in range(1, 7):
        deliver(tmp_path / "in", f"d{day}", *[
            {"event_id": f"{day} {i}", "user_id": f"u{i}",
             "event_timestamp": f"2024-01-0{day}T{i % 24:02}:00:00"} for i in range(48)])
        run()
    held = spark.read.schema(bronze.PROGRESS).parquet(f"{base}/log").agg(
        F.max_by("state_rows", "batch_id")).first()[0]
    assert 0 < held < 48


def test_a_failed_batch_is_done_again_and_no_row_twice(spark, base, tmp_path):
    incoming, table, checkpoint = tmp_path / "in", f"{base}/table", f"{base}/checkpoint"
    for i in range(4):
        deliver(incoming, f"m{i}", *[{"event_id": f"{i} {j}"} for j in range(5)])

    def source(broken):
        rows = bronze.message_source(spark, "text", str(incoming), maxFilesPerTrigger=1)
        bad = F.col("body").cast("string").contains('"2 3"') if broken else F.lit(False)
        return rows.select(F.when(bad, F.raise_error(F.lit("down"))).otherwise(
            F.col("body")).alias("body"))

    with pytest.raises(PySparkException):
        bronze.ingest_available(source(True), table, checkpoint, log=f"{base}/log")
    stored = spark.read.parquet(table).count()
    assert stored % 5 == 0 and stored < 20
    bronze.ingest_available(source(False), table, checkpoint, log=f"{base}/log")
    ids = [r.event_id for r in spark.read.parquet(table).collect()]
    assert sorted(ids) == sorted(f"{i} {j}" for i in range(4) for j in range(5))
    history = bronze.stream_history(spark, f"{base}/log").collect()
    assert sum(r.input_rows for r in history) == 20 - stored


def test_all_batches_are_followed(spark, base, tmp_path):
    """More batches than Spark remembers."""
    incoming = tmp_path / "in"
    for i in range(12):
        deliver(incoming, f"m{i:02}", {"event_id": str(i)})
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 5)
    try:
        rows = bronze.message_source(spark, "text", str(incoming), maxFilesPerTrigger=1)
        query = bronze.start_ingest(rows, f"{base}/t", f"{base}/c", trigger={"availableNow": True})
        progress = bronze.followed(query, every=0.05)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    table = bronze.progress_rows(spark, progress)
    assert values(table.select("batch_id", "input_rows")) == sorted(
        [(i, 1) for i in range(12)], key=repr)
    assert {(r.late_rows, r.state_rows, r.watermark) for r in table.collect()} == {(0, 0, None)}


def test_history_over_runs(spark, base, tmp_path):
    for i in range(3):
        deliver(tmp_path / "in", f"m{i}", *[{"event_id": f"{i} {j}"} for j in range(i + 1)])
        bronze.ingest_available(bronze.message_source(spark, "text", str(tmp_path / "in")),
                                f"{base}/t", f"{base}/c", log=f"{base}/log")
    rows = bronze.stream_history(spark, f"{base}/log").orderBy("first_batch").collect()
    assert [(r.first_batch, r.last_batch, r.batches, r.input_rows) for r in rows] == [
        (0, 0, 1, 1), (1, 1, 1, 2), (2, 2, 1, 3)]
    assert len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 3


def test_expectations_are_counted_while_the_table_is_written(spark, base):
    rules = {"known": "x IS NOT NULL", "small": "x < 3"}
    log = f"{base}/log"
    for n in (5, 2, 0):
        rows = spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup()
        table, outcome = save_expected(rows, rules, f"{base}/t", "numbers", log)
        written = set(spark.sparkContext.statusTracker().getJobIdsForGroup()) - set(jobs)
        assert len(written) <= 2  # the table, and the log
        assert values(table) == [(x,) for x in (1, 2) if x < n]
    none, outcome = save_expected(rows.limit(0), rules, f"{base}/t", "none")
    assert none.count() == 0 and {(r.seen_rows, r.kept_rows) for r in outcome.collect()} == {(0, 0)}
    assert outcome.schema.simpleString() == spark.createDataFrame([], LOG).schema.simpleString()
    got = values(spark.read.parquet(log).drop("loaded_at"))
    assert got == sorted([("numbers", "known", 1, 5, 2), ("numbers", "small", 3, 5, 2),
                          ("numbers", "known", 1, 2, 1), ("numbers", "small", 1, 2, 1),
                          ("numbers", "known", 0, 0, 0), ("numbers", "small", 0, 0, 0)], key=repr)


def test_fallback_is_for_catalogs_only(spark, base):
    tables.write_table(spark.range(3), f"{base}/a")
    (file,) = spark.read.parquet(f"{base}/a").limit(1).select("_metadata.file_path").first()
    for database, place in (("no_catalog.db", None), ("a b", None), ("tests_nowhere", f"{file}/x")):
        assert tables.registered_or_path(spark, database, "t", f"{base}/a", location=place).count() == 3
    with pytest.raises(PySparkException):  # no such files either
        tables.registered_or_path(spark, "no_catalog.db", "t", f"{base}/none")
    with pytest.raises(AttributeError):
        tables.registered_or_path(None, "db", "t", f"{base}/a")
