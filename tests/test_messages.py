import json

from pyspark.sql import functions as F

from playlens import schemas
from playlens.operators.silver import build_silver
from playlens.sources import messages, sample, tables
from playlens.streaming import bronze
from tests.conftest import EVENT, SAMPLE, plan, values


def test_encode_then_decode_gives_the_same_rows(spark):
    records = sample.watch_records(spark, SAMPLE)
    sent = messages.encode(records).select(F.col("value").cast("binary").alias("body"))
    assert values(messages.readable(messages.decode(sent))) == values(records)


def test_bad_messages_are_kept_apart(spark):
    good = json.dumps(EVENT)
    frame = spark.createDataFrame([(good,), ("{not json",), ('{"event_hour": "x"}',)],
                                  "body string")
    decoded = messages.decode(frame)
    assert [r.event_id for r in messages.readable(decoded).collect()] == ["e1"]
    assert values(messages.unreadable(decoded)) == [('{"event_hour": "x"}',), ("{not json",)]


def test_narrow_schema_reads_three_fields_only(spark):
    frame = spark.createDataFrame([(json.dumps(EVENT),)], "body string")
    row = messages.readable(messages.decode(frame, schemas.NARROW_STREAM_EVENT)).first()
    assert tuple(row) == ("e1", "u-1", "c-1", None, None, None)


def test_one_bad_field_does_not_lose_the_message(spark):
    odd = json.dumps({**EVENT, "total_duration_mins": 45.5})
    frame = spark.createDataFrame([(odd,), (json.dumps(EVENT),), ("{x",), (None,)], "body string")
    decoded = messages.decode(frame)
    rows = messages.readable(decoded).filter("event_id IS NOT NULL")
    assert values(rows, "event_id", "completion_pct", "total_duration_mins") == [
        ("e1", 50.0, 90), ("e1", 50.0, None)]
    assert values(messages.rejected(decoded)) == [
        ("empty", 1), ("partly_readable", 1), ("unreadable", 1)]
    assert build_silver(messages.ingest(frame)).filter("event_id = 'e1'").count() == 1


def test_each_message_is_parsed_once(spark):
    frame = spark.createDataFrame([(json.dumps(EVENT),)], "body string")
    assert plan(messages.readable(messages.decode(frame))).count("from_json") == 1


def test_publish_sends_everything(spark, base):
    frame = spark.createDataFrame([("a", "x" * 5), ("b", "x" * 1_100_000), ("c", None)],
                                  "key string, value string")
    done = messages.publish(frame, "parquet", path=f"{base}/out")
    assert done == {"status": "complete", "success_count": 3, "failed_count": 0}
    assert sorted(r.key for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b", "c"]


def test_publish_of_nothing(spark, base):
    frame = spark.createDataFrame([("a", "x")], "key string, value string").limit(0)
    assert messages.publish(frame, "parquet", path=f"{base}/out")["success_count"] == 0


def test_publish_keeps_what_a_sink_refuses(spark, base):
    frame = spark.createDataFrame([("a", "x" * 5), ("b", "x" * 50), ("c", None)],
                                  "key string, value string")
    done = messages.publish(frame, "parquet", max_bytes=10, rejects=f"{base}/rejects",
                            path=f"{base}/out")
    assert done == {"status": "complete", "success_count": 1, "failed_count": 2}
    assert [r.key for r in spark.read.parquet(f"{base}/out").collect()] == ["a"]
    assert sorted(r.key for r in spark.read.parquet(f"{base}/rejects").collect()) == ["b", "c"]


def test_json_array_and_json_lines(spark, base, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([EVENT, {**EVENT, "event_id": "e2"}],
                                                    indent=2))
    array = tables.scan_json(spark, f"{base}/array.json", schemas.WATCH_EVENT, array=True)
    array.write.json(f"{base}/lines")
    lines = tables.scan_json(spark, f"{base}/lines", schemas.WATCH_EVENT)
    assert values(array) == values(lines)
    assert [r.event_id for r in array.orderBy("event_id").collect()] == ["e1", "e2"]


def _deliver(records, folder):
    messages.encode(records).select("value").write.mode("append").text(folder)


def test_stream_restart_adds_only_new_rows(spark, base, events):
    incoming, table, checkpoint = f"{base}/in", f"{base}/table", f"{base}/checkpoint"

    def run():
        source = bronze.message_source(spark, "text", incoming)
        query = bronze.ingest_available(source, table, checkpoint)
        return bronze.status(query), spark.read.parquet(table).count()

    _deliver(events({}, {"event_id": "x"}), incoming)
    state, count = run()
    assert count == 2 and not state["active"] and state["last_batch"] == 0
    assert run()[1] == 2
    _deliver(events({"event_id": "late"}), incoming)
    assert run()[1] == 3
    assert sorted(r.event_id for r in spark.read.parquet(table).collect()) == ["e0", "late", "x"]


def test_stream_keeps_bad_messages_in_the_raw_layer(spark, base, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text(json.dumps(EVENT) + "\n{broken\n")
    bronze.ingest_available(bronze.message_source(spark, "text", f"{base}/in"),
                            f"{base}/table", f"{base}/checkpoint")
    raw = spark.read.parquet(f"{base}/table")
    assert raw.count() == 2
    assert values(messages.unreadable(raw)) == [("{broken",)]
    silver = build_silver(messages.combine(
        messages.stamp(messages.readable(raw).drop("ingested_at", "source"), messages.BULK), raw))
    assert [r.event_id for r in silver.collect()] == ["e1"]


def test_bulk_keeps_bad_records(spark, base, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps(EVENT) + "\n{broken\n")
    rows = tables.scan_json(spark, f"{base}/h.json", schemas.WATCH_EVENT, corrupt=messages.CORRUPT)
    stored = tables.write_table(rows, f"{base}/t")
    assert values(messages.unreadable(stored)) == [("{broken",)]
    assert [r.event_id for r in messages.readable(stored).collect()] == ["e1"]


def test_stream_and_batch_parse_alike(spark, base):
    _deliver(sample.watch_records(spark, SAMPLE), f"{base}/in")
    source = bronze.message_source(spark, "text", f"{base}/in")
    bronze.ingest_available(source, f"{base}/table", f"{base}/checkpoint")
    batch = messages.ingest(spark.read.text(f"{base}/in"), body="value")
    columns = [*schemas.WATCH_EVENT.names, "source"]
    assert values(spark.read.parquet(f"{base}/table"), *columns) == values(batch, *columns)
