"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Reports are built from the sample events directly, with only the joins they need;
``event_id`` is the key of that table, so they skip the deduplication, which has
queries of its own. Load times and generated ids are left out of the results.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens import schemas
from playlens.functions import features
from playlens.operators import dims, quality
from playlens.operators.expectations import expect_or_drop, failures, save_expected
from playlens.operators.fact import build_fact
from playlens.operators.keys import dense_keys, new_keys
from playlens.operators.silver import build_silver, clean, deduplicate, summary
from playlens.plans import checks, gold, pipeline, reports, star
from playlens.plans.pipeline import DIMENSIONS
from playlens.session import kept, work_dir
from playlens.sources import messages, sample, tables
from playlens.streaming import bronze as stream
from playlens.streaming import pulse

# Report arguments that select rows of the sample data.
GENRE, REGION = "ECONOMY", "ASIA"
RANGE = ("2024-01-05", "2024-01-12")
BULK_LOADED_AT = "2024-01-16 00:00:00"
# How the history arrays and messages of a filled lake are compressed; as text they are the most
# that its load writes. Files of messages are read whole then, a task each.
SENT = "lz4"

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


# ---- inputs ---------------------------------------------------------------------

def silver(spark, sf_dir, **parts):
    return clean(sample.watch_events(spark, sf_dir, **parts))


def fact(spark, sf_dir, place=False):
    """The fact; its city needs a join, so it is there only with ``place``."""
    columns = [c for c in schemas.FACT if place or c != "city"]
    return build_fact(silver(spark, sf_dir, place=place), columns)


def bronze(spark, sf_dir, content=False, place=False):
    """Every event twice: in the history load of 16 January and, five seconds after it
    happened, from the stream. The stream has each tenth event a second time in the same
    load, with another action."""
    events = sample.watch_events(spark, sf_dir, content, place)
    ts = F.col("event_timestamp")
    loaded = F.lit(BULK_LOADED_AT).cast(events.schema["event_timestamp"].dataType)
    bulk = messages.stamp(events, messages.BULK, loaded)
    again = events.filter("cast(event_id AS bigint) % 10 = 0").withColumn(
        "action", F.expr("concat('again ', action)"))
    live = messages.stamp(events.unionByName(again), messages.STREAM,
                          ts + F.make_dt_interval(secs=F.lit(5)))
    return messages.combine(bulk, live)


def content_dim(spark, sf_dir):
    return dims.dim_content(clean(sample.seen_contents(spark, sf_dir)))


def location_dim(spark, sf_dir):
    return dims.dim_locations(clean(sample.seen_places(spark, sf_dir)))


def report(name, spark, sf_dir):
    chosen = {r.name: r for r in reports.configured(GENRE, REGION)}[name]
    sources = {
        "fact_watch_events": lambda: fact(spark, sf_dir, "dim_locations" in chosen.tables),
        "dim_content": lambda: content_dim(spark, sf_dir),
        "dim_locations": lambda: location_dim(spark, sf_dir),
    }
    return chosen.build({t: sources[t]() for t in chosen.tables})


def doubles(df):
    """Decimal columns as doubles, the common type for comparing results."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema.fields
                           if isinstance(f.dataType, T.DecimalType)})


# ---- sources and sinks ----------------------------------------------------------

@query
def scan_table(spark, sf_dir):
    return tables.scan_table(spark, f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")


@query
def scan_json_bulk(spark, sf_dir):
    path = work_dir(spark, "scan_json_bulk")
    sample.watch_records(spark, sf_dir).write.json(path)
    return doubles(tables.scan_json(spark, path, schemas.WATCH_EVENT))


@query
def bronze_stamp(spark, sf_dir):
    events = sample.watch_events(spark, sf_dir).select("event_id", "user_id", "action")
    stamped = messages.stamp(events, messages.BULK)
    return stamped.withColumn("is_stamped", F.col("ingested_at").isNotNull()).drop("ingested_at")


@query
def write_overwrite(spark, sf_dir):
    path = work_dir(spark, "write_overwrite")
    wide = silver(spark, sf_dir)
    tables.write_table(wide.select("event_id", "device_type"), path)
    return doubles(tables.write_table(
        wide.select("event_id", "user_id", "completion_pct", "completion_category"), path))


@query
def save_gold(spark, sf_dir):
    rows = build_fact(silver(spark, sf_dir, place=True), stamped=True)
    saved = tables.save_gold(rows, work_dir(spark, "save_gold"), "fact_watch_events",
                             partition_by=("event_date",))
    keys = quality.duplicates(saved, ["fact_key"])
    return keys.withColumnsRenamed({"distinct_keys": "distinct_fact_keys"})


@query
def register_table(spark, sf_dir):
    base = work_dir(spark, "register_table")
    tables.write_table(silver(spark, sf_dir).select("event_id", "device_type", "is_completed"),
                       f"{base}/watch_obt")
    return tables.register_table(spark, "playlens_bronze", "watch_obt", f"{base}/watch_obt",
                                 location=f"{base}/catalog")


@query
def preview(spark, sf_dir):
    rows = silver(spark, sf_dir).select("event_id", "user_id", "device_type",
                                        "completion_category")
    return tables.preview(rows, "event_id")


@query
def encode_events(spark, sf_dir):
    return messages.encode(sample.watch_records(spark, sf_dir))


@query
def json_parse(spark, sf_dir):
    sent = messages.encode(sample.watch_records(spark, sf_dir)).select(
        F.col("value").cast("binary").alias("body"))
    return doubles(messages.readable(messages.decode(sent)))


@query
def bronze_union(spark, sf_dir):
    return bronze(spark, sf_dir).groupBy("source").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("event_id").alias("event_count"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"))


@query
def stream_bronze(spark, sf_dir):
    base = work_dir(spark, "stream_bronze")
    messages.encode(sample.watch_records(spark, sf_dir)).select("value").write.text(
        f"{base}/incoming")
    incoming = stream.message_source(spark, "text", f"{base}/incoming")
    stream.ingest_available(incoming, f"{base}/stream_events", f"{base}/checkpoint")
    stored = spark.read.parquet(f"{base}/stream_events")
    return doubles(messages.readable(stored).drop("ingested_at"))


@query
def path_fallback(spark, sf_dir):
    """A table whose database can't be made: its folder would lie below a file."""
    base = work_dir(spark, "path_fallback")
    rows = silver(spark, sf_dir).select("event_id", "device_type", "is_completed")
    tables.write_table(rows, f"{base}/watch_obt")
    file = spark.read.parquet(f"{base}/watch_obt").select("_metadata.file_path").first()[0]
    return tables.registered_or_path(spark, "playlens_nowhere", "watch_obt", f"{base}/watch_obt",
                                     location=f"{file}/catalog")


def deliver(records, folder):
    """Sends records as a text file per task into a folder that a stream reads."""
    messages.publish(messages.encode(records), "text", path=folder)


@query
def stream_restarts(spark, sf_dir):
    """Three deliveries to one stream that is started anew for each, a file per batch."""
    base = work_dir(spark, "stream_restarts")
    records = sample.watch_records(spark, sf_dir)
    third = F.expr("cast(event_id AS bigint) % 3")
    for number in range(3):
        deliver(records.filter(third == number).repartition(4), f"{base}/incoming")
        incoming = stream.message_source(spark, "text", f"{base}/incoming", maxFilesPerTrigger=1)
        stream.ingest_available(incoming, f"{base}/stream_events", f"{base}/checkpoint",
                                log=f"{base}/progress")
    runs = stream.stream_history(spark, f"{base}/progress").withColumn("delivery", (
        F.row_number().over(Window.orderBy("first_batch")) - 1).cast("long"))  # three rows
    rows = messages.readable(spark.read.parquet(f"{base}/stream_events")).groupBy(
        third.alias("delivery")).agg(F.count("*").alias("stored_rows"),
                                     F.countDistinct("event_id").alias("stored_events"))
    return runs.join(rows, "delivery").select(
        "delivery", F.col("input_rows").alias("read_rows"), "stored_rows", "stored_events",
        (F.col("batches") == 4).alias("four_batches"))


@query
def stream_status(spark, sf_dir):
    """The history of a stream that ran twice: its batches by number, with their rows."""
    base = work_dir(spark, "stream_status")
    records = sample.watch_records(spark, sf_dir)
    again = F.expr("cast(event_id AS bigint) % 4 = 0")
    for part in (records, records.filter(again)):
        deliver(part, f"{base}/incoming")
        incoming = stream.message_source(spark, "text", f"{base}/incoming")
        stream.ingest_available(incoming, f"{base}/stream_events", f"{base}/checkpoint",
                                log=f"{base}/progress")
    return spark.read.schema(stream.PROGRESS).parquet(f"{base}/progress").select(
        "batch_id", "input_rows", "late_rows", "state_rows",
        (F.col("duration_ms") > 0).alias("timed"),
        (F.count("*").over(Window.partitionBy("run_id")) == 1).alias("own_run"))


# ---- silver ---------------------------------------------------------------------

#: Load times of the deliveries of ``two_loads``: an early copy, the first load, the second.
EARLY, FIRST, SECOND = "2024-01-31 00:00:00", "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def two_loads(spark, sf_dir):
    """The raw rows of two loads. The first lacks every fifth event of the 20th and 21st. The second
    brings these, copies of events of the 25th that change nothing, and of the 27th copies
    that were made before the first load and so replace the stored ones."""
    events = sample.watch_events(spark, sf_dir, content=True, place=True)
    day, fifth = F.dayofmonth("event_timestamp"), F.expr("cast(event_id AS bigint) % 5")
    held = day.isin(20, 21) & (fifth == 1)

    def loaded(rows, at):
        return messages.stamp(rows, messages.STREAM, F.lit(at).cast("timestamp"))

    copies = events.filter(fifth == 2).withColumn("action", F.expr("concat('again ', action)"))
    second = loaded(events.filter(held), SECOND).unionByName(
        loaded(copies.filter(day == 25), SECOND)).unionByName(
        loaded(copies.filter(day == 27), EARLY))
    return loaded(events.filter(~held), FIRST), second


@query
def silver_increment(spark, sf_dir):
    """A second load of silver: rows a day, replaced ones, and whether a day kept its files."""
    lake = pipeline.Lake(work_dir(spark, "silver_increment"))

    def files(table):
        return kept(table.select("event_date", "_metadata.file_path").distinct())

    first, second = two_loads(spark, sf_dir)
    before = files(pipeline.load_silver(first, None, lake))
    table, _ = pipeline.refresh_silver(second, lake)
    same = before.unionAll(files(table)).groupBy("event_date", "file_path").count().groupBy(
        "event_date").agg((F.min("count") == 2).alias("files_stay"))
    rows = table.groupBy("event_date").agg(
        F.count("*").alias("events"), F.count_if(F.col("action").startswith("again")).alias(
            "replaced"))
    return rows.join(same, "event_date")


@query
def project(spark, sf_dir):
    return silver(spark, sf_dir).select("event_id", "user_id", "content_id", "device_type")


@query
def event_features(spark, sf_dir):
    events = sample.read(spark, sf_dir, "events")
    pct = features.completion_pct("value", "100")
    return events.select(
        "event_id", *[e.alias(n) for n, e in features.calendar_features("ts").items()],
        pct.alias("completion_pct"),
    ).withColumns({
        "is_completed": features.is_completed("completion_pct"),
        "is_dropped": features.is_dropped("completion_pct"),
        "completion_pct": F.col("completion_pct").cast("double"),
    })


@query
def completion_category(spark, sf_dir):
    return silver(spark, sf_dir).select("event_id", "completion_category")


@query
def device_category(spark, sf_dir):
    return silver(spark, sf_dir).select("event_id", "device_type", "device_category")


@query
def dedupe_event_id(spark, sf_dir):
    return deduplicate(bronze(spark, sf_dir)).select(
        "event_id", "event_timestamp", "user_id", "action", "source", "ingested_at")


@query
def silver_obt(spark, sf_dir):
    events = build_silver(bronze(spark, sf_dir, content=True, place=True))
    return doubles(events.drop("silver_timestamp", "ingested_at"))


@query
def silver_summary(spark, sf_dir):
    return summary(silver(spark, sf_dir))


@query
def top_titles(spark, sf_dir):
    known = clean(sample.seen_contents(spark, sf_dir)).distinct()
    return tables.most_frequent_of(silver(spark, sf_dir), "content_id", known, "content_title", 5)


@query
def top_cities(spark, sf_dir):
    places = sample.places(spark, sf_dir).withColumn("user_id", F.expr("string(user_no)"))
    return tables.most_frequent_of(silver(spark, sf_dir), "user_id", places, "city", 5)


@query
def device_breakdown(spark, sf_dir):
    return tables.most_frequent(silver(spark, sf_dir), "device_type")


# ---- star schema ----------------------------------------------------------------

@query
def dim_content(spark, sf_dir):
    return content_dim(spark, sf_dir)


@query
def dim_users(spark, sf_dir):
    return dims.dim_users(silver(spark, sf_dir))


@query
def dim_devices(spark, sf_dir):
    return dims.dim_devices(silver(spark, sf_dir))


@query
def dim_locations(spark, sf_dir):
    return location_dim(spark, sf_dir)


@query
def dim_date(spark, sf_dir):
    return dims.dim_date(silver(spark, sf_dir))


@query
def dim_keys(spark, sf_dir):
    built = {
        "dim_content": content_dim(spark, sf_dir),
        "dim_users": dim_users(spark, sf_dir),
        "dim_devices": dim_devices(spark, sf_dir),
        "dim_locations": location_dim(spark, sf_dir),
        "dim_date": dim_date(spark, sf_dir),
    }

    def keyed(name):
        _, natural, _ = DIMENSIONS[name]
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in natural])
        # A first load of the rows that sort before "M", then one of all: old keys stay.
        early = text < "M"
        first = dense_keys(built[name].filter(early), natural, "dim_key")
        both = first.unionByName(new_keys(built[name], first, natural, "dim_key"))
        return both.select(F.lit(name).alias("dim"), text.alias("natural_key"), "dim_key")

    # Writing the sorted rows of each takes jobs; they do not wait for each other.
    found = pipeline.side_by_side(dict.fromkeys(DIMENSIONS, keyed))
    return reduce(DataFrame.unionByName, found.values())


@query
def fact_watch_events(spark, sf_dir):
    return doubles(fact(spark, sf_dir, place=True))


@query
def fact_keys_over_loads(spark, sf_dir):
    """Fact keys after a second load: kept for known events, above all others for new ones."""
    lake = pipeline.Lake(work_dir(spark, "fact_keys_over_loads"))
    first, second = two_loads(spark, sf_dir)
    before = kept(pipeline.load_increment(first, lake)["fact_watch_events"].select(
        "event_id", F.col("fact_key").alias("old_key")))
    after = pipeline.load_increment(second, lake)["fact_watch_events"]
    top = before.agg(F.max("old_key")).scalar()
    keys = after.select("event_id", "event_date", "fact_key").join(before, "event_id", "left")
    return keys.groupBy("event_date").agg(
        F.count("*").alias("events"), F.countDistinct("fact_key").alias("distinct_keys"),
        F.count_if(F.col("fact_key") == F.col("old_key")).alias("kept_keys"),
        F.count_if(F.col("old_key").isNull() & (F.col("fact_key") > top)).alias("new_keys"))


@query
def star_genre_views(spark, sf_dir):
    return star.genre_views(fact(spark, sf_dir), content_dim(spark, sf_dir))


@query
def star_revenue_by_plan_literal(spark, sf_dir):
    return star.revenue_by_plan_literal(fact(spark, sf_dir), dim_users(spark, sf_dir))


@query
def star_revenue_by_plan(spark, sf_dir):
    return star.revenue_by_plan(fact(spark, sf_dir), dim_users(spark, sf_dir))


@query
def doc_top_content(spark, sf_dir):
    return star.top_content(fact(spark, sf_dir), content_dim(spark, sf_dir))


@query
def doc_prime_time(spark, sf_dir):
    return star.prime_time(fact(spark, sf_dir))


# ---- quality --------------------------------------------------------------------

RULES = {
    **dims.CONTENT_RULES, **dims.USER_RULES, **dims.CITY_RULES,
    "valid_completion": "completion_pct BETWEEN 0 AND 100",
}


@query
def dq_profile(spark, sf_dir):
    raw = bronze(spark, sf_dir)
    found, _ = quality.profile_layers({
        "bronze_bulk": (lambda: raw.filter(F.col("source") == messages.BULK), ["event_id"]),
        "bronze_stream": (lambda: raw.filter(F.col("source") == messages.STREAM), ["event_id"]),
        "bronze": (lambda: raw, ["event_id"]),
        "silver": (lambda: clean(deduplicate(raw)), ["event_id"]),
        "fact": (lambda: fact(spark, sf_dir), ["event_id"]),
    })
    return found


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(bronze(spark, sf_dir), ["user_id", "content_id"])


@query
def dq_null_counts(spark, sf_dir):
    """Null counts of messages read with the narrow schema: three fields are never sent."""
    sent = messages.encode(sample.watch_records(spark, sf_dir))
    narrow = messages.decode(sent, schemas.NARROW_STREAM_EVENT, "value")
    return quality.null_counts(messages.readable(narrow))


@query
def dq_range_stats(spark, sf_dir):
    return quality.range_stats(silver(spark, sf_dir))


@query
def dq_range(spark, sf_dir):
    return quality.invalid_counts(silver(spark, sf_dir))


def odd_messages(spark, sf_dir):
    """A message per event: each seventh with a completion beyond the range, each eleventh cut
    off, each thirteenth with a fraction where a whole number belongs, each seventeenth with
    a time that is none."""
    records = sample.watch_records(spark, sf_dir)
    n = F.expr("cast(event_id AS bigint)")
    odd = records.withColumns({
        "completion_pct": F.when(n % 7 == 0, F.element_at(F.array(
            *[F.lit(x) for x in (1e12, float("inf"), float("nan"), 150.0)]),
            (F.floor(n / 7) % 4 + 1).cast("int"))).otherwise(F.col("completion_pct")),
        "event_timestamp": F.when(n % 17 == 0, F.lit("no time")).otherwise(
            F.col("event_timestamp")),
    })
    return messages.encode(odd).select("key", F.expr("""
        CASE WHEN cast(key AS bigint) % 11 = 0 THEN substr(value, 1, 40)
             WHEN cast(key AS bigint) % 13 = 0
             THEN replace(value, '"total_duration_mins":100', '"total_duration_mins":45.5')
             ELSE value END AS value"""))


@query
def rejected_messages(spark, sf_dir):
    """Messages of which nothing, or not all, was read."""
    return messages.rejected(messages.decode(odd_messages(spark, sf_dir), body="value"))


@query
def dq_range_of_messages(spark, sf_dir):
    """Range checks and unreadable times of messages with any number in them."""
    rows = clean(messages.readable(messages.decode(odd_messages(spark, sf_dir), body="value")))
    invalid = quality.invalid_counts(rows)
    unread = rows.agg(F.count_if(F.col("event_timestamp").isNull()).alias("no_time"),
                      F.count_if(F.col("total_duration_mins").isNull()).alias("no_duration"))
    return reduce(DataFrame.unionByName, [df.unpivot([], df.columns, "check", "row_count")
                                          for df in (invalid, unread)])


@query
def publish_counts(spark, sf_dir):
    """What was sent, and what arrived; one body is above 1 MiB."""
    path = work_dir(spark, "publish_counts")
    sent = messages.encode(sample.watch_records(spark, sf_dir)).withColumn("value", F.when(
        F.col("key") == "0", F.repeat(F.lit("x"), 1_100_000)).otherwise(F.col("value")))
    done = messages.publish(sent, "parquet", path=path)
    stored = spark.read.parquet(path)
    return stored.agg(
        F.lit(done["success_count"]).alias("success_count"),
        F.lit(done["failed_count"]).alias("failed_count"), F.count("*").alias("stored"),
        F.max(F.octet_length("value")).alias("largest"))


@query
def dq_dist_completion(spark, sf_dir):
    return quality.distribution(silver(spark, sf_dir), "completion_category")


@query
def dq_dist_time_of_day(spark, sf_dir):
    return quality.distribution(silver(spark, sf_dir), "time_of_day")


def _orphans(rows, key, checks):
    return reduce(DataFrame.unionByName, [
        quality.orphans(rows, dim, key).select(F.lit(name).alias("dimension"), "*")
        for name, dim in checks.items()])


@query
def dq_orphan_content(spark, sf_dir):
    dim = content_dim(spark, sf_dir)
    return _orphans(fact(spark, sf_dir), "content_id", {
        "dim_content": dim, "movies": dim.filter(F.col("content_type") == "Movie")})


@query
def dq_orphan_city(spark, sf_dir):
    dim = location_dim(spark, sf_dir)
    return _orphans(fact(spark, sf_dir, place=True), "city", {
        "dim_locations": dim, "one_region": dim.filter(F.col("region") == REGION)})


@query
def dq_orphan_device(spark, sf_dir):
    dim = dims.dim_devices(silver(spark, sf_dir))
    return _orphans(fact(spark, sf_dir), "device_type", {
        "dim_devices": dim, "mobile": dim.filter(F.col("device_category") == "MOBILE")})


@query
def dq_cross_layer(spark, sf_dir):
    raw = bronze(spark, sf_dir)
    cleaned = clean(deduplicate(raw))
    valid = expect_or_drop(cleaned, {"valid_completion": RULES["valid_completion"]})
    return quality.layer_loss(raw, cleaned, build_fact(valid, ["event_id"]))


def _ruled(spark, sf_dir):
    return silver(spark, sf_dir, content=True, place=True)


@query
def expect_or_drop_query(spark, sf_dir):
    return expect_or_drop(_ruled(spark, sf_dir), RULES).select("event_id", "content_id")


@query
def expect_or_drop_failures(spark, sf_dir):
    return failures(_ruled(spark, sf_dir), RULES)


@query
def expect_or_drop_counted(spark, sf_dir):
    """The log of a load under rules, counted while it was written, and what it wrote."""
    base = work_dir(spark, "expect_or_drop_counted")
    table, _ = save_expected(_ruled(spark, sf_dir), RULES, f"{base}/events", "events",
                             log=f"{base}/expectations")
    stored = table.agg(F.count("*")).scalar()
    return spark.read.parquet(f"{base}/expectations").select(
        "dataset", "rule", "failed_rows", "seen_rows", "kept_rows",
        stored.alias("stored_rows"))


@query
def dq_stored_layers(spark, sf_dir):
    """The quality run over a lake's files before its first message, so one layer is missing."""
    base = work_dir(spark, "dq_stored_layers")
    lake = pipeline.Lake(base)
    sample.watch_records(spark, sf_dir).write.json(f"{base}/history")
    history = tables.scan_json(spark, f"{base}/history", schemas.WATCH_EVENT)
    pipeline.load_gold(pipeline.load_silver(
        pipeline.load_bronze_bulk(history, lake), None, lake), lake)
    found = checks.check_lake(spark, lake)

    def listed(check, frame, item, value):
        return frame.select(F.lit(check).alias("check"), F.expr(item).alias("item"),
                            F.expr(value).cast("long").alias("value"))

    invalid = found.invalid.unpivot([], found.invalid.columns, "item", "value")
    missing = spark.createDataFrame([(name,) for name in found.missing], "name string")
    return reduce(DataFrame.unionByName, [
        listed("rows", found.profile, "table_name", "total_rows"),
        listed("duplicates", found.profile, "table_name", "duplicates"),
        listed("nulls", found.nulls["watch_obt"].filter("null_count > 0"), "column_name",
               "null_count"),
        listed("invalid", invalid, "item", "value"),
        listed("completion", found.completion, "completion_category", "count"),
        listed("time_of_day", found.time_of_day, "time_of_day", "count"),
        listed("orphans", found.orphans, "dimension", "orphan_rows"),
        listed("loss", found.loss, "'events'", "bronze_events - silver_rows"),
        listed("rejected", found.rejected, "reason", "messages"),
        listed("missing", missing, "name", "1")])


# ---- reports --------------------------------------------------------------------

@query
def report_views_by_device(spark, sf_dir):
    return report("views_by_device", spark, sf_dir)


@query
def report_views_by_subscription(spark, sf_dir):
    return report("views_by_subscription", spark, sf_dir)


@query
def report_views_by_time_of_day(spark, sf_dir):
    return report("views_by_time_of_day", spark, sf_dir)


@query
def report_views_by_completion_category(spark, sf_dir):
    return report("views_by_completion_category", spark, sf_dir)


@query
def report_genre(spark, sf_dir):
    return report("economy_content_performance", spark, sf_dir)


@query
def report_all_content(spark, sf_dir):
    return report("all_content_performance", spark, sf_dir)


@query
def report_views_by_day_of_week(spark, sf_dir):
    return report("views_by_day_of_week", spark, sf_dir)


@query
def report_time_range(spark, sf_dir):
    return reports.time_analysis(fact(spark, sf_dir), "event_day", *RANGE)


@query
def report_region(spark, sf_dir):
    return report("asia_region_performance", spark, sf_dir)


@query
def report_all_location(spark, sf_dir):
    return report("all_location_performance", spark, sf_dir)


def filled_lake(spark, sf_dir):
    """A lake from files: history as JSON arrays and all events again as messages."""
    base = work_dir(spark, "lake")
    records = sample.watch_records(spark, sf_dir)
    arrays = records.groupBy(F.expr("cast(event_id AS bigint) div 10000").alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*records.columns))).alias("value"))  # 10,000 each
    arrays.write.partitionBy("part").text(f"{base}/history", compression=SENT)
    messages.publish(odd_messages(spark, sf_dir), "text", path=f"{base}/incoming", compression=SENT)
    lake = pipeline.Lake(base)
    bulk = pipeline.load_bronze_bulk(
        tables.scan_json(spark, f"{base}/history/*", schemas.WATCH_EVENT, array=True), lake)
    stream.ingest_available(stream.message_source(spark, "text", f"{base}/incoming"),
                            lake.stream_events, f"{base}/checkpoint")
    return lake, pipeline.load_silver(bulk, tables.scan_table(spark, lake.stream_events), lake)


@query
def views_by_device_end_to_end(spark, sf_dir):
    """History files and messages to raw tables, silver, gold, and a report on the stored fact."""
    lake, built = filled_lake(spark, sf_dir)
    pipeline.load_gold(built, lake)
    stored = tables.registered_or_path(spark, "playlens_gold", "fact_watch_events",
                                       f"{lake.gold}/fact_watch_events")
    return reports.aggregation(stored, "device_type", limit=10)


@query
def run_reports_status(spark, sf_dir):
    """The nine reports and one that fails when it runs, on a fact that is written once."""
    stored = tables.write_table(fact(spark, sf_dir, True), work_dir(spark, "run_reports"))
    sources = {"fact_watch_events": stored,
               "dim_content": content_dim(spark, sf_dir),
               "dim_locations": location_dim(spark, sf_dir)}
    failing = reports.Report("failing", lambda rows: rows.select(
        F.raise_error(F.lit("no report")).alias("views")))
    found = reports.run_reports([failing, *reports.configured(GENRE, REGION)], sources)
    return spark.createDataFrame(
        [(name, outcome.ok, outcome.frame.count() if outcome.ok else None)
         for name, outcome in found.items()], "report string, ok boolean, row_count long")


# ---- gold -----------------------------------------------------------------------

@query
def gold_content_performance(spark, sf_dir):
    return gold.content_performance(fact(spark, sf_dir), content_dim(spark, sf_dir))


@query
def gold_user_engagement(spark, sf_dir):
    return gold.user_engagement(silver(spark, sf_dir))


@query
def gold_device_analytics(spark, sf_dir):
    return gold.device_analytics(silver(spark, sf_dir))


@query
def gold_revenue_summary(spark, sf_dir):
    return gold.revenue_summary(silver(spark, sf_dir, place=True))


@query
def gold_hourly_pulse(spark, sf_dir):
    return gold.hourly_pulse(fact(spark, sf_dir))


@query
def gold_hourly_pulse_stream(spark, sf_dir):
    """The pulse as a stream over four deliveries: ten days each, with every tenth event a
    delivery late and every seventh sent a second time, a delivery later. Hours that the
    watermark, two days behind, has passed."""
    base = work_dir(spark, "gold_hourly_pulse_stream")
    n = F.expr("cast(event_id AS bigint)")
    records = sample.watch_records(spark, sf_dir)
    period = F.least(F.floor((F.dayofmonth(F.col("event_timestamp").cast("timestamp")) - 1) / 10),
                     F.lit(2))
    sent = period + F.when(n % 10 == 0, 1).otherwise(0)
    for number in range(4):
        due = (sent == number) | ((n % 7 == 0) & (sent == number - 1))
        deliver(records.filter(due), f"{base}/incoming")
        incoming = stream.message_source(spark, "text", f"{base}/incoming")
        events = clean(messages.readable(messages.decode(incoming)))
        pulse.pulse_available(events, f"{base}/pulse", f"{base}/checkpoint", lateness="2 days")
    return spark.read.parquet(f"{base}/pulse").withColumn(
        "event_hour_start", F.col("event_hour_start").cast("timestamp_ntz"))


@query
def gold_trending_content(spark, sf_dir):
    return gold.trending_content(fact(spark, sf_dir))
