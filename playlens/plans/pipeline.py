"""The layers end to end, each written before the next one reads it."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from playlens import schemas
from playlens.operators import dims
from playlens.operators.fact import build_fact, keyed_fact
from playlens.operators.keys import dense_keys, new_keys
from playlens.operators.silver import build_silver
from playlens.plans import gold
from playlens.session import observed, temporary_dir
from playlens.sources.messages import BULK, combine, stamp
from playlens.sources.tables import (in_partitions, not_there, replace_partitions, save_gold,
                                     scan_table, write_table)


@dataclass(frozen=True)
class Lake:
    """Table paths below one base folder."""

    base: str
    fmt: str = "parquet"

    @property
    def bulk_history(self):
        return f"{self.base}/bronze/bulk_history"

    @property
    def stream_events(self):
        return f"{self.base}/bronze/stream_events"

    @property
    def watch_obt(self):
        return f"{self.base}/silver/watch_obt"

    @property
    def gold(self):
        return f"{self.base}/gold"


# dimension -> (builder, natural key, surrogate key)
DIMENSIONS = {
    "dim_content": (dims.dim_content, schemas.DIM_CONTENT, "content_key"),
    "dim_users": (dims.dim_users, schemas.DIM_USERS, "user_key"),
    "dim_devices": (dims.dim_devices, schemas.DIM_DEVICES, "device_key"),
    "dim_locations": (dims.dim_locations, schemas.DIM_LOCATIONS, "location_key"),
    "dim_date": (dims.dim_date, ("date",), "date_key"),
}


_WITH_RULES = (dims.dim_content, dims.dim_users, dims.dim_locations)

# gold aggregate -> (builder, its tables)
AGGREGATES = {
    "gold_content_performance": (gold.content_performance, ("fact_watch_events", "dim_content")),
    "gold_user_engagement": (gold.user_engagement, ("silver",)),
    "gold_device_analytics": (gold.device_analytics, ("silver",)),
    "gold_revenue_summary": (gold.revenue_summary, ("silver",)),
    "gold_hourly_pulse": (gold.hourly_pulse, ("fact_watch_events",)),
    "gold_trending_content": (gold.trending_content, ("fact_watch_events",)),
}


def load_bronze_bulk(records, lake):
    """History records, stamped, into the raw layer."""
    return write_table(stamp(records, BULK), lake.bulk_history, lake.fmt)


def load_silver(bulk, stream, lake):
    """Bulk and stream rows combined, deduplicated and cleaned, stored by day.

    ``stream`` is None before the first message."""
    return write_table(build_silver(combine(bulk, stream)), lake.watch_obt, lake.fmt,
                       partition_by=("event_date",))


def side_by_side(builds):
    """``{name: build(name)}``, with the jobs of all running at the same time."""
    with ThreadPoolExecutor(len(builds)) as jobs:
        started = {name: jobs.submit(build, name) for name, build in builds.items()}
        return {name: job.result() for name, job in started.items()}


def _stored(spark, path, fmt):
    """A table as it is before this load, or None before the first."""
    try:
        return scan_table(spark, path, fmt)
    except AnalysisException as error:
        if not not_there(error):
            raise
        return None


def refresh_silver(rows, lake):
    """Take the raw rows of one load into the stored silver table; returns (silver, days).

    ``days`` are the days whose rows changed, and only their partitions are written. The table is
    that of a load of all raw rows, where loads differ in load time or source: of an event's
    copies the first by load time and source stays, be it the stored one or a new one, also when
    the other lies in another day. Without a stored table this is ``load_silver``, and ``days``
    is None for all.
    """
    spark = rows.sparkSession
    stored = _stored(spark, lake.watch_obt, lake.fmt)
    if stored is None:
        return load_silver(rows, None, lake), None
    with temporary_dir(spark, "silver_rows") as path:
        # Columns the stored table has and this load lacks are NULL.
        new = build_silver(rows)
        missing = {f.name: F.lit(None).cast(f.dataType) for f in stored.schema.fields
                   if f.name not in new.columns}
        new = write_table(new.withColumns(missing).select(*stored.columns), path)
        place = ("event_id", "event_date", "ingested_at", "source")
        met = new.alias("new").join(
            stored.select(*place, F.lit(True).alias("is_stored")).alias("old"),
            F.col("new.event_id").eqNullSafe(F.col("old.event_id")), "left")
        first = F.struct("new.ingested_at", "new.source") < F.struct("old.ingested_at", "old.source")
        won = met.filter(F.col("is_stored").isNull() | first).select(
            "new.*", F.col("is_stored").alias("_replaces"), F.col("old.event_date").alias("_left"))
        with temporary_dir(spark, "silver_changes") as changes:
            won = write_table(won, changes)
            goes = won.filter("_replaces").select("event_id", F.col("_left").alias("event_date"))
            days = [r.event_date for r in won.select("event_date").unionAll(
                goes.select("event_date")).distinct().collect()]
            old, goes = in_partitions(stored, "event_date", days).alias("old"), goes.alias("goes")
            stay = old.join(goes, F.col("old.event_id").eqNullSafe(F.col("goes.event_id"))
                            & F.col("old.event_date").eqNullSafe(F.col("goes.event_date")),
                            "left_anti")
            silver = replace_partitions(stay.unionByName(won.select(*stored.columns)),
                                        lake.watch_obt, "event_date", days, lake.fmt)
    return silver, days


def load_increment(rows, lake, drops=None):
    """The raw rows of one load through silver to gold; only the days they touch are written."""
    silver, days = refresh_silver(rows, lake)
    return load_gold(silver, lake, drops, days)


def load_gold(silver, lake, drops=None, days=None):
    """The five dimensions with keys, the fact and the gold aggregates, read back.

    Dimension rows and events that are stored keep their keys; those that are new get keys above
    them. With ``days`` only these days of ``silver`` have changed: new dimension rows are looked
    for there, and the fact's other days keep their files. ``drops``, if given, gets
    ``{dimension: {rule: rows dropped, "rows": rows seen}}``. Dimensions and fact do not depend
    on each other, so their jobs run side by side and the short ones fill the gaps of the
    long ones; then the aggregates do.
    """
    spark = silver.sparkSession
    changed = silver if days is None else in_partitions(silver, "event_date", days)

    def dimension(name):
        build, natural, key = DIMENSIONS[name]
        counted = Observation(name) if build in _WITH_RULES and drops is not None else None
        rows = build(changed, dropped=counted) if counted else build(changed)
        known = _stored(spark, f"{lake.gold}/{name}", lake.fmt)
        with temporary_dir(spark, "dense_keys") as path:
            if known is None:
                table = save_gold(dense_keys(rows, natural, key, path), lake.gold, name, lake.fmt)
            else:
                table = save_gold(new_keys(rows, known, natural, key, path), lake.gold, name,
                                  lake.fmt, mode="append")
        if counted:
            drops[name] = observed(counted)
        return table

    def fact(name):
        path = f"{lake.gold}/{name}"
        known = _stored(spark, path, lake.fmt)
        if known is None:
            return save_gold(build_fact(silver, stamped=True), lake.gold, name, lake.fmt,
                             partition_by=("event_date",), rebalance=False)
        last = known.agg(F.max("fact_key")).first()[0]
        keys = known if days is None else in_partitions(known, "event_date", days)
        with temporary_dir(spark, "fact_keys") as kept:
            keys = write_table(keys.select("event_id", "fact_key"), kept)
            rows = keyed_fact(changed, keys, -1 if last is None else last)
            if days is None:
                return save_gold(rows, lake.gold, name, lake.fmt, partition_by=("event_date",))
            table = replace_partitions(rows, path, "event_date", days, lake.fmt)
        table.createOrReplaceTempView(name)
        return table

    def aggregated(name):
        build, inputs = AGGREGATES[name]
        return save_gold(build(*[tables[i] for i in inputs]), lake.gold, name, lake.fmt)

    tables = side_by_side({"fact_watch_events": fact, **dict.fromkeys(DIMENSIONS, dimension)})
    tables["silver"] = silver
    tables |= side_by_side(dict.fromkeys(AGGREGATES, aggregated))
    del tables["silver"]
    return tables
