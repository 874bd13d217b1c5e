"""Time the layers and all registered queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playlens import registry, schemas  # noqa: E402
from playlens.plans import pipeline, reports  # noqa: E402
from playlens.session import session, work_dir  # noqa: E402
from playlens.sources import messages, sample, tables  # noqa: E402
from playlens.streaming import bronze  # noqa: E402


def timed(times, name, action):
    start = time.perf_counter()
    result = action()
    times[name] = round(time.perf_counter() - start, 3)
    return result


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def stages(spark, sf_dir):
    """Raw, silver and gold layers written one after another, then the nine reports."""
    times = {}
    base = work_dir(spark, "bench")
    lake = pipeline.Lake(base)
    records = sample.watch_records(spark, sf_dir)
    records.write.json(f"{base}/history")
    messages.publish(messages.encode(records), "text", path=f"{base}/incoming")

    def load_bronze():
        history = tables.scan_json(spark, f"{base}/history", schemas.WATCH_EVENT)
        pipeline.load_bronze_bulk(history, lake)
        bronze.ingest_available(bronze.message_source(spark, "text", f"{base}/incoming"),
                                lake.stream_events, f"{base}/checkpoint")

    timed(times, "stage_bronze", load_bronze)
    silver = timed(times, "stage_silver", lambda: pipeline.load_silver(
        tables.scan_table(spark, lake.bulk_history),
        tables.scan_table(spark, lake.stream_events), lake))
    gold = timed(times, "stage_gold", lambda: pipeline.load_gold(silver, lake))

    def run_nine():
        chosen = reports.configured(registry.GENRE, registry.REGION)
        for outcome in reports.run_reports(chosen, gold).values():
            drain(outcome.frame)

    timed(times, "stage_reports", run_nine)
    return times


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("playlens-bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="playlens-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM's code paths is not what is measured.
    drain(registry.report_views_by_device(spark, sf_dir))

    times = stages(spark, sf_dir)
    for name, build in registry.QUERIES.items():
        timed(times, name, lambda build=build: drain(build(spark, sf_dir)))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
