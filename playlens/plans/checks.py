"""The quality run over all layers of a lake."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators import quality
from playlens.session import kept
from playlens.sources import messages
from playlens.sources.tables import not_there, scan_table

# Dimension -> key its orphans are checked on.
REFERENCES = {"dim_content": "content_id", "dim_locations": "city", "dim_devices": "device_type"}


@dataclass(frozen=True)
class Checks:
    """Results; a check whose layers are not there is None."""

    profile: DataFrame | None = None
    nulls: dict[str, DataFrame] = field(default_factory=dict)
    range_stats: DataFrame | None = None
    invalid: DataFrame | None = None
    completion: DataFrame | None = None
    time_of_day: DataFrame | None = None
    orphans: DataFrame | None = None
    loss: DataFrame | None = None
    rejected: DataFrame | None = None
    missing: dict[str, str] = field(default_factory=dict)


def check_lake(spark, lake):
    """Profile, null counts, ranges, distributions, orphans, loss and rejected messages.

    Layers that are not there are reported in ``missing`` and skipped. Silver and fact are
    scanned twice each, once for their keys and once for all the rest; what is counted is
    kept in small tables below the shared work folder.
    """
    paths = {
        "bulk_history": lake.bulk_history,
        "stream_events": lake.stream_events,
        "watch_obt": lake.watch_obt,
        "fact_watch_events": f"{lake.gold}/fact_watch_events",
        **{dim: f"{lake.gold}/{dim}" for dim in REFERENCES},
    }
    layers, missing = {}, {}
    for name, path in paths.items():
        try:
            layers[name] = scan_table(spark, path, lake.fmt)
        except AnalysisException as error:
            if not not_there(error):
                raise
            missing[name] = str(error)

    events = {name: df for name, df in layers.items() if name not in REFERENCES}
    silver, fact = layers.get("watch_obt"), layers.get("fact_watch_events")
    raw = {name: layers[name] for name in ("bulk_history", "stream_events") if name in layers}
    bronze = messages.combine(*raw.values()) if raw else None
    small = {}
    if silver is not None:
        small["watch_obt"] = kept(quality.gathered(
            silver, ["completion_category", "time_of_day"], quality.range_flags(silver)))
    if fact is not None:
        small["fact_watch_events"] = kept(quality.gathered(fact, list(REFERENCES.values())))
    for name in events.keys() - small.keys():
        small[name] = quality.gathered(events[name], [])
    orphans = [
        quality.total_orphans(small["fact_watch_events"], layers[dim], key).select(
            F.lit(dim).alias("dimension"), "*")
        for dim, key in REFERENCES.items() if fact is not None and dim in layers
    ]
    of_silver = {} if silver is None else {
        "range_stats": quality.total_ranges(small["watch_obt"]),
        "invalid": quality.total_invalid(small["watch_obt"]),
        "completion": quality.total_distribution(small["watch_obt"], "completion_category"),
        "time_of_day": quality.total_distribution(small["watch_obt"], "time_of_day"),
    }
    profile = kept(reduce(DataFrame.unionByName, [
        quality.profile(name, df, ["event_id"]) for name, df in events.items()
    ])) if events else None
    # Of one raw layer without unread messages the profile has counted the events already.
    counted = (quality.profiled(profile, *raw, "distinct_keys")
               if len(raw) == 1 and messages.CORRUPT not in bronze.columns else None)
    return Checks(
        profile=profile,
        nulls={name: quality.total_nulls(small[name]) for name in events},
        orphans=reduce(DataFrame.unionByName, orphans) if orphans else None,
        loss=(quality.layer_loss(
            bronze, quality.profiled(profile, "watch_obt"),
            quality.profiled(profile, "fact_watch_events"), counted)
            if all(t is not None for t in (bronze, silver, fact)) else None),
        rejected=quality.rejected(bronze) if bronze is not None else None,
        missing=missing,
        **of_silver,
    )
