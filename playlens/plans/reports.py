"""Report shapes, the configured reports and the runner.

A report is a small frozen record with a ``build(tables)`` method; ``tables`` maps
names to DataFrames. Adding a report means adding one record to ``REPORTS``.
"""

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.measures import (add_parts, aggregate, aggregate_star, finish,
                                         partial)
from playlens.session import kept

# Measures of the four report shapes.
AGGREGATION_MEASURES = ["total_views", "avg_completion", "avg_engagement", "total_revenue",
                        "completed_views", "dropped_views", "completion_rate_pct"]
CONTENT_KEYS = ["content_title", "genre", "language", "content_type"]
CONTENT_MEASURES = ["total_views", "avg_completion", "avg_engagement", "total_revenue",
                    "completed_views", "dropped_views"]
TIME_MEASURES = ["total_views", "avg_completion", "avg_engagement", "prime_time_views",
                 "weekend_views"]
LOCATION_KEYS = ["city", "state", "region"]
LOCATION_MEASURES = ["total_views", "avg_completion", "avg_engagement", "total_revenue"]


def _checked(name, allowed, what):
    if name not in allowed:
        raise ValueError(f"{what} {name!r} is not one of {sorted(allowed)}")
    return name


def _limited(df, limit):
    return df.limit(limit) if limit else df


def aggregation(fact, by, where: Column | None = None, limit=None):
    """Seven measures by one column, most viewed first."""
    _checked(by, fact.columns, "group column")
    rows = fact if where is None else fact.filter(where)
    ranked = aggregate(rows, [by], AGGREGATION_MEASURES).orderBy(F.desc("total_views"), by)
    return _limited(ranked, limit)


def content_performance(fact, dim_content, genre=None, order_by="total_views", limit=None):
    """Six measures by title, genre, language and type."""
    _checked(order_by, CONTENT_KEYS + CONTENT_MEASURES, "order column")
    dim = dim_content if genre is None else dim_content.filter(F.col("genre") == genre)
    ranked = aggregate_star(fact, dim, "content_id", CONTENT_KEYS, CONTENT_MEASURES).orderBy(
        F.desc(order_by), *CONTENT_KEYS)
    return _limited(ranked, limit)


def time_analysis(fact, by, start=None, end=None):
    """Five measures by a time column, in its order.

    The range holds both ends and applies only if both are given; a date as the end
    means its midnight. A table partitioned by ``event_date`` reads only the days
    inside the range.
    """
    _checked(by, fact.columns, "time column")
    rows = fact
    if start and end:
        stamp_type = fact.schema["event_timestamp"].dataType
        first, last = F.lit(start).cast(stamp_type), F.lit(end).cast(stamp_type)
        rows = rows.filter(F.col("event_timestamp").between(first, last))
        if "event_date" in fact.columns:
            rows = rows.filter(F.col("event_date").between(F.to_date(first), F.to_date(last)))
    return aggregate(rows, [by], TIME_MEASURES).orderBy(by)


def location_performance(fact, dim_locations, region=None, limit=None):
    """Four measures and exact unique users by city, state and region.

    The fact is reduced to one row per city before the join. A (city, state, region)
    group has one city, so that city's users are carried through it, not added.
    """
    dim = dim_locations if region is None else dim_locations.filter(F.col("region") == region)
    per_city = partial(fact, ["city"], LOCATION_MEASURES, users=True)
    groups = add_parts(per_city.join(dim.select(*LOCATION_KEYS), "city"), LOCATION_KEYS,
                       LOCATION_MEASURES, users=True)
    ranked = finish(groups, LOCATION_KEYS, LOCATION_MEASURES, users=True).orderBy(
        F.desc("total_views"), *LOCATION_KEYS)
    return _limited(ranked, limit)


@dataclass(frozen=True)
class Report:
    """A named call of one shape on named tables."""

    name: str
    shape: Callable[..., DataFrame]
    tables: tuple[str, ...] = ("fact_watch_events",)
    options: dict[str, Any] = field(default_factory=dict)

    def build(self, tables):
        return self.shape(*[tables[t] for t in self.tables], **self.options)


_STAR_CONTENT = ("fact_watch_events", "dim_content")
_STAR_PLACE = ("fact_watch_events", "dim_locations")


def configured(genre="THRILLER", region="WEST"):
    """The nine reports; ``genre`` and ``region`` are the two filtered values."""
    return [
        Report("views_by_device", aggregation, options={"by": "device_type", "limit": 10}),
        Report("views_by_subscription", aggregation,
               options={"by": "subscription_plan", "where": F.col("is_completed") == 1}),
        Report("views_by_time_of_day", aggregation, options={"by": "time_of_day"}),
        Report("views_by_completion_category", aggregation,
               options={"by": "completion_category"}),
        Report(f"{genre.lower()}_content_performance", content_performance, _STAR_CONTENT,
               {"genre": genre, "order_by": "total_views", "limit": 5}),
        Report("all_content_performance", content_performance, _STAR_CONTENT,
               {"order_by": "total_revenue", "limit": 10}),
        Report("views_by_day_of_week", time_analysis, options={"by": "event_day"}),
        Report(f"{region.lower()}_region_performance", location_performance, _STAR_PLACE,
               {"region": region, "limit": 5}),
        Report("all_location_performance", location_performance, _STAR_PLACE, {"limit": 8}),
    ]


@dataclass(frozen=True)
class Outcome:
    """A report's DataFrame, or the error that kept it from being built or run."""

    frame: DataFrame | None = None
    error: str | None = None

    @property
    def ok(self):
        return self.error is None


def run_reports(reports, tables, show=False):
    """``{name: Outcome}``; a failing report does not stop the others.

    Each report runs here, once, and its rows are kept in their order at a checkpoint, so ``ok``
    means that it ran to its end.
    """
    outcomes = {}
    for report in reports:
        try:
            frame = kept(report.build(tables))
            if show:
                frame.show(truncate=False)
            outcomes[report.name] = Outcome(frame)
        except Exception as error:  # noqa: BLE001 - recorded per report
            outcomes[report.name] = Outcome(error=str(error))
    return outcomes
