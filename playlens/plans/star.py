"""Analytics over the star schema."""

from pyspark.sql import functions as F

from playlens.functions.measures import aggregate, aggregate_star


def genre_views(fact, dim_content):
    """Views and mean completion per genre."""
    return aggregate_star(fact, dim_content, "content_id", ["genre"],
                          ["total_views", "avg_completion"]).orderBy(
        F.desc("total_views"), "genre")


_REVENUE = (["total_views", "price_revenue"], {"price_revenue": "total_revenue"})


def _ranked(revenue):
    return revenue.orderBy(F.desc("total_revenue"), "subscription_plan")


def revenue_by_plan_literal(fact, dim_users):
    """Views and revenue per plan, joined on the user alone.

    The dimension is one row per user, plan and price, without the age group. A user with
    several plans has several rows, so their views count once for every plan. Kept beside
    ``revenue_by_plan`` as the form users run today.
    """
    users = dim_users.select("user_id", "subscription_plan", "subscription_price").distinct()
    return _ranked(aggregate_star(fact, users, "user_id", ["subscription_plan"], *_REVENUE))


def revenue_by_plan(fact, dim_users):
    """Views and revenue per plan, each view of a known user and plan counted once."""
    keys = ["user_id", "subscription_plan"]
    known = dim_users.select(*keys).distinct()
    return _ranked(aggregate_star(fact, known, keys, ["subscription_plan"], *_REVENUE))


def top_content(fact, dim_content):
    """Views per title."""
    return aggregate_star(fact, dim_content, "content_id", ["content_title"], ["row_count"],
                          {"row_count": "views"}).orderBy(F.desc("views"), "content_title")


def prime_time(fact):
    """Views and mean completion per part of the day."""
    return aggregate(fact, ["time_of_day"], ["row_count", "avg_completion"],
                     {"row_count": "views"}).orderBy(F.desc("views"), "time_of_day")
