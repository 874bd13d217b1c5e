"""Report measures, split into parts that can be summed in several steps.

Counts and sums of decimals are exact and add up, so a fact table can be reduced
to one row per join key before it meets a dimension. A key that holds a large
share of the rows is then already one row per map task when it is shuffled.
"""

from pyspark.sql import functions as F

# part name -> (aggregate function, column)
PARTS = {
    "events": ("count", "event_id"),
    "rows": ("count", "1"),
    "pct_sum": ("sum", "completion_pct"),
    "pct_n": ("count", "completion_pct"),
    "score_sum": ("sum", "engagement_score"),
    "score_n": ("count", "engagement_score"),
    "view_revenue": ("sum", "revenue_per_view"),
    "price": ("sum", "subscription_price"),
    "completed": ("sum", "is_completed"),
    "dropped": ("sum", "is_dropped"),
    "prime_time": ("sum", "is_prime_time"),
    "weekend": ("sum", "is_weekend"),
}

def _rounded(expression):
    return f"double(round({expression}, 2))"


def _sum_rounded(total):
    """A sum at two places as a double, half up."""
    return _rounded(f"cast({total} AS decimal(28,4))")


def ratio(total, n):
    """``total / n`` at two places as a double.

    The bounded operand types leave the quotient 14 places, so rounding it to two
    gives the correctly rounded ratio.
    """
    return _rounded(f"try_divide(cast({total} AS decimal(28,4)), cast({n} AS decimal(19,0)))")


# measure name -> (parts it needs, SQL over those parts)
MEASURES = {
    "total_views": (("events",), "events"),
    "row_count": (("rows",), "rows"),
    "avg_completion": (("pct_sum", "pct_n"), ratio("pct_sum", "pct_n")),
    "avg_engagement": (("score_sum", "score_n"), ratio("score_sum", "score_n")),
    "total_revenue": (("view_revenue",), _sum_rounded("view_revenue")),
    "price_revenue": (("price",), _sum_rounded("price")),
    "completed_views": (("completed",), "completed"),
    "dropped_views": (("dropped",), "dropped"),
    "completion_rate_pct": (("completed", "rows"), ratio("completed * 100", "rows")),
    "prime_time_views": (("prime_time",), "prime_time"),
    "weekend_views": (("weekend",), "weekend"),
}


def parts_of(measures):
    """Names of all parts the measures need, each once."""
    return list(dict.fromkeys(p for m in measures for p in MEASURES[m][0]))


def partial(df, keys, measures, users=False):
    """One row per key combination with the summable parts.

    ``users`` adds the exact number of distinct users. It is no summable part: carry
    it, do not add it up.
    """
    columns = []
    for part in parts_of(measures):
        function, column = PARTS[part]
        columns.append(F.expr(f"{function}({column}) AS {part}"))
    if users:
        columns.append(F.expr("count(DISTINCT user_id) AS unique_users"))
    return df.groupBy(*keys).agg(*columns)


def add_parts(df, keys, measures, users=False):
    """Add up the parts of several rows per key combination.

    With ``users`` all rows of one combination must carry the same user count.
    """
    columns = [F.expr(f"sum({p}) AS {p}") for p in parts_of(measures)]
    if users:
        columns.append(F.expr("max(unique_users) AS unique_users"))
    return df.groupBy(*keys).agg(*columns)


def finish(df, keys, measures, names=None, users=False):
    """Turn parts into measures; ``names`` renames measures in the output."""
    names = names or {}
    columns = [F.expr(f"{MEASURES[m][1]} AS {names.get(m, m)}") for m in measures]
    return df.select(*keys, *columns, *(["unique_users"] if users else []))


def aggregate(df, keys, measures, names=None, users=False):
    """``GROUP BY keys`` with the named measures."""
    return finish(partial(df, keys, measures, users), keys, measures, names, users)


def aggregate_star(fact, dim, on, keys, measures, names=None):
    """Measures of a fact-dimension inner join grouped by ``keys``.

    Equal to joining first: every dimension row that matches a key adds the parts
    of that key once. The fact is reduced by ``on`` before the join, and the join
    reuses that shuffle; whether the dimension is sent to all executors is left to
    the optimizer, which checks its size.
    """
    on = [on] if isinstance(on, str) else list(on)
    # Group columns that are join keys come from the fact side of the join.
    dim_columns = on + [k for k in keys if k not in on]
    joined = partial(fact, on, measures).join(dim.select(*dim_columns), on)
    return finish(add_parts(joined, keys, measures), keys, measures, names)
