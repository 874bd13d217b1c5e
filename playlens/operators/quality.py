"""Quality checks of the layers; each returns a DataFrame with few rows."""

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.measures import ratio
from playlens.sources.messages import readable, rejected
from playlens.sources.tables import not_there

# A layer passes while it loses less than this share, in percent.
MAX_LOSS_BRONZE_SILVER = 10
MAX_LOSS_SILVER_GOLD = 5


def duplicates(df, keys):
    """Total rows, distinct keys and surplus rows; NULL keys equal each other.

    Grouping collapses copies of one key before the shuffle, so a key with very
    many copies stays cheap.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"),
    )


def null_counts(df):
    """Rows ``(column_name, null_count)`` for all columns, from one pass."""
    counts = df.agg(*[F.count_if(F.isnull(F.col(c))).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def profile(name, df, keys):
    """``duplicates`` of one table under its name."""
    return duplicates(df, keys).select(F.lit(name).alias("table_name"), "*")


def profile_layers(layers):
    """Profiles of ``{name: (load, keys)}``, and ``{name: error}`` of missing layers.

    ``load`` returns the layer's DataFrame; a layer that is not there is reported and does
    not stop the others. Any other error is raised.
    """
    found, missing = [], {}
    for name, (load, keys) in layers.items():
        try:
            found.append(profile(name, load(), keys))
        except AnalysisException as error:
            if not not_there(error):
                raise
            missing[name] = str(error)
    return (reduce(DataFrame.unionByName, found) if found else None), missing


def range_stats(silver):
    """Smallest, largest and mean completion."""
    return silver.agg(
        F.expr("double(min(completion_pct)) AS min_completion"),
        F.expr("double(max(completion_pct)) AS max_completion"),
        F.expr(f"{ratio('sum(completion_pct)', 'count(completion_pct)')} AS avg_completion"),
    )


def invalid_counts(silver):
    """Rows outside the allowed ranges, one pass; NULL is not counted, NaN and numbers that
    the decimal cannot hold are."""
    pct = F.col("completion_raw" if "completion_raw" in silver.columns else "completion_pct")
    return silver.agg(
        F.count_if((pct < 0) | (pct > 100)).alias("invalid_completion"),
        F.count_if(F.col("watch_duration_mins") <= 0).alias("invalid_duration"),
        F.count_if(F.col("subscription_price") <= 0).alias("invalid_price"),
    )


def distribution(df, column):
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), column)


def orphans(fact, dim, key):
    """Fact rows whose key is not in the dimension, and how many keys that is.

    NULL keys are orphans. The fact is counted per key first: a key with many rows
    is one row at the join.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(dim.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


@dataclass(frozen=True)
class Counted:
    """A table of which only the number of rows, ``n`` of the one row of ``total``, is used."""

    total: DataFrame


def profiled(profile, name, count="total_rows"):
    """A profiled table as ``layer_loss`` takes it, without another scan."""
    return Counted(profile.filter(F.col("table_name") == name).select(
        F.col(count).alias("n")))


def rows(table):
    return table.total if isinstance(table, Counted) else table.agg(
        F.count(F.lit(1)).alias("n"))


def layer_loss(bronze, silver, gold, events=None):
    """Events in the raw layer, rows after it, loss between them in percent, and verdicts.

    ``bronze`` holds all ways into the raw layer. An event counts once, however often it
    was sent; messages of which nothing was read are no events and are counted apart. An
    empty layer gives a NULL loss and a NULL verdict. ``silver`` and ``gold`` may be counted
    before (``profiled``), and so may the distinct ``events`` of ``bronze``.
    """
    def loss(before, after):
        lost = (F.col(before) - F.col(after)).cast("decimal(19,0)") * 100
        return F.try_divide(lost, F.col(before).cast("decimal(19,0)"))

    if events is None:
        events = Counted(duplicates(readable(bronze), ["event_id"]).select(
            F.col("distinct_keys").alias("n")))
    refused = rejected(bronze).filter("reason = 'unreadable'").select(
        F.lit("rejected_messages").alias("layer"), F.col("messages").alias("n"))
    counts = [rows(df).select(F.lit(layer).alias("layer"), "n")
              for df, layer in ((events, "bronze_events"), (silver, "silver_rows"),
                                (gold, "gold_rows"))]
    names = ["bronze_events", "rejected_messages", "silver_rows", "gold_rows"]
    row = reduce(DataFrame.unionByName, [refused, *counts]).agg(
        *[F.max(F.when(F.col("layer") == n, F.col("n"))).alias(n) for n in names])
    first, second = loss("bronze_events", "silver_rows"), loss("silver_rows", "gold_rows")
    return row.select(
        *names,
        F.round(first, 1).cast("double").alias("bronze_to_silver_pct"),
        F.round(second, 1).cast("double").alias("silver_to_gold_pct"),
        (first < MAX_LOSS_BRONZE_SILVER).alias("bronze_to_silver_ok"),
        (second < MAX_LOSS_SILVER_GOLD).alias("silver_to_gold_ok"),
    )


def gathered(df, keys, flags=()):
    """One row per ``keys`` with its rows, the nulls of every column and what ranges need.

    The keys have few values, so the table is small whatever the size of ``df``, and the
    checks below are made from it without another scan."""
    columns = [F.count(F.lit(1)).alias("rows")]
    columns += [F.count_if(F.isnull(F.col(c))).alias(f"null {c}") for c in df.columns]
    columns += [F.expr(sql).alias(name) for name, sql in flags]
    return df.groupBy(*keys).agg(*columns)


def total_nulls(small):
    """``null_counts`` of the table that ``small`` was gathered from."""
    columns = [c.removeprefix("null ") for c in small.columns if c.startswith("null ")]
    return small.agg(*[F.coalesce(F.sum(f"`null {c}`"), F.lit(0)).alias(c) for c in columns]
                     ).unpivot([], columns, "column_name", "null_count")


def range_flags(silver):
    """What ``ranges`` adds up, as ``flags`` of ``gathered``."""
    raw = "completion_raw" if "completion_raw" in silver.columns else "completion_pct"
    return [("low", "min(completion_pct)"), ("high", "max(completion_pct)"),
            ("pct_sum", "sum(completion_pct)"), ("pct_n", "count(completion_pct)"),
            ("bad_completion", f"count_if({raw} < 0 OR {raw} > 100)"),
            ("bad_duration", "count_if(watch_duration_mins <= 0)"),
            ("bad_price", "count_if(subscription_price <= 0)")]


def total_ranges(small):
    """``range_stats`` of the table that ``small`` was gathered from."""
    return small.agg(F.expr("double(min(low)) AS min_completion"),
                     F.expr("double(max(high)) AS max_completion"),
                     F.expr(f"{ratio('sum(pct_sum)', 'sum(pct_n)')} AS avg_completion"))


def total_invalid(small):
    """``invalid_counts`` of the table that ``small`` was gathered from."""
    return small.agg(*[F.coalesce(F.sum(f"bad_{c}"), F.lit(0)).alias(f"invalid_{c}")
                       for c in ("completion", "duration", "price")])


def total_distribution(small, column):
    """``distribution`` of the table that ``small`` was gathered from."""
    return small.groupBy(column).agg(F.sum("rows").alias("count")).orderBy(
        F.desc("count"), column)


def total_orphans(small, dim, key):
    """``orphans`` of the fact that ``small`` was gathered from."""
    per_key = small.groupBy(key).agg(F.sum("rows").alias("n"))
    return per_key.join(dim.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"))
