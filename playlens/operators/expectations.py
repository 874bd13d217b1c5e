"""Row rules that drop failing rows and count them."""

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from playlens.session import observed
from playlens.sources.tables import write_table


def _holds(rule):
    """True only where the rule is true; NULL counts as a failure."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_or_drop(df, rules, observation=None):
    """Keep rows that meet every rule of ``{name: SQL predicate}``.

    With an ``Observation`` the failures per rule, and all rows seen, are counted
    by the first action on the result, without a job of their own.
    """
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()],
        )
    return df.filter(reduce(lambda a, b: a & b, [F.expr(r) for r in rules.values()]))


def failures(df, rules):
    """Rows ``(rule, failed_rows)``, all rules in one pass."""
    counts = df.agg(*[F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "failed_rows")


#: A row per rule of a load in the log of ``save_expected``.
LOG = ("dataset string, rule string, failed_rows long, seen_rows long, kept_rows long, "
       "loaded_at timestamp")


def save_expected(df, rules, path, dataset, log=None, **layout):
    """Write the rows of ``df`` that meet every rule; returns (table, outcome).

    Seen, kept and failed rows are counted while the table is written, in the same job.
    ``outcome`` has a row per rule (``LOG``) and is appended to the table at ``log``, which so
    tells what every load dropped, and why."""
    spark = df.sparkSession
    seen, kept = Observation(), Observation()
    passed = expect_or_drop(df, rules, seen).observe(kept, F.count(F.lit(1)).alias("rows"))
    table = write_table(passed, path, **layout)
    counts, written = observed(seen), observed(kept)
    outcome = spark.createDataFrame(
        [(dataset, rule, counts[rule], counts["rows"], written["rows"]) for rule in rules],
        LOG.rsplit(",", 1)[0]).withColumn("loaded_at", F.current_timestamp())
    if log is not None:
        outcome.coalesce(1).write.mode("append").parquet(log)
    return table, outcome
