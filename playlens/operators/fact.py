"""Fact table of watch events."""

from pyspark.sql import functions as F

from playlens import schemas


def build_fact(silver, columns=schemas.FACT, stamped=False):
    """Natural keys, measures and the flags the reports read.

    ``stamped`` adds ``fact_key`` and the load time. The key is unique without a
    shuffle but only fixed once written, so ``tables.save_gold`` reads back what it
    wrote.
    """
    fact = silver.select(*columns)
    if stamped:
        fact = (fact.withColumn("fact_key", F.monotonically_increasing_id())
                .withColumn("gold_timestamp", F.current_timestamp()))
    return fact


def keyed_fact(silver, keys, last):
    """The stamped fact with the stored ``keys`` (event_id, fact_key), one per event.

    Events without one get keys above ``last``, in no dense order: they are dealt per task, without
    a shuffle of their own, and as ``build_fact``'s are fixed once written."""
    rows = build_fact(silver, stamped=True).withColumnRenamed("fact_key", "_new_key").alias("rows")
    known = keys.select("event_id", "fact_key").alias("known")
    met = rows.join(known, F.col("rows.event_id").eqNullSafe(F.col("known.event_id")), "left")
    return met.select("rows.*", "known.fact_key").withColumn(
        "fact_key", F.coalesce("fact_key", F.col("_new_key") + last + 1)).select(
        *[c for c in rows.columns if c not in ("_new_key", "gold_timestamp")],
        "fact_key", "gold_timestamp")
