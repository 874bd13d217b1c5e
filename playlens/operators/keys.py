"""Surrogate keys 1..n in the order of the natural key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.session import work_dir

# Layout of monotonically_increasing_id: partition number above 33 row bits.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def dense_keys(df, natural_key, key, path=None):
    """Add ``key``: the rank of each row by its (unique) natural key.

    Equal to a global row_number, without sending all rows through one task: rows
    are range-partitioned and sorted, written with their position in the partition,
    and the partition offsets are added on reading. The written table pins the
    layout, so a lost executor cannot change a key. That table is at ``path``, by default a
    new work folder.
    """
    spark = df.sparkSession
    path = path or work_dir(spark, "dense_keys")
    natural_key = list(natural_key)
    sorted_rows = (df.repartitionByRange(*natural_key)
                   .sortWithinPartitions(*natural_key)
                   .withColumn("_slot", F.monotonically_increasing_id()))
    sorted_rows.write.parquet(path)
    laid = spark.read.schema(sorted_rows.schema).parquet(path).withColumn(
        "_part", F.shiftrightunsigned("_slot", _ROW_BITS))

    # One row per written partition, so the window and the broadcast are bounded by
    # the number of shuffle partitions, whatever the number of rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return laid.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (F.col("_offset") + F.col("_slot").bitwiseAND(F.lit(_ROW_MASK)) + 1).alias(key),
    )


def new_keys(df, known, natural_key, key, path=None):
    """Rows of ``df`` that ``known`` does not have, with keys above all of its keys.

    Rows that have a key keep it, so keys can be stored elsewhere. NULLs equal each other.
    """
    natural_key = list(natural_key)
    same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in natural_key]
    fresh = df.alias("new").join(known.select(*natural_key).alias("old"), same, "left_anti")
    last = known.agg(F.max(key)).first()[0] or 0
    return dense_keys(fresh, natural_key, key, path).withColumn(key, F.col(key) + last)
