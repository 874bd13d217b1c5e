"""Table scans, writes, catalog registration.

``fmt`` is any format the session knows; Parquet by default, and a format with a
transaction log (where its jar is present) through the same parameter.
"""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.session import delete, names_in

#: The folder of a partition whose value is NULL.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

#: Formats that are read with the schema of what was written.
_FILES = ("parquet", "orc", "avro", "json")


def not_there(error):
    """Whether an error says that a table has not been written, or has no file yet."""
    return (error.getCondition() or "").split(".")[0] in (
        "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scan_table(spark, path, fmt="parquet", schema=None, **options):
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan_json(spark, path, schema, array=False, corrupt=None):
    """JSON Lines, or with ``array`` whole files that hold one JSON array.

    An array file cannot be split between tasks: use it for small history files, one
    task per file, and JSON Lines for volume. ``corrupt`` names a column that keeps the
    text of records that do not fit the schema; without it their fields are NULL.
    """
    reader = spark.read.option("multiLine", array)
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).json(path)


def write_table(df, path, fmt="parquet", mode="overwrite", partition_by=(), rebalance=True,
                **options):
    """Write a table and return it read back.

    ``overwriteSchema`` is on for overwrites (Parquet replaces the schema anyway).
    With ``partition_by`` rows are first brought together by partition value; the
    rebalance splits large values over several tasks and merges small ones, so the
    table has neither one huge task nor a file per task and value. Rows that were
    read from a table with the same layout need no ``rebalance``.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    reader = df.sparkSession.read.format(fmt)
    if fmt in _FILES:  # a partitioned table without rows has no file that says its schema
        reader = reader.schema(df.schema)
    return reader.load(path).select(*df.columns)


def in_partitions(df, column, values):
    """The rows of ``df`` in the given partitions, of which None may be one."""
    known = [v for v in values if v is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return df.filter(wanted | F.col(column).isNull() if None in values else wanted)


def replace_partitions(df, path, column, values, fmt="parquet"):
    """Replace the partitions ``values`` of the table at ``path`` by the rows of ``df``.

    All of ``df`` must be in those partitions, whose values are dates, numbers or plain words.
    Other partitions keep their files, and ``df`` may read the table itself: new files are moved
    in when all are written. A partition without rows any more is deleted. Without a
    transaction log a reader may meet the partitions half exchanged."""
    spark = df.sparkSession
    if values:
        folders = [f"{path}/{column}={_NO_VALUE if v is None else v}" for v in values]
        before = {f: names_in(spark, f) for f in folders}
        df.hint("rebalance", column).write.format(fmt).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(column).save(path)
        for folder, names in before.items():
            if names & names_in(spark, folder):  # what had rows was exchanged whole
                delete(spark, folder)
    return scan_table(spark, path, fmt, df.schema if fmt in _FILES else None).select(
        *df.columns)


def save_gold(df, base, name, fmt="parquet", **layout):
    """Write ``base/name`` and name the written table as a view.

    The view reads the files, so generated keys in it are the stored ones.
    """
    table = write_table(df, f"{base}/{name}", fmt, **layout)
    table.createOrReplaceTempView(name)
    return table


def register_table(spark, database, name, path, fmt="parquet", location=None):
    """Register the table at ``path`` as ``database.name``, replacing a former one.

    The catalog learns the partitions that are there; without that it would show no rows.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(f"CREATE TABLE {database}.{name} USING {fmt} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
        spark.catalog.recoverPartitions(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


def registered_or_path(spark, database, name, path, fmt="parquet", location=None):
    """The registered table; the files themselves where registration fails.

    ``location`` is where a new database is kept. What the catalog and its storage refuse (no
    such catalog, no permission, a folder that can't be made) falls back to the path; errors of
    another kind are raised, and so is that of a path that can't be read either."""
    try:
        return register_table(spark, database, name, path, fmt, location)
    except (PySparkException, Py4JJavaError):
        return scan_table(spark, path, fmt)


def preview(df, *order, n=5):
    """The first rows by ``order``."""
    return df.orderBy(*order).limit(n)


def most_frequent(df, column, n=None):
    """Values of a column by frequency, ties by value; the first ``n`` if given."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("views")).orderBy(
        F.desc("views"), column)
    return counted.limit(n) if n else counted


def most_frequent_of(rows, key, lookup, column, n=None):
    """``most_frequent`` of a ``column`` that ``lookup`` has once per ``key``.

    Rows are counted per key before they meet the lookup, so a frequent key is one row
    there."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("views"))
    named = counted.join(lookup.select(key, column), key, "left").groupBy(column).agg(
        F.sum("views").alias("views")).orderBy(F.desc("views"), column)
    return named.limit(n) if n else named
