"""What the operators of this folder share."""

from weakref import WeakKeyDictionary

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.session import kept, work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs, *more):
    """The columns an operator reads, under fixed types; null texts stay null, other columns go."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more)


def fresh(df, name):
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Plans whose every row is one row of a file.
_OF_FILES = {"Project", "Filter", "SubqueryAlias"}
#: The seed under which the files of a scan have names of their own, per scan.
_SEEDS = WeakKeyDictionary()
#: The written copies of tables that are not read from Parquet files, per table.
_COPIES = WeakKeyDictionary()


def placed(docs):
    """``docs`` if its rows are those of Parquet files, else a copy of it that is written once
    for all callers with the same ``docs``.

    An operator that scans a table more than once starts here, so that all scans see one copy."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in _OF_FILES:
        plan = plan.children().head()
    if plan.nodeName() == "LogicalRelation" and "parquet" in plan.relation().toString().lower():
        return docs
    if docs not in _COPIES:
        _COPIES[docs] = stored(docs, "placed")
    return _COPIES[docs]


def _seed(docs):
    """The first seed under which no two files of ``docs`` give a row the same name.

    A row is named by the hash of its file's path, xor its number in the file. Two files can
    only share a name if their hashes agree in all bits above those of the largest row
    number; Spark counts the files by these bits, from the files' footers."""
    if docs not in _SEEDS:
        found = docs.metadataColumn("_metadata")
        files = cut(docs.select(found["file_path"].alias("path"), found["row_index"].alias("at"))
                    .groupBy("path").agg(F.max("at").alias("last")))
        bits = (files.agg(F.max("last")).first()[0] or 0).bit_length()
        seed = 0
        while not files.groupBy(F.shiftrightunsigned(F.xxhash64("path", F.lit(seed)), bits)).agg(
                F.count("*").alias("n")).filter("n > 1").isEmpty():
            seed += 1
        _SEEDS[docs] = seed
    return _SEEDS[docs]


def numbered(docs):
    """``docs`` with a column of each row's place, a long, and that column's name.

    A place is made of the file and the row in it. It does not depend on how a scan is split,
    so places of one scan hold in another, and no list of files is gathered for it."""
    docs = placed(docs)
    name, found = fresh(docs, "row_in_scan"), docs.metadataColumn("_metadata")
    place = F.xxhash64(found["file_path"], F.lit(_seed(docs))).bitwiseXOR(found["row_index"])
    return docs.select("*", place.alias(name)), name


def met(rows, groups, key, size, how="inner"):
    """``rows`` joined to ``groups``, which has a row per ``key`` and in ``size`` how many of ``rows``
    have it. ``how`` is inner or left_semi.

    A key that more than a thousandth of these rows have is looked up in a broadcast table,
    which cannot have a thousand keys, so no key brings a large share of the rows to one task."""
    many = (groups.agg(F.sum(size)).first()[0] or 0) // 1000
    heavy = cut(groups.filter(F.col(size) > many))
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return rows.join(F.broadcast(heavy), key, how).unionByName(
        rest.join(groups.filter(F.col(size) <= many), key, how))


def placed_texts(docs, *more):
    """``texts`` with each row's place in ``row``."""
    marked, name = numbered(docs)
    return texts(marked, F.col(name).alias("row"), *more)


def without_rows(docs, rows):
    """``docs`` without the rows whose places are in ``rows`` (row)."""
    marked, name = numbered(docs)
    return marked.join(rows.select(F.col("row").alias(name)), name, "left_anti").drop(name)


def bitmap(places, bits):
    """An array of longs with the bits at ``places`` (one column below ``bits``) set."""
    found = places.toDF("h").groupBy(F.expr("h div 64").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))"))).collect()  # bits / 64 rows
    known = dict(map(tuple, found))
    longs = ",".join(str(known.get(i, 0)) for i in range(bits // 64))
    return F.split(F.lit(longs), ",").cast("array<bigint>")


def has_bit(longs, place):
    """Whether the bit at ``place`` of a ``bitmap`` is set."""
    at = F.call_function("shiftright", place, F.lit(6)).cast("int")
    return F.call_function("getbit", F.get(longs, at), (place % 64).cast("int")) == 1


def lowered(text):
    """``text`` with A-Z, and nothing else, in lower case; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def bucket(column, buckets):
    """The fixed split of rows: crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % buckets


def stored(df: DataFrame, name: str, partition_by=()):
    """``df`` written to the shared work folder and read back: lineage ends at those files."""
    path = work_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


cut = kept  # a small table at a checkpoint, which Spark deletes with the table


def slices(sizes, limit):
    """Ranges (start, stop) over ``sizes`` whose sums stay under ``limit``, one item at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_blocks(batches, limit, column="text"):
    """Arrow record batches cut into blocks of at most ``limit`` bytes of text, one row at least.

    Yields (block, list of texts as bytes, null being empty)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for start, stop in slices(sizes, limit):
            block = batch.slice(start, stop - start)
            values = block.column(column).cast(pa.large_binary()).to_pylist()
            yield block, [v or b"" for v in values]
