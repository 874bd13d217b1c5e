"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned by token windows.

Texts are normalised (A-Z to lower case) and cut into words, the runs of ASCII digits,
ASCII letters and non-ASCII characters. A benchmark item gives its windows of 13 words, or
one window of all its words if it has fewer. Every window of a document is looked up in
the set of benchmark windows; the lookup compares the words themselves, so a hash is
never taken for a hit. A bitmap of the hashed first three words of all benchmark windows, of
fixed size, spares most places of a document the lookup. Only DataFrame functions are used.

The set is broadcast in blocks of at most ``SET_BYTES``; a larger benchmark means more
passes over the documents, never a larger broadcast. Nothing of the documents is shuffled
but one row each and their hits.

Defined results: a null or empty text has no words, so no hits. Rows are told apart by their
place in the files, so repeated and null ``doc_id`` give a result per row. Items with equal
``item_id`` are one item; an item without an id hits but is not listed. Other columns are
ignored.
"""

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bitmap, cut, fresh, has_bit, lowered, numbered, placed, placed_texts, stored

#: Words as they stand; in lower case they hold no A-Z.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Bytes of benchmark windows in one broadcast.
SET_BYTES = 32 << 20
#: Words of a window's head, and bits of the map of heads.
HEAD, MAP_BITS = 3, 1 << 19
#: A document is contaminated if one word in so many is hit.
ONE_IN = 20


def words(text):
    """The normalised words of ``text``; only words with something to lower are translated."""
    found = F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.when(w == F.lower(w), w).otherwise(lowered(w)))


def _windows(column, length, starts=None):
    """(pos, w) of the windows of ``length`` words, of all or those at ``starts``."""
    last = F.size(column) - length
    if starts is None:
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
            F.array().cast("array<int>"))
    else:
        starts = F.filter(starts, lambda i: i <= last)
    return F.transform(starts, lambda i: F.struct(
        i.alias("pos"), F.array_join(F.slice(column, i + 1, length), " ").alias("w")))


def _head(column, i):
    """The place in the bitmap of the first words of the window at ``i``."""
    return F.pmod(F.xxhash64(*[F.get(column, i + j) for j in range(HEAD)]), F.lit(MAP_BITS))


def _bitmap(sets):
    """The heads of all windows of ``HEAD`` words or more, as an array of longs."""
    head = _head(F.split("w", " "), F.lit(0))
    return bitmap(sets.filter(F.col("len") >= HEAD).select(head), MAP_BITS)


def _candidates(column, heads):
    """The places of ``column`` whose first words may begin a benchmark window."""
    last = F.size(column) - HEAD
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
        F.array().cast("array<int>"))

    return F.filter(places, lambda i: has_bit(heads, _head(column, i)))


def benchmark_windows(benchmark: DataFrame, window=WINDOW):
    """(sets, lists): distinct windows (wid, w, len), and (wid, item_id) of the items with them."""
    items = benchmark.select(F.col("item_id").cast("string"), words(F.col("text")).alias("ws"))
    length = F.least(F.size("ws"), F.lit(window))
    every = items.filter(F.size("ws") > 0).select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("ws") - length + 1),
        lambda i: F.struct(F.array_join(F.slice("ws", i, length), " ").alias("w"),
                           length.alias("len")))).alias("x")).select("item_id", "x.w", "x.len")
    sets = cut(every.select("w", "len").distinct().withColumn(
        "wid", F.monotonically_increasing_id()))
    lists = every.filter(F.col("item_id").isNotNull()).join(sets, ["w", "len"])
    return sets, cut(lists.select("wid", "item_id").distinct())


def scan(docs: DataFrame, benchmark: DataFrame, window=WINDOW, set_bytes=SET_BYTES):
    """Per document row: row, doc_id, n_words, spans (pos, len) hit, items (ids, sorted)."""
    sets, lists = benchmark_windows(benchmark, window)
    size = sets.agg(F.sum(F.octet_length("w") + 64)).first()[0] or 0
    lengths = sorted(r[0] for r in sets.select("len").distinct().collect())  # 13 values at most
    tokens = placed_texts(docs).select("row", "doc_id", words(F.col("text")).alias("ws"))
    tokens = tokens.withColumn("places", _candidates(F.col("ws"), _bitmap(sets)))
    # One row with pos -1 carries the word count of a document past the join.
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("w")))

    def found(block, blocks):
        wanted = sets if blocks == 1 else sets.filter(
            F.pmod(F.xxhash64("w"), F.lit(blocks)) == block)
        rows = tokens.select("row", "doc_id", F.size("ws").alias("n_words"), F.explode(
            F.concat(own, *[_windows(F.col("ws"), n, F.col("places") if n >= HEAD else None)
                            for n in lengths])).alias("x"))
        return (rows.select("row", "doc_id", "n_words", "x.pos", "x.w")
                .join(F.broadcast(wanted), "w", "left")
                .filter((F.col("pos") < 0) | F.col("wid").isNotNull())
                .select("row", "doc_id", "n_words", "pos", "len", "wid"))

    blocks = max(1, ceil(size / set_bytes))
    hits = reduce(DataFrame.unionAll, [found(b, blocks) for b in range(blocks)])
    hit = F.col("wid").isNotNull()
    rows = stored(hits.groupBy("row", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(hit, F.struct("pos", "len")))).alias("spans"),
        F.collect_set("wid").alias("wids")), "decontaminate")
    items = (rows.select("row", F.explode("wids").alias("wid")).join(lists, "wid")
             .select("row", "item_id").distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    return rows.drop("wids").join(items, "row", "left").withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>")))


def words_hit(spans):
    """The number of words under (pos, len) spans sorted by pos."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a.end, s.pos + s.len).alias("end"),
        (a.n + F.greatest(F.lit(0), s.pos + s.len - F.greatest(a.end, s.pos))).alias("n"))).n


def contamination(docs, benchmark, window=WINDOW, one_in=ONE_IN, set_bytes=SET_BYTES):
    """``scan`` with n_hit and contaminated (one word in ``one_in`` or more is hit)."""
    rows = scan(docs, benchmark, window, set_bytes).withColumn(
        "n_hit", words_hit(F.col("spans")))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (
        F.col("n_hit").cast("long") * one_in >= F.col("n_words")))


def remove_documents(docs, benchmark, **parameters):
    """``docs`` without the contaminated ones, all columns kept.

    Only rows that the bitmap of contaminated ones has are shuffled."""
    docs = placed(docs)
    bad = contamination(docs, benchmark, **parameters).filter("contaminated")
    rows, row = numbered(docs)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    may_be_bad = has_bit(bitmap(bad.select(place("row")), MAP_BITS), place(row))
    good = rows.filter(may_be_bad).join(
        bad.select(F.col("row").alias(row)), row, "left_anti").select(*rows.columns)
    return rows.filter(~may_be_bad).unionByName(good).drop(row)


def remove_spans(docs, benchmark, **parameters):
    """``docs`` with the hit words, and what separates them from the next word, cut out."""
    docs = placed(docs)
    marked, row = numbered(docs)
    spans = fresh(marked, "spans")
    hit = scan(docs, benchmark, **parameters).filter(F.size("spans") > 0).select(
        F.col("row").alias(row), F.col("spans").alias(spans))
    separator = WORD.replace("[^", "[")
    # A piece is a word with the separator after it; the head stands before the first word.
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}(?:{separator})?"), F.lit(0))
    head = F.regexp_extract("text", f"^(?:{separator})?", 0)
    kept = F.filter(pieces, lambda _, i: ~F.exists(
        spans, lambda s: (s.pos <= i) & (i < s.pos + s.len)))
    cleaned = F.when(F.col(spans).isNull(), F.col("text")).otherwise(
        F.concat(head, F.array_join(kept, "")))
    return marked.join(hit, row, "left").withColumn("text", cleaned).drop(row, spans)
