"""Repeated byte strings across a corpus, by bucket-pointer refinement of sampled suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Which
suffixes are sorted: for every place where such a string can start, the anchor is the q-gram
inside the string with the smallest hash, the leftmost of equals. Equal strings have equal
anchors at the same distance, so only the suffixes at anchors need to be put into buckets,
about one in seventy; consecutive starts with one anchor are a run.

* The initial buckets are those of the anchors' q-grams. Buckets of one are dropped.
* A bucket is refined by an identifier of what lies around the anchor: the digest of all bytes
  that the strings of the run cover. A run whose identifier is met again is repeated as a
  whole. What is left are runs at whose ends copies begin to differ.
* These are refined recursively within their q-gram bucket. A bucket over a range of distances
  is parted by the identifiers of all bytes of the range; members met twice are done for the
  range, and one of them stays as a witness. It is then parted by the bytes that all strings
  of the range share; parts with an undecided member and another one are refined over the
  halves of the range with what the parting has given.

Counting, joining and grouping are Spark's. Equal runs are counted with map-side sums. The runs of
a text cover its starts, so those that are met again are what the runs met once leave of them:
copies are not joined to their counts, and no row is made for them. Only
distinct runs are put into buckets, so a passage that a third of all documents hold is a few
rows of its bucket. Only buckets of
at most ``GROUP`` undecided runs and witnesses are refined in a task, larger ones by counting
the digests of all their strings. Texts are read three times and only those with a place that
may be repeated are shuffled: a bitmap of ``MAP_BITS`` bits over row numbers, which errs on the
safe side, tells which. Long texts are cut into overlapping segments, so memory is bounded.

Words instead of bytes: a text can be taken as the hashes of its words, eight bytes each, of
which only strings that start at a word count (``unit`` is 8). A string of ``8 * WORDS`` bytes is
then a passage of ``WORDS`` words, whatever their length and the white space between them.

Identifiers are 128-bit digests or the bytes themselves; the q-gram hash only groups candidates.

Defined results: a null text has no bytes. Rows are told apart by their place in the files,
so repeated and null ``doc_id`` give a row each. Other columns are kept by ``remove`` and
ignored otherwise.
"""

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from playlens.llm.common import (
    fresh, numbered, placed, placed_texts, slices, stored, text_blocks)

LENGTH = 400
#: Words of the shortest repeated passage, and bytes of a word's hash.
WORDS, WORD = 51, 8
GRAM = 128  # a power of two
BLOCK_BYTES, SEGMENT = 4 << 20, 2 << 20
GROUP = 4096
MAP_BITS = 1 << 24
#: Kinds of runs: all starts of a text, starts met once as far as whole runs tell, starts met again.
ALL, ONCE, AGAIN = 0, 1, 2

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _paired(left, right):
    """Names of pairs of names."""
    named = left * _A
    named ^= named >> np.uint64(32)
    named += right
    named *= _B
    named ^= named >> np.uint64(29)
    return named


def _gram_names(raw):
    """Names of the GRAM bytes from every place: eight bytes, then pairs of names, doubling."""
    names = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,)).copy()
    width = 8
    while width < GRAM:
        names = _paired(names[:-width], names[width:])
        width *= 2
    return names


def _smallest(keys, width):
    """The minimum of ``width`` keys from every place, by doubling."""
    have = 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    more = width - have
    return np.minimum(keys[:len(keys) - more], keys[more:]) if more else keys


def coded(text, unit):
    """``text`` (bytes), or the hashes of its words one after the other if ``unit`` is WORD."""
    return text if unit == 1 else b"".join(map(xxhash.xxh64_digest, text.split()))


def runs(segments, length=LENGTH):
    """(segment, first start, starts, start to anchor, gram name, digest) per run of starts.

    ``segments`` are bytes; starts are places of strings within their segment."""
    sizes = np.array([len(s) for s in segments])
    whole = b"".join(segments)
    if len(whole) < length:
        return []
    names = _gram_names(whole)
    bits = np.uint64(len(whole).bit_length())
    keys = names >> bits << bits | np.arange(len(names), dtype=np.uint64)
    anchors = _smallest(keys, length - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    valid = np.zeros(len(whole) + 1, np.int8)
    long = sizes >= length
    valid[begins[long]] += 1
    valid[ends[long] - length + 1] -= 1
    valid = np.cumsum(valid[:len(anchors)]) > 0
    changes = np.r_[True, (anchors[1:] != anchors[:-1]) | (valid[1:] != valid[:-1])]
    # A segment of ``length`` bytes may follow another without a gap between their starts.
    changes[begins[long]] = True
    firsts = np.flatnonzero(changes)
    lasts = np.r_[firsts[1:], len(anchors)] - 1
    firsts, lasts = firsts[valid[firsts]], lasts[valid[firsts]]
    at = anchors[firsts].astype(np.int64)
    digests = [hashlib.blake2b(whole[a:b], digest_size=16).digest()
               for a, b in zip(firsts.tolist(), (lasts + length).tolist())]
    owner = np.searchsorted(ends, firsts, side="right")
    return owner, firsts - begins[owner], lasts - firsts + 1, at - firsts, names[at], digests


def _anchored(batches, length=LENGTH, unit=1):
    for block, values in text_blocks(batches, BLOCK_BYTES):
        values = [coded(v, unit) for v in values]
        numbers = block.column("row").to_numpy()
        parts = [(i, s, v[s:s + SEGMENT + length - 1]) for i, v in enumerate(values)
                 for s in range(0, max(0, len(v) - length + 1), SEGMENT)]
        for a, b in slices([len(p[2]) for p in parts], BLOCK_BYTES):
            found = runs([p[2] for p in parts[a:b]], length)
            if not found:
                continue
            owner, first, n, ahead, names, digests = found
            doc = np.array([p[0] for p in parts[a:b]])[owner]
            first = first + np.array([p[1] for p in parts[a:b]])[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[doc]), pa.array(first.astype(np.int64)),
                 pa.array(n.astype(np.int32)), pa.array(ahead.astype(np.int32)),
                 pa.array(names.view(np.int64)), pa.array(digests, pa.binary())],
                names=["row", "at", "n", "ahead", "gram", "around"])


def refine(members, low, high, decided, length=LENGTH):
    """Adds (member, low, high) to ``decided`` for ranges of distances met twice.

    ``members`` are (number, bytes, anchor in them, least and greatest distance, wanted).
    A string of distance d starts d bytes before the anchor."""
    if low > high:
        return
    groups, part = {}, []
    for m in members:
        _, around, anchor, least, most, _ = m
        if least <= low and high <= most:
            groups.setdefault(around[anchor - high:anchor - low + length], []).append(m)
        elif least <= high and low <= most:
            part.append(m)
    open_ = list(part)
    witnesses = []
    for group in groups.values():
        if len(group) > 1:
            decided.extend((m[0], low, high) for m in group if m[5])
            number, *rest, _ = group[0]
            witnesses.append((number, *rest, False))
        else:
            open_.extend(group)
    if low == high or not any(m[5] for m in open_):
        return
    shared = {}
    for m in open_ + witnesses:
        shared.setdefault(m[1][m[2] - low:m[2] - high + length], []).append(m)
    middle = (low + high) // 2
    for group in shared.values():
        if len(group) > 1 and any(m[5] for m in group):
            refine(group, low, middle, decided, length)
            refine(group, middle + 1, high, decided, length)


def _refined(batches, length=LENGTH):
    """Runs sorted by gram to (row, at, n) of the starts in them that are repeated."""
    def solved(rows):
        members = [(i, x["bytes"], x["ahead"], x["ahead"] - x["n"] + 1, x["ahead"], x["open"])
                   for i, x in enumerate(rows)]
        decided = []
        refine(members, 0, length - GRAM, decided, length)
        for i, low, high in decided:
            yield rows[i]["row"], rows[i]["at"] + rows[i]["ahead"] - high, high - low + 1

    def batch_of(found):
        columns = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int32())], names=["row", "at", "n"])

    now, rows = None, []
    for batch in batches:
        found = []
        for x in batch.to_pylist():
            if rows and x["gram"] != now:
                found.extend(solved(rows))
                rows = []
            now = x["gram"]
            rows.append(x)
        yield batch_of(found)
    yield batch_of(list(solved(rows)))


def _strings(batches, length=LENGTH):
    """Runs to (digest, row, at, open) of each of their strings."""
    for batch in batches:
        for x in batch.to_pylist():
            every = range(x["n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(x["bytes"][i:i + length], digest_size=16).digest()
                           for i in every], pa.binary()),
                 pa.array([x["row"]] * x["n"], pa.int64()),
                 pa.array([x["at"] + i for i in every], pa.int64()),
                 pa.array([x["open"]] * x["n"], pa.bool_())],
                names=["digest", "row", "at", "open"])


def _cut_out(batches, length=LENGTH, unit=1):
    """(text, wanted runs) to a row per run with the bytes that its strings cover."""
    for batch in batches:
        for x in batch.to_pylist():
            text = coded((x["text"] or "").encode(), unit)
            wanted = x["wanted"]
            yield pa.RecordBatch.from_pylist(
                [{**w, "row": x["row"], "bytes": text[w["at"]:w["at"] + w["n"] + length - 1]}
                 for w in wanted],
                pa.schema([("gram", pa.int64()), ("row", pa.int64()), ("at", pa.int64()),
                           ("n", pa.int32()), ("ahead", pa.int32()), ("open", pa.bool_()),
                           ("big", pa.bool_()), ("bytes", pa.binary())]))


def _marked(spark, numbers, row="row"):
    """A column: whether the number in column ``row`` may be among ``numbers``, by the bitmap."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    found = numbers.select(place("row").alias("h")).groupBy(F.expr("h div 64").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("bits")).toArrow()
    longs = np.zeros(MAP_BITS // 64, np.int64)
    longs[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    sent = spark.sparkContext.broadcast(longs.view(np.uint64))

    @F.pandas_udf(BooleanType())
    def marked(places: pd.Series) -> pd.Series:
        at = places.to_numpy()
        bits = sent.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
        return pd.Series(bits.astype(bool))
    return marked(place(row))


def repeated(docs, length=LENGTH, unit=1):
    """(row, at, n, kind): the starts of each text, its runs that are met once as a whole, and runs
    of starts in these whose strings are repeated. Starts in no run of kind ONCE are repeated too."""
    spark, docs = docs.sparkSession, placed(docs)
    found = stored(placed_texts(docs).select(
        "row", "text").mapInArrow(
            lambda batches: _anchored(batches, length, unit), "row long, at long, n int, ahead int, gram long, around binary"),
        "suffix_anchors")
    # Equal runs are one pair of gram and identifier, with the first of them as witness; so a
    # passage that very many texts hold is a few pairs in its bucket.
    pairs = stored(found.groupBy("gram", "around").agg(
        F.count("row").alias("copies"), F.min(F.struct("row", "at", "n", "ahead")).alias("first")),
        "suffix_pairs")
    open_ = F.col("copies") == 1

    def known(rows, kind):
        return rows.select("row", F.col("at").cast("long"), F.col("n").cast("long"),
                           F.lit(kind).alias("kind"))
    starts = known(found.groupBy("row").agg(F.sum("n").alias("n"), F.min("at").alias("at")), ALL)
    once = known(pairs.filter(open_).select("first.row", "first.at", "first.n"), ONCE)

    # Undecided runs, and one of each set of equal runs from their buckets.
    buckets = pairs.groupBy("gram").agg(F.count("*").alias("pairs"), F.count_if(open_).alias("open"))
    buckets = buckets.filter("open > 0 AND pairs > 1").drop("open")
    members = pairs.join(buckets, "gram").select(
        "first.row", F.struct("gram", "first.at", "first.n", "first.ahead", open_.alias("open"),
                              (F.col("pairs") > GROUP).alias("big")).alias("w"))
    wanted = stored(members.groupBy("row").agg(F.collect_list("w").alias("wanted")),
                    "suffix_wanted")
    marked = _marked(spark, wanted)
    around = placed_texts(docs).select("row", "text").filter(
        marked).join(wanted, "row").mapInArrow(
        lambda batches: _cut_out(batches, length, unit), "gram long, row long, at long, n int, ahead int, open boolean, big boolean, "
                  "bytes binary")
    around = stored(around, "suffix_around", ["big"])
    small = around.filter("NOT big").repartition("gram").sortWithinPartitions(
        "gram", "row", "at").mapInArrow(
        lambda batches: _refined(batches, length), "row long, at long, n int")
    strings = around.filter("big").mapInArrow(
        lambda batches: _strings(batches, length), "digest binary, row long, at long, open boolean")
    twice = strings.groupBy("digest").count().filter("count > 1").select("digest")
    large = strings.filter("open").join(twice, "digest").select(
        "row", "at", F.lit(1).alias("n"))
    return starts.unionAll(once).unionAll(known(small, AGAIN)).unionAll(known(large, AGAIN))


def _in_order(owner, *columns):
    """``owner`` and ``columns`` sorted by owner and the first column."""
    order = np.lexsort((columns[0], owner))
    return owner[order], *(c[order] for c in columns)


def _covered(rows, at, n, kind, length, unit):
    """(row, spans) of whole texts' runs, those of a text beside each other."""
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rows)]))
    totals = n[kind == ALL]  # one per text
    texts = owner[kind == ALL]
    # What the runs met once leave: from each one's end, or 0, to the next one's start, or the end.
    once = kind == ONCE
    own, begins = _in_order(np.r_[texts, owner[once]],
                            np.r_[np.zeros_like(totals), at[once] + n[once]])
    _, ends = _in_order(np.r_[owner[once], texts], np.r_[at[once], totals])
    left, again = begins < ends, kind == AGAIN
    own = np.r_[own[left], owner[again]]
    lasts = (np.r_[ends[left], (at + n)[again]] - 1) // unit
    at = -(-np.r_[begins[left], at[again]] // unit)
    some = at <= lasts
    own, at, stops = _in_order(own[some], at[some], lasts[some] + length // unit)
    # Each text's places lie above those of the text before, so no span goes on into the next.
    shift = own * (stops.max(initial=0) + 1)
    stops = np.maximum.accumulate(stops + shift)
    opens = np.r_[True, (at + shift)[1:] > stops[:-1]][:len(at)]
    closes = np.r_[opens[1:], True][:len(at)]
    own, at, stops = own[opens], at[opens], (stops - shift)[closes]
    held = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)])
    spans = pa.StructArray.from_arrays([pa.array(at), pa.array(stops)], ["start", "stop"])
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[first][own[held]]),
         pa.ListArray.from_arrays(pa.array(np.r_[held, len(own)], pa.int32()), spans)],
        names=["row", "spans"])


def _merged(batches, length=LENGTH, unit=1):
    """Runs sorted by row to the spans, in units, that the strings met again cover."""
    held = []
    for batch in batches:
        if not len(batch):
            continue
        here = [batch.column(c).to_numpy() for c in ("row", "at", "n", "kind")]
        held.append(here)
        now = here[0][-1]
        if held[0][0][0] == now:
            continue  # all of one text
        here = [np.concatenate(c) for c in zip(*held)]
        end = np.flatnonzero(here[0] != now)[-1] + 1
        yield _covered(*(c[:end] for c in here), length, unit)
        held = [[c[end:] for c in here]]
    if held:
        yield _covered(*(np.concatenate(c) for c in zip(*held)), length, unit)


def spans(docs, length=LENGTH, unit=1):
    """(row, spans): the spans (start, stop) to remove of each row that may have any, stored.

    They are of bytes, or of words if ``unit`` is WORD; in order, disjoint, and do not touch."""
    found = repeated(docs, length, unit).repartition("row").sortWithinPartitions("row")
    return stored(found.mapInArrow(
        lambda batches: _merged(batches, length, unit), "row long, spans array<struct<start:long,stop:long>>"), "suffix_spans")


def _kept_digests(batches):
    for batch in batches:
        out = []
        for text, cut, digest in zip(*(batch.column(c).to_pylist()
                                       for c in ("text", "spans", "kept_sha256"))):
            removed = 0
            if cut:
                raw, at, digester = memoryview(text.encode()), 0, hashlib.sha256()
                for x in cut:
                    digester.update(raw[at:x["start"]])
                    removed += x["stop"] - x["start"]
                    at = x["stop"]
                digester.update(raw[at:])
                digest = digester.hexdigest()
            out.append((removed, len(cut or ()), digest))
        removed, n, digests_ = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
             pa.array(n, pa.int64()), pa.array(digests_, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digests(docs):
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes that stay, per row."""
    docs = placed(docs)
    found = spans(docs)
    marked = _marked(docs.sparkSession, found)
    text = F.coalesce("text", F.lit(""))
    rows = placed_texts(docs).select(
        "row", "doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"), F.when(marked, text).alias("text"))
    return rows.join(found, "row", "left").mapInArrow(
        _kept_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                       "kept_sha256 string")


def _of_words(raw, spans):
    """Byte spans of ``raw`` from spans of words: from the first byte of a word to the last."""
    found = [m.span() for m in re.finditer(rb"[^ \t-\r]+", raw)]
    return [(found[x["start"]][0], found[x["stop"] - 1][1]) for x in spans]


@F.pandas_udf(StringType())
def _cut_texts(text: pd.Series, spans: pd.Series, words: pd.Series) -> pd.Series:
    """Texts without their spans of bytes and words; a character held in part stays."""
    out = []
    for value, cut, more in zip(text, spans, words):
        if cut is None and more is None:
            out.append(value)
            continue
        raw, at, kept = value.encode(), 0, []
        both = [(x["start"], x["stop"]) for x in (() if cut is None else cut)]
        for start, stop in sorted(both + ([] if more is None else _of_words(raw, more))):
            if stop <= at:
                continue
            start = max(start, at)
            while start < stop and raw[start] & 0xC0 == 0x80:
                start += 1
            while stop > start and stop < len(raw) and raw[stop] & 0xC0 == 0x80:
                stop -= 1
            kept.append(raw[at:start])
            at = stop
        out.append(b"".join([*kept, raw[at:]]).decode())
    return pd.Series(out)


def remove(docs, words=None):
    """``docs`` with the repeated strings cut out of ``text``, all columns kept.

    With ``words``, repeated passages of so many words are cut out as well."""
    docs = placed(docs)
    rows, row = numbered(docs)
    cut, more = fresh(rows, "spans"), fresh(rows, "spans_of_words")
    found = spans(docs).withColumn("more", F.lit(None).cast("array<struct<start:long,stop:long>>"))
    if words:
        of_words = spans(docs, words * WORD, WORD).withColumnRenamed("spans", "more")
        found = stored(found.drop("more").join(of_words, "row", "full"), "suffix_both")
    marked = _marked(docs.sparkSession, found, row)
    found = found.select(F.col("row").alias(row), F.col("spans").alias(cut), F.col("more").alias(more))
    changed = rows.filter(marked).join(found, row, "left").withColumn("text", F.when(
        F.col(cut).isNull() & F.col(more).isNull(), F.col("text")).otherwise(
            _cut_texts("text", cut, more)))
    return rows.filter(~marked).drop(row).unionByName(changed.drop(row, cut, more))
