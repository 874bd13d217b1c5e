"""Filter interaction audit: what each filter removes, under every order of the filters.

A table-driven byte transducer reads each text once as UTF-8: every byte has a class, and
the state (inside a word or not) and the class give the next state and what is emitted: a
word's start or end, a capital, a code point, a symbol. A byte's class alone decides the next
state, so a block of texts is run through the tables by numpy at once. The spans of words
are inserted into an open hash table whose every hit is verified by the words' bytes, which
counts distinct words exactly.

Five filters are audited. Each fails a text that

* A: has fewer than 200 words,
* B: has fewer distinct words than half its words,
* C: has more than 2 capitals A-Z per 100 code points,
* D: holds one of ``#$%&*|``,
* E: is identical to the text of a row with a smaller ``doc_id``.

Equal texts fail the same of A to D, so rows are summed up per text and part before any text's
rows meet; a text with very many copies is a few rows. What an order of filters does to a
part depends only on how many rows fail each set of filters, at most 32 counts, from which all
orders are derived; no order is run over the rows.

Texts are read in blocks of ``BLOCK_BYTES``; a longer text is read in pieces cut at white space
and its distinct words are held as a set, so memory is bounded by the words of one text.

Defined results: a null text is empty, and empty texts are identical. A null ``doc_id`` is no
smaller id, its own row never fails E and it has no label; rows with the same id are not
smaller than each other. Repeated rows count each. A document is good or toxic if any of
its labels says so. A null ``source`` is the part of the empty string. Other columns are ignored;
an empty table gives no rows.
"""

import hashlib
import json
import re
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from playlens.llm.common import stored, text_blocks

LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
BLOCK_BYTES = 1 << 20

# ---- the transducer -------------------------------------------------------------------
#: Classes of bytes: white space, capitals, symbols, continuation bytes of UTF-8, all others.
SPACE, CAPITAL, SYMBOL, CONTINUATION, OTHER = range(5)
SPACES = b" \t\n\v\f\r"
CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[list(SPACES)] = SPACE
CLASSES[ord("A"):ord("Z") + 1] = CAPITAL
CLASSES[list(b"#$%&*|")] = SYMBOL
CLASSES[0x80:0xC0] = CONTINUATION
#: States, and the state after a byte of each class, whatever the state before.
OUTSIDE, INSIDE = 0, 1
NEXT = np.array([OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
#: What a byte emits, by state before it and class.
STARTS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8, 16
EMITS = np.array([
    [IS_POINT, STARTS | IS_POINT | IS_CAPITAL, STARTS | IS_POINT | IS_SYMBOL, STARTS,
     STARTS | IS_POINT],
    [IS_POINT | ENDS, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, 0, IS_POINT]], np.uint8)
_EMITTED = np.array([[EMITS[s, c] for c in CLASSES] for s in (OUTSIDE, INSIDE)], np.uint8).ravel()
_AFTER = NEXT[CLASSES].astype(np.uint16) * 256

# ---- the hash table ---------------------------------------------------------------------
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_SHIFTS = np.arange(9, dtype=np.uint64)
#: Masks of the first n bytes of a little-endian number of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(2)
def _powers(n):
    """The powers 0 to n - 1 of the base, and of its inverse, modulo 2^64."""
    def powers(base):
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)
    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def _equal(eights, a, b, lengths):
    """Whether the bytes of ``lengths`` at ``a`` and ``b`` are the same, eight at a time."""
    same = np.ones(len(a), bool)
    at, left = np.arange(len(a)), lengths
    while len(at):
        mask = _FIRST[np.minimum(left, 8)]
        fits = (eights[a] ^ eights[b]) & mask == 0
        same[at[~fits]] = False
        more = fits & (left > 8)
        at, a, b, left = at[more], a[more] + 8, b[more] + 8, left[more] - 8
    return same


def distinct_spans(data, starts, ends, owners):
    """The numbers of those spans that are the first of their bytes to enter the table.

    ``data`` ends in eight bytes of padding. Spans of different ``owners`` are different."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64)
    length = 1 << max(20, (len(data)).bit_length())
    power, inverse = _powers(length)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        (data.astype(np.uint64) + np.uint64(1)) * power[:len(data)])])
    keys = (sums[ends] - sums[starts]) * inverse[starts]
    keys = (keys ^ (owners.astype(np.uint64) << np.uint64(40))) * _SPREAD
    keys ^= keys >> np.uint64(29)
    bits = max(4, (2 * n).bit_length())
    slots = ((keys * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    lengths = ends - starts
    table = np.full(1 << bits, -1, np.int64)
    active = np.arange(n)
    while len(active):
        free = table[slots] < 0
        table[slots[free]] = active[free]
        held = table[slots]
        # The same key is only a hint; owner, length and bytes decide.
        maybe = np.flatnonzero((held != active) & (keys[held] == keys[active])
                               & (lengths[held] == lengths[active])
                               & (owners[held] == owners[active]))
        there = held == active
        there[maybe] = _equal(eights, starts[held[maybe]], starts[active[maybe]],
                              lengths[active[maybe]])
        left = ~there
        active, slots = active[left], (slots[left] + 1) & (len(table) - 1)
    return table[table >= 0]


def scan(texts):
    """Counts of each of ``texts`` (bytes): words, distinct words, capitals, code points,
    symbols, as rows of an array; and the distinct words of all, as (owner, span) arrays."""
    # A white-space byte after each text ends its last word.
    data = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.cumsum(sizes) - sizes
    read = data[:-8]
    before = np.empty(len(read), np.uint16)
    before[0], before[1:] = 0, _AFTER[read[:-1]]
    emitted = _EMITTED[before + read]

    def count(sign):
        return np.add.reduceat((emitted & sign) != 0, begins, dtype=np.int64)
    starts, ends = np.flatnonzero(emitted & STARTS), np.flatnonzero(emitted & ENDS)
    words = count(STARTS)
    owners = np.repeat(np.arange(len(texts)), words)
    first = distinct_spans(data, starts, ends, owners)
    counts = np.stack([words, np.bincount(owners[first], minlength=len(texts)), count(IS_CAPITAL),
                       count(IS_POINT) - 1, count(IS_SYMBOL)], axis=1)
    return counts, (starts[first], ends[first])


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def scan_long(text, limit=BLOCK_BYTES):
    """The counts of one text, read in pieces of about ``limit`` bytes."""
    total, seen, at = np.zeros(5, np.int64), set(), 0
    while at < len(text):
        found = _SPACE.search(text, at + limit)
        piece = text[at:found.end()] if found else text[at:]
        counts, spans = scan([piece])
        total += counts[0]
        seen.update(piece[s:e] for s, e in zip(*(x.tolist() for x in spans)))
        at += len(piece)
    total[1] = len(seen)
    return total


def fails(counts):
    """Bits 0 to 3 for the filters A to D, from rows of counts."""
    words, distinct, capitals, points, symbols = counts.T
    return ((words < LEAST_WORDS) * 1 + (100 * distinct < LEAST_DISTINCT * words) * 2
            + (100 * capitals > MOST_CAPITALS * points) * 4 + (symbols > 0) * 8)


def _scanned(batches):
    for block, values in text_blocks(batches, BLOCK_BYTES):
        if len(values) == 1 and len(values[0]) > BLOCK_BYTES:
            counts = scan_long(values[0])[None]
        else:
            counts, _ = scan(values)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), block.column("part"),
             pa.array([hashlib.sha256(v).digest() for v in values], pa.binary()),
             pa.array(fails(counts).astype(np.int32))]
            + [pa.array(c) for c in counts.T],
            names=["doc_id", "part", "digest", "fails", *COUNTS])


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")
_SCANNED = ("doc_id long, part string, digest binary, fails int, "
            + ", ".join(f"{c} long" for c in COUNTS))


def measures(docs):
    """Per row: doc_id, part, SHA-256 of the text, the failed filters A to D as bits, counts."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text")).mapInArrow(_scanned, _SCANNED)


# ---- sets of failed filters -----------------------------------------------------------------

SUMS = ("n", "good", "toxic")


def failed_sets(docs, labels):
    """part, fails, n, good, toxic: rows of a part by the set of all five filters they fail."""
    rows = stored(measures(docs).select("doc_id", "part", "digest", "fails"), "filter_measures")
    alike = rows.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    marks = labels.filter("doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.max((F.col(c).cast("int") == 1).cast("long")), F.lit(0)).alias(name)
          for c, name in (("quality", "good"), ("toxic", "toxic"))])
    marked = alike.join(marks, "doc_id", "left").select(
        "doc_id", "part", "digest", "fails", "n",
        *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in SUMS[1:]])
    # Of a text in a part: all rows, those without an id, and those of the smallest id.
    known = F.col("doc_id").isNotNull()
    texts = marked.groupBy("digest", "part", "fails").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        *[F.coalesce(F.sum(F.when(~known, F.col(c))), F.lit(0)).alias(f"unnamed_{c}")
          for c in SUMS],
        F.min(F.when(known, F.struct("doc_id", *SUMS))).alias("first"))
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    is_first = F.col("first.doc_id") == F.col("least")
    kept = {c: F.col(f"unnamed_{c}") + F.when(is_first, F.col(f"first.{c}")).otherwise(0)
            for c in SUMS}
    copies = 1 << LETTERS.index("E")
    split = F.explode(F.array(
        F.struct(F.col("fails"), *[kept[c].alias(c) for c in SUMS]),
        F.struct((F.col("fails") + copies).alias("fails"),
                 *[(F.col(c) - kept[c]).alias(c) for c in SUMS])))
    return texts.join(least, "digest").select("part", split.alias("x")).select(
        "part", "x.*").filter("n > 0").groupBy("part", "fails").agg(
        *[F.sum(c).alias(c) for c in SUMS])


def steps():
    """(filter_order, step, its filter's bit, the bits of the filters before it) of all orders."""
    out = []
    for order in permutations(LETTERS):
        before = 0
        for i, letter in enumerate(order):
            bit = 1 << LETTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": i + 1, "bit": bit,
                        "before": before})
            before |= bit
    return out


def audit(docs, labels):
    """A row per part, order of the filters and step, with what the step's filter does there."""
    parts = failed_sets(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("fails", *SUMS)).alias("sets"))  # at most 32 sets of filters
    every = F.explode(F.from_json(
        F.lit(json.dumps(steps())),
        "array<struct<filter_order:string,step:int,bit:int,before:int>>")).alias("s")
    bit, before = F.col("s.bit"), F.col("s.before")

    def total(where, column="n", weight=None):
        value = (lambda x: x[column]) if weight is None else (lambda x: x[column] * weight(x))
        return F.aggregate(F.filter("sets", where), F.lit(0).cast("long"),
                           lambda a, x: a + value(x))

    def failing(x):
        return x["fails"].bitwiseAND(bit) != 0

    def earlier(x):
        return x["fails"].bitwiseAND(before) != 0

    def removed(x):
        return failing(x) & ~earlier(x)

    # Of the filters that a row fails, each comes first in an equal share of the 120 orders.
    orders = len(steps()) // len(LETTERS)
    share = lambda x: F.floor(F.lit(orders) / F.bit_count(x["fails"]))
    return parts.select("part", "sets", every).select(
        "part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"),
        total(lambda x: ~failing(x) & ~earlier(x)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda x: failing(x) & earlier(x)).alias("redundant"),
        total(lambda x: x["fails"] == bit).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(failing, weight=share).alias("shapley"))
