"""Language-model scores by prediction by partial matching, and a unigram base score.

The model is a trie of byte contexts of up to five bytes, pretrained on the training fold.
Each training text gives its bytes and an end symbol; at every place the last ``ORDER`` symbols
(the start of a text is padded) count the symbol that follows. These counts are summed by
Spark over the whole fold; the counts of shorter contexts are their sums. A symbol's
probability in a context of ``k`` bytes with total ``T`` and ``D`` distinct successors is its count
over ``T + D``; otherwise the context escapes with ``D / (T + D)`` to the one a byte shorter
(method C). What a longer context has seen is excluded there: as a successor of a
context is one of each shorter context too, the excluded count and number of a level are
fixed sums per longer context, and the probability has a closed form. Below the empty
context all symbols that it has not seen are equally likely. A text's score is the sum over
its bytes and the end symbol, in log10.

The texts are read once. The most frequent strings of ``ORDER + 1`` symbols, at most
``TRIE_ROWS`` of them, are broadcast with their probabilities and looked up in place; each row's
other strings, with how often it has them, are joined to the trie by a shuffle and summed up
per row. What the trie does not hold is resolved once per distinct string, level by level,
by joins to the tables of contexts. So neither the driver nor a broadcast holds more than
``TRIE_ROWS`` rows of the trie, whatever its size, and no pass is added as it grows. Each level
is written before the next one, which takes on the strings that are still without an end, so
no plan holds the joins of more than one level and their stages do not all run at once.

The base score is that of a unigram word model with 0.1 added to every count. Word counts are
a grouped sum. Their most frequent words, as many as fit ``HOT_BYTES`` by count, are
broadcast and looked up where the texts are read; each text's other words are joined to the
counts by a shuffle, in which no word can be hot, and summed up per row.

Defined results: a null or empty text has the end symbol only. A text longer than a block is
read in pieces that overlap by a context. Rows are told apart by their place in the files,
so repeated and null ``doc_id`` give a row each; a null id counts as empty text in the fold.
With an empty training fold all bytes are equally likely and the base score is that of one
word unseen; an empty table gives no rows. Other columns are ignored.
"""

from collections import Counter
from functools import reduce
from math import fsum, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bucket, placed, placed_texts, stored, text_blocks, texts

FOLDS = 10
ORDER = 5
END = 0xFF  # a byte that UTF-8 never holds: the end of a text, and the padding before it
ADDED = 0.1
TRIE_ROWS = 2_000_000
#: Bytes of frequent words, of 60 and their length each, that are looked up in place.
HOT_BYTES = 16 << 20
BLOCK_BYTES = 2 << 20
#: Bytes of text that are looked up at once: a worker holds some 130 bytes for each beside its table.
LOOKUP_BYTES = 512 << 10
_PAD = bytes([END]) * ORDER


def _windows(raw):
    """The strings of ORDER + 1 symbols at every place but the first ORDER."""
    raw = np.frombuffer(raw, np.uint8)
    grams = np.zeros(len(raw) - ORDER, np.uint64)
    for i in range(ORDER + 1):
        grams <<= np.uint64(8)
        grams |= raw[i:len(raw) - ORDER + i]
    return grams


def _grams(values, limit):
    """(strings at every place of the texts, symbols per text), in parts of about ``limit``."""
    if len(values) == 1 and len(values[0]) > limit:
        raw = _PAD + values[0] + b"\xff"
        for start in range(0, len(raw) - ORDER, limit):
            grams = _windows(raw[start:start + limit + ORDER])
            yield grams, np.array([len(grams)])
        return
    grams = _windows(b"".join([_PAD + v + b"\xff" for v in values]))
    sizes = np.array([len(v) + 1 for v in values])
    # Between two texts there are ORDER strings that end in padding.
    ends = np.cumsum(sizes + ORDER)
    inside = np.ones(len(grams) + ORDER, bool)
    for i in range(ORDER):
        inside[ends - 1 - i] = False
    yield grams[inside[:len(grams)]], sizes


def _count(batches):
    limit = BLOCK_BYTES * 2
    for _, values in text_blocks(batches, limit):
        for part, _ in _grams(values, limit):
            grams, counts = np.unique(part, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["gram", "n"])


def train(docs):
    """(gram, n): the counts of ORDER + 1 symbols of ``docs``, stored; the trie with all its orders."""
    counts = texts(docs).select("text").mapInArrow(_count, "gram long, n long")
    return stored(counts.groupBy("gram").agg(F.sum("n").alias("n")), "ppm_trie")


def _last(column, symbols):
    return F.col(column).bitwiseAND(F.lit((1 << 8 * symbols) - 1))


def _before(column):
    """The context of a string."""
    return F.shiftright(F.col(column), 8)


def levels(trie):
    """The counts of strings of ORDER + 1 symbols and fewer, by the length of their context."""
    found = {ORDER: trie}
    for k in range(ORDER - 1, -1, -1):
        found[k] = stored(found[k + 1].groupBy(_last("gram", k + 1).alias("gram")).agg(
            F.sum("n").alias("n")), f"ppm_level_{k}")
    return found


def seen(trie):
    """(gram, n, logp): the probabilities of the strings that the trie holds, stored."""
    contexts = trie.groupBy(_before("gram").alias("context")).agg(
        (F.sum("n") + F.count("n")).alias("space"))
    return stored(trie.withColumn("context", _before("gram")).join(contexts, "context").select(
        "gram", "n", F.log10(F.col("n") / F.col("space")).alias("logp")), "ppm_seen")


def _contexts(grams, shorter, k):
    """(context, total, distinct, excluded) of contexts of ``k`` symbols; excluded is the count, among
    the successors of the context a byte shorter, of those that it has seen itself."""
    rows = grams.select(_before("gram").alias("context"), "n", _last("gram", k).alias("below"))
    if shorter is None:
        rows = rows.withColumn("m", F.lit(0))
    else:
        rows = rows.join(shorter.select(F.col("gram").alias("below"), F.col("n").alias("m")), "below")
    return rows.groupBy("context").agg(F.sum("n").alias("total"), F.count("n").alias("distinct"),
                                       F.sum("m").alias("excluded"))


def resolved(missing, found):
    """(gram, logp) of strings that the trie does not hold, by the closed form.

    ``found`` are its ``levels``. Tables of contexts of two symbols and fewer are small by their
    nature and broadcast; the others are joined as Spark sees fit."""
    state = missing.select("gram", F.lit(0.0).alias("logp"),
                           F.lit(0).cast("long").alias("gone_n"), F.lit(0).cast("long").alias("gone_d"))
    ended = []
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    for k in range(ORDER, -1, -1):
        contexts = _contexts(found[k], found[k - 1] if k else None, k)
        grams = found[k].select(F.col("gram").alias("own"), F.col("n").alias("hit"))
        if k <= 2:  # 256 ** k contexts at most
            contexts = F.broadcast(contexts)
        if k <= 1:
            grams = F.broadcast(grams)
        state = state.withColumn("context", _last("gram", k + 1)).withColumn(
            "own", F.col("context")).withColumn("context", _before("context"))
        state = state.join(contexts, "context", "left")
        if k < ORDER:  # at the longest context none is found
            state = state.join(grams, "own", "left")
        else:
            state = state.withColumn("hit", F.lit(None).cast("long"))
        distinct = zero("distinct") - F.col("gone_d")
        space = zero("total") - F.col("gone_n") + distinct
        hit = F.col("hit").isNotNull()
        # Where everything is excluded there is nothing to escape from.
        step = F.when(hit, F.log10(F.col("hit") / space)).when(
            space > 0, F.log10(distinct / space)).otherwise(0.0)
        state = stored(state.select(
            "gram", (F.col("logp") + step).alias("logp"), hit.alias("done"),
            zero("excluded").alias("gone_n"), zero("distinct").alias("gone_d")), f"ppm_escaped_{k}")
        ended.append(state.filter("done").select("gram", "logp"))
        state = state.filter("NOT done").drop("done")
    symbols = found[0].agg(F.count("*")).first()[0]  # 256 at most
    unseen = log10(256 - symbols) if symbols < 256 else 0.0
    return reduce(DataFrame.unionAll, ended, state.select("gram", (F.col("logp") - unseen).alias("logp")))


class _Table:
    """A hash table of grams to log10 probabilities, for looking up arrays."""

    def __init__(self, keys, values):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, ~np.uint64(0)), np.zeros(size)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == ~np.uint64(0)
            self.keys[at[free]] = keys[left[free]]  # of several, one stays
            mine = self.keys[at] == keys[left]
            self.values[at[mine]] = values[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & (size - 1)

    def _slot(self, keys):
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys):
        """(values, found)."""
        at = self._slot(keys)
        there = self.keys[at]
        found, values = there == keys, self.values[at]
        left = np.flatnonzero(~found & (there != ~np.uint64(0)))
        spot = at[left]
        while len(left):
            spot = (spot + 1) & ((1 << self.bits) - 1)
            there = self.keys[spot]
            hit = there == keys[left]
            found[left[hit]], values[left[hit]] = True, self.values[spot[hit]]
            go = ~hit & (there != ~np.uint64(0))
            left, spot = left[go], spot[go]
        return values, found


def _frequent_grams(known, most):
    """(least count, grams, logs): the strings with counts of 2 ** j up that are ``most`` at most."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = dict(known.groupBy(level.alias("j")).count().collect())  # 64 rows at most
    least = 0
    for j in sorted(sizes, reverse=True):
        most -= sizes[j]
        if most < 0:
            least = j + 1
            break
    found = known.filter(level >= least).select("gram", "logp").toArrow()
    return (1 << least if least else 0, found.column("gram").to_numpy().astype(np.uint64),
            found.column("logp").to_numpy())


def _per_row(places, grams, ends):
    """(row numbers, grams, counts): the grams at ``places``, each once per row."""
    rows = np.searchsorted(ends, places, "right")
    found = grams[places]
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    first = np.flatnonzero(np.concatenate(
        [np.ones(min(1, len(rows)), bool), (np.diff(rows) != 0) | (np.diff(found) != 0)]))
    return rows[first], found[first], np.diff(np.append(first, len(rows)))


_READ = "row long, doc_id long, symbols long, logs double, grams array<long>, counts array<long>"


def _looked_up(batches, sent):
    """Rows to the sums of what the frequent strings (``sent``) give, and their other strings."""
    table = None
    for block, values in text_blocks(batches, LOOKUP_BYTES):
        table = table or _Table(*sent.value)
        symbols, total, rest = np.zeros(len(values), np.int64), np.zeros(len(values)), []
        for here, sizes in _grams(values, LOOKUP_BYTES):
            found, there = table.find(here)
            found[~there] = 0
            ends = np.cumsum(sizes)
            symbols += sizes
            total += np.add.reduceat(found, ends - sizes)
            rest.append(_per_row(np.flatnonzero(~there), here, ends))
        rows, others, counts = (np.concatenate(x) for x in zip(*rest))
        offsets = pa.array(np.searchsorted(rows, np.arange(len(values) + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [block.column("row"), block.column("doc_id"), pa.array(symbols), pa.array(total),
             pa.ListArray.from_arrays(offsets, pa.array(others.astype(np.int64))),
             pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))],
            names=["row", "doc_id", "symbols", "logs", "grams", "counts"])


def score(docs, trie, trie_rows=TRIE_ROWS):
    """(row, doc_id, score) of each row of ``docs`` under the trie of ``train``."""
    known = seen(trie)
    least, grams, logs = _frequent_grams(known, trie_rows)
    if not len(grams) and known.isEmpty():  # nothing was learned: all symbols are alike
        lengths = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
        return placed_texts(docs).select("row", "doc_id", (lengths * -log10(256)).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((grams, logs))

    rows = stored(placed_texts(docs).mapInArrow(
        lambda batches: _looked_up(batches, sent), _READ), "ppm_rows")
    sent.unpersist()  # the rows are written; workers let go of it with their next task
    rare = rows.select("row", F.explode(F.arrays_zip("grams", "counts")).alias("x")).select(
        "row", F.col("x.grams").alias("gram"), F.col("x.counts").alias("n"))
    missing = stored(rare.select("gram").distinct().join(known, "gram", "left_anti"), "ppm_missing")
    logp = known.filter(F.col("n") < least).select("gram", "logp").unionAll(
        resolved(missing, levels(trie)))
    sums = stored(rare.join(logp, "gram").groupBy("row").agg(
        F.sum(F.col("n") * F.col("logp")).alias("rare_logs")), "ppm_rare_logs")
    return rows.join(sums, "row", "left").select(
        "row", "doc_id", (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))).alias("score"))


def words(text):
    """Words of a text (bytes), A-Z in lower case, and the end token, which is empty."""
    return [*text.lower().split(), b""]


def _word_counts(batches):
    for _, values in text_blocks(batches, BLOCK_BYTES * 4):
        found = Counter(w for v in values for w in words(v))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
            names=["word", "c"])


def word_counts(docs):
    """(word, c): counts over all texts of ``docs``, stored."""
    found = texts(docs).select("text").mapInArrow(_word_counts, "word binary, c long")
    return stored(found.groupBy("word").agg(F.sum("c").alias("c")), "ppm_words")


def _frequent(counts, most):
    """(least count, rows) of the frequent words that fit ``most`` bytes: counts of 2 ** j up."""
    level = F.floor(F.log2("c")).cast("int")
    sizes = dict(counts.groupBy(level.alias("j")).agg(
        F.sum(F.octet_length("word") + 60)).collect())  # 64 rows at most
    least = 0
    for j in sorted(sizes, reverse=True):
        most -= sizes[j]
        if most < 0:
            least = j + 1
            break
    return 1 << least, counts.filter(level >= least).toArrow()


def base(docs, counts, hot_bytes=HOT_BYTES):
    """(row, n_tokens, n_known, train_tokens, base_score) of each row of ``docs``, stored."""
    size, total = counts.agg(F.count("*"), F.sum("c")).first()
    total = total or 0
    below = log10(total + ADDED * (size + 1))
    least, frequent = _frequent(counts, hot_bytes)
    sent = docs.sparkSession.sparkContext.broadcast(dict(zip(
        frequent.column("word").to_pylist(),
        np.log10(frequent.column("c").to_numpy() + ADDED).tolist())))

    def read(batches):
        for part, values in text_blocks(batches, BLOCK_BYTES * 4):
            hot, n, known, logs, rare = sent.value, [], [], [], []
            for value in values:
                found = words(value)
                here = [hot[w] for w in found if w in hot]
                n.append(len(found))
                known.append(len(here))
                logs.append(fsum(here))
                rare.append([w for w in found if w not in hot])
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(logs, pa.float64()), pa.array(rare, pa.list_(pa.binary()))],
                names=["row", "n_tokens", "n_known", "logs", "rare"])

    rows = stored(placed_texts(docs).mapInArrow(
        read, "row long, n_tokens long, n_known long, logs double, rare array<binary>"),
        "ppm_base")
    sent.unpersist()
    unseen = log10(ADDED)
    rare = (rows.select("row", F.explode("rare").alias("word"))
            .join(counts.filter(F.col("c") < least), "word", "left").groupBy("row").agg(
                F.count("c").alias("rare_known"),
                F.sum(F.coalesce(F.log10(F.col("c") + ADDED), F.lit(unseen))).alias("rare_logs")))
    return stored(rows.join(rare, "row", "left").select(
        "row", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * below
         ).alias("base_score")), "ppm_base_scores")


def scores(docs):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Both models learn from the rows outside the held-out fold."""
    docs = placed(docs)
    fold = texts(docs).filter(bucket(F.col("doc_id"), FOLDS) != 0)
    base_scores = base(docs, word_counts(fold))
    model = score(docs, train(fold))
    return model.join(base_scores, "row").select(
        "doc_id", (bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "n_tokens",
        "n_known", "train_tokens", "base_score", "score")
