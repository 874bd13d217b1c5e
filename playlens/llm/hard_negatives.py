"""Hard negatives by exact inner products in a residue number system.

Vectors become whole numbers, ``floor(256 * x)``. To multiply a block of anchors by a block of
candidates exactly, both are reduced modulo several primes below 1024, with residues around
zero. Then a product of 64 components stays below 2^24 and float32 matrix products are exact; what
is longer is cut into parts of 64. The Chinese remainder theorem, with one signed digit per
prime, gives back the whole signed scores. The number of primes follows from the largest
norm in the table (Cauchy-Schwarz), so no score wraps around.

Anchors meet all rows in cells of at most about ``ANCHORS`` by ``CANDIDATES``, twice: first for
the best rows of the same label (the positives), then for the best rows of other labels whose
score lies in each positive's window. A task holds the anchors of a cell and streams its
candidates; a cell gives at most as many rows per anchor and positive as are asked for, and
ranked windows merge the cells. Nothing is sent to the driver but one row of statistics.

Defined results: rows with a null label, a null vector or a null or non-finite component take
no part. Shorter vectors are filled up with zeros, empty ones too. A null ``vec_id`` is no anchor,
its label stays and it comes last among equals. Rows with the anchor's ``vec_id`` are no
candidates of it. Repeated rows count each, as anchors, positives and negatives. Window
bounds are exact fractions; a negative positive score has an empty window. Scores up to about
5 * 10^17 are exact; a table whose norms allow more raises a ValueError. Other columns are
ignored; an empty table, and one without anchors, gives no rows.
"""

from math import ceil, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import stored

POSITIVES, NEGATIVES = 5, 10
SCALE = 256
ANCHORS, CANDIDATES = 16_384, 8_192
#: Scores in one product of a task, and partitions of a shuffle, at most.
SCORES, PARTITIONS = 1 << 21, 20_000
#: Components in one float32 product; primes whose products of so many stay below 2^24.
WIDTH = 64
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
ALL = (1 << 63) - 1


# ---- exact products ---------------------------------------------------------------------

def primes_for(bound):
    """The primes that tell apart all whole numbers from ``-bound`` to ``bound``."""
    for n in range(1, len(PRIMES) + 1):
        if prod(PRIMES[:n]) > 2 * bound + 1:
            return PRIMES[:n]
    raise ValueError(f"inner products may reach {bound:.3g}, beyond what the primes tell apart")


def residues(x, primes):
    """Whole numbers (float64) modulo each prime, around zero, as float32."""
    out = []
    for p in primes:
        r = np.fmod(x, p)
        r -= p * (r > p // 2)
        r += p * (r < -(p // 2))
        out.append(r.astype(np.float32))
    return out


def products(a, b, primes):
    """The exact inner products (int64) of the rows of two matrices given by ``residues``."""
    score, known = None, 1
    for p, x, y in zip(primes, a, b):
        digit = np.zeros((len(x), len(y)), np.int32)
        for start in range(0, x.shape[1], WIDTH):
            part = x[:, start:start + WIDTH] @ y[:, start:start + WIDTH].T
            digit += part.astype(np.int32) % p
        digit %= p
        if score is None:
            score = digit.astype(np.int64)
        else:  # score + known * step has the right remainder modulo p too
            step = (digit - score) % p * pow(known, -1, p) % p
            score += known * step
        known *= p
    score[score > known // 2] -= known
    return score


# ---- the best of a cell ---------------------------------------------------------------------

class Best:
    """The ``k`` best (score, then first come) of each group of a number of groups."""

    def __init__(self, groups, k):
        self.k, self.least = k, np.full(groups, -ALL - 1)
        self.group = np.zeros(0, np.int64)
        self.score, self.item = self.group, self.group

    def add(self, group, score, item):
        group = np.concatenate([self.group, group])
        score, item = np.concatenate([self.score, score]), np.concatenate([self.item, item])
        order = np.lexsort((-score, group))  # stable: the first come stay first among equals
        group, score, item = group[order], score[order], item[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        full = rank == self.k - 1
        self.least[group[full]] = score[full]
        kept = rank < self.k
        self.group, self.score, self.item = group[kept], score[kept], item[kept]


class Cell:
    """Anchors with windows of scores, and the best candidates seen in each window.

    ``anchors`` holds vec_id, label, matrix, lows and highs (lists, one window per slot)."""

    def __init__(self, anchors, alike, k, primes):
        ids, labels, x, lows, highs = anchors
        self.ids, self.labels, self.x = ids, labels, residues(x, primes)
        self.alike, self.primes, n = alike, primes, len(ids)
        self.slots = max(map(len, lows), default=0)
        self.low = np.full((self.slots, n), ALL)
        self.high = np.full((self.slots, n), -ALL)  # no score: an empty window
        for i, (low, high) in enumerate(zip(lows, highs)):
            self.low[:len(low), i], self.high[:len(high), i] = low, high
        self.best = Best(self.slots * n, k)
        self.step = max(1, SCORES // max(1, n))
        self.seen = []

    def add(self, ids, labels, x):
        """Candidates in ascending order of their ids, over all calls."""
        count = sum(map(len, self.seen))
        self.seen.append(ids)
        for start in range(0, len(ids), self.step):
            rows = slice(start, start + self.step)
            score = products(self.x, residues(x[rows], self.primes), self.primes)
            fits = (self.labels[:, None] == labels[rows]) == self.alike
            fits &= self.ids[:, None] != ids[rows]
            found = []
            for slot in range(self.slots):
                least = self.best.least[slot * len(self.ids):(slot + 1) * len(self.ids), None]
                inside = fits & (score > least) & (score >= self.low[slot][:, None])
                inside &= score <= self.high[slot][:, None]
                i, j = np.nonzero(inside)
                found.append((slot * len(self.ids) + i, score[i, j], count + start + j))
            if any(len(group) for group, _, _ in found):
                self.best.add(*map(np.concatenate, zip(*found)))

    def results(self):
        """(place of the anchor, slot, candidate's id, score) arrays."""
        best, n = self.best, max(1, len(self.ids))
        ids = np.concatenate(self.seen) if self.seen else np.zeros(0, np.int64)
        return best.group % n, best.group // n, ids[best.item], best.score


NO_ID = np.iinfo(np.int64).max  # stands for a null vec_id, which comes last


def _search(alike, k, primes, dim):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "slot", "vec_id", "score")])

    def matrix(rows):
        x = np.zeros((len(rows), dim))
        column = rows.column("x")
        sizes = column.value_lengths().to_numpy()
        flat = column.flatten().to_numpy()
        x[np.repeat(np.arange(len(rows)), sizes),
          np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return x

    def search(batches):
        number, waiting, cell = None, [], None

        def started():
            held = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            return held.column("anchor").to_numpy(), Cell(
                (held.column("vec_id").to_numpy(), held.column("label").to_numpy(), matrix(held),
                 held.column("lows").to_pylist(), held.column("highs").to_pylist()),
                alike, k, primes)

        def results():
            anchors, found = cell
            place, slot, ids, score = found.results()
            return pa.RecordBatch.from_arrays(
                [pa.array(anchors[place]), pa.array(slot),
                 pa.array(ids, mask=ids == NO_ID), pa.array(score)], schema=schema)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            asked = batch.column("anchor").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asked) != 0)) + 1
            for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)]):
                if start == stop:
                    continue
                rows = batch.slice(start, stop - start)
                if cells[start] != number:
                    if cell:
                        yield results()
                    number, waiting, cell = cells[start], [], None
                if asked[start]:
                    waiting.append(rows)
                elif waiting:
                    cell = cell or started()
                    ids = rows.column("vec_id").fill_null(NO_ID).to_numpy()
                    cell[1].add(ids, rows.column("label").to_numpy(), matrix(rows))
        if cell:
            yield results()
    return search


# ---- the plan -------------------------------------------------------------------------------

def usable(vectors: DataFrame):
    """vec_id, label and x (array of doubles, whole numbers) of the rows that take part."""
    x = F.col("x")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"),
        F.transform(F.col("embedding").cast("array<double>"), lambda v: v * SCALE).alias("x")
    ).filter(F.col("label").isNotNull() & x.isNotNull() & finite)


def _met(anchors, rows, shape, alike, k, primes, dim):
    """anchor, slot, vec_id, score: the best of ``rows`` in each window of each anchor, by cell."""
    blocks, cells = shape
    spread = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    number = (F.col("block") * cells + F.col("cell")).cast("long").alias("cell")
    asked = anchors.withColumn("block", spread(blocks, "anchor")).withColumn(
        "cell", every(cells)).select(number, "anchor", "vec_id", "label", "x", "lows", "highs")
    none = F.lit(None)
    met = rows.withColumn("cell", spread(cells, "vec_id", F.monotonically_increasing_id())).withColumn(
        "block", every(blocks)).select(
        number, none.cast("long").alias("anchor"), "vec_id", "label", "x",
        none.cast("array<long>").alias("lows"), none.cast("array<long>").alias("highs"))
    parts = min(PARTITIONS, blocks * cells)
    dealt = asked.unionAll(met).repartitionById(parts, (F.col("cell") % parts).cast("int"))
    ordered = dealt.sortWithinPartitions(
        "cell", F.col("anchor").isNull(), F.col("vec_id").asc_nulls_last())
    found = ordered.mapInArrow(_search(alike, k, primes, dim),
                               "anchor long, slot long, vec_id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors, is_anchor, low=(3, 10), high=(9, 10), positives=POSITIVES,
         negatives=NEGATIVES):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``vec_id``. A negative's score is from ``low`` to ``high``
    times the positive's, as fractions, both ends included."""
    rows = usable(vectors)
    # Rounding down moves a component by less than one.
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + (F.abs(v) + 1) * (F.abs(v) + 1))
    stats = rows.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors"),
                     F.max(F.size("x")).alias("dim"), F.max(square).alias("bound")).first()
    dim = stats["dim"] or 1
    primes = primes_for((stats["bound"] or 0.0) * (1 + 1e-9) + 1)
    shape = max(1, ceil(stats["anchors"] / ANCHORS)), max(1, ceil(stats["n"] / CANDIDATES))
    rows = rows.withColumn("x", F.transform("x", lambda v: F.floor(v).cast("double")))
    anchors = stored(rows.filter(is_anchor).withColumn(
        "anchor", F.monotonically_increasing_id()), "negatives_anchors")

    bounds = [F.array(F.lit(-ALL)).alias("lows"), F.array(F.lit(ALL)).alias("highs")]
    best = stored(_met(anchors.select("*", *bounds), rows, shape, True, positives, primes, dim)
                  .select("anchor", F.col("rank").alias("slot"), "vec_id", "score"),
                  "negatives_positives")

    def times(fraction, up):
        """The score times a fraction, rounded towards the window; no product overflows."""
        n, d = fraction
        whole = F.expr(f"score div {d}")
        rest = (F.col("score") - whole * d) * n
        return whole * n + (F.ceil(rest / d) if up else F.floor(rest / d))

    def bound(fraction, up, empty):
        return F.when(F.col("score") < 0, F.lit(empty)).otherwise(times(fraction, up))

    # At most ``positives`` rows per anchor, in order of their slots.
    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "slot", bound(low, True, ALL).alias("low"), bound(high, False, -ALL).alias("high")))).alias("w"))
    asked = anchors.join(windows, "anchor").select(
        "anchor", "vec_id", "label", "x", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    found = _met(asked, rows, shape, False, negatives, primes, dim).select(
        "anchor", (F.col("slot") + 1).alias("slot"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"), "rank")
    named = best.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return found.join(named, ["anchor", "slot"]).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score")
