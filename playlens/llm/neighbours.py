"""Approximate nearest neighbours by collision counting over single projections.

Vectors are indexed in blocks of about ``BLOCK`` rows. A block holds ``PROJECTIONS`` arrays, each the
block's vectors sorted by one random projection. A query puts a window around its own
projection in every array and counts, per vector, the windows that hold it. A window is the
difference of two prefixes of its array; prefixes are kept as bits per vector at every ``STRIDE`` th
place, so a window is taken whole and only the vectors at its ends one by one. Windows are
widened step by step (virtual rehashing: each width is that of a coarser hash, but centred
at the query). Vectors that collide in ``THRESHOLD`` of the arrays or more are verified by
their inner product; widening ends when there are ``LEAST`` of them, and a share ``VERIFIED``
of the block, and as many as are asked for.

The largest inner product becomes the least distance by one more component: vectors get
what is missing to the largest norm, queries get zero and that norm.

Every query meets every block; blocks and groups of at most about ``QUERIES`` queries are the
groups of a cogrouped map, so tasks are bounded in size and nothing is sent to the driver. The
results of blocks are merged by a ranked window, cut to ``k`` rows per task before the shuffle.
All rows are indexed. The seed is fixed, so results repeat.

Defined results: vectors that are null, empty or zero or hold null or non-finite
components take no part; vectors of another length than the query's are no candidates of
it. Candidates with the query's ``vec_id`` are left out; a null ``vec_id`` is a candidate that
comes last among equals, but no query. Repeated rows count each. Other columns are ignored.
"""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
PROJECTIONS, THRESHOLD, VERIFIED, LEAST = 96, 0.75, 0.15, 256
#: First half width of windows in parts of the largest norm, and its growth per step.
WIDTH, GROWTH = 0.8, 1.2
BLOCK, QUERIES = 8192, 2048
SEED = 20
#: Places of an array from one mark to the next.
STRIDE = 32


def usable(vectors: DataFrame):
    """vec_id, x (array of doubles) and dim of the vectors that take part."""
    x = F.col("x")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x")
    ).filter(x.isNotNull() & finite & F.exists(x, lambda v: v != 0)).withColumn("dim", F.size(x))


class Block:
    """The sorted arrays of some vectors. ``norm`` is at least their largest norm."""

    def __init__(self, ids, x, norm):
        self.ids, self.x, self.norm = ids, x, norm
        rest = np.sqrt(np.maximum(0, norm ** 2 - (x ** 2).sum(1)))
        self.axes = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, PROJECTIONS))
        places = (np.c_[x, rest] @ self.axes).T
        order = np.argsort(places, axis=1, kind="stable")
        # The arrays stand one after another, a gap between them.
        self.gap = 4 * (np.abs(places).max(initial=0) + norm * np.abs(self.axes).max() * 64)
        self.shift = np.arange(PROJECTIONS) * self.gap
        self.arrays = (np.take_along_axis(places, order, axis=1) + self.shift[:, None]).ravel()
        self.marks, self.order = self._marked(order)
        self.first_mark = np.arange(PROJECTIONS) * (len(ids) // STRIDE + 1)
        self.begins = np.arange(PROJECTIONS) * len(ids)
        self.step, self.widths, width = 0, [], WIDTH * norm
        while width < self.gap / 4:
            self.widths.append(width)
            width *= GROWTH
        self.widths.append(self.gap / 4)  # holds whole arrays

    def _marked(self, order):
        """(marks, order): for every ``STRIDE`` th place of each array a bit per vector, set if the
        vector stands before it; and the vectors by array and stride, filled up at the end."""
        n = len(self.ids)
        strides = n // STRIDE + 1
        filled = np.full((PROJECTIONS, strides * STRIDE), n, np.int32)
        filled[:, :n] = order
        marks = np.zeros((PROJECTIONS, strides, -(-n // 64) * 8), np.uint8)
        for array, vectors in zip(marks, order):
            before = np.zeros((strides, 8 * array.shape[1]), np.uint8)
            for i in range(1, strides):
                before[i] = before[i - 1]
                before[i, vectors[(i - 1) * STRIDE:i * STRIDE]] = 1
            array[:] = np.packbits(before, axis=1)
        return marks.reshape(PROJECTIONS * strides, -1).view(np.uint64), filled.reshape(-1, STRIDE)

    def _before(self, at):
        """(marks, vectors): who stands before place ``at`` of each array, as the bits at the last
        mark and the vectors from there to the place."""
        row = at // STRIDE + self.first_mark
        return self.marks[row], self.order[row][np.arange(STRIDE) < (at % STRIDE)[:, None]]

    def counts(self, low, high):
        """Per vector, how many arrays have it at places ``low`` to ``high`` of theirs."""
        n = len(self.ids)
        low, less = self._before(low)
        high, more = self._before(high)
        # Who stands before the low place stands before the high one.
        held = np.unpackbits((low ^ high).view(np.uint8), axis=1, count=n)
        counts = np.add.reduce(held, axis=0, dtype=np.uint8).astype(np.int64)
        return counts + np.bincount(more, minlength=n + 1)[:n] - np.bincount(less, minlength=n + 1)[:n]

    def collided(self, centre, width):
        """The vectors that are in enough windows of ``width`` around ``centre``."""
        low = np.searchsorted(self.arrays, centre - width) - self.begins
        high = np.searchsorted(self.arrays, centre + width, "right") - self.begins
        return np.flatnonzero(self.counts(low, high) >= THRESHOLD * PROJECTIONS)

    def candidates(self, query, k):
        """The vectors that collide with ``query`` often enough to be verified.

        These are those of the first width that gives enough. A wider window gives no fewer, so the
        search for that width may start at the one of the query before."""
        n = len(self.ids)
        enough = min(n, max(k + 1, LEAST, ceil(VERIFIED * n)))
        centre = query * (self.norm / np.sqrt((query ** 2).sum())) @ self.axes[:-1] + self.shift
        found = self.collided(centre, self.widths[self.step])
        if len(found) < enough:
            while len(found) < enough:
                self.step += 1
                found = self.collided(centre, self.widths[self.step])
            return found
        while self.step and len(
                fewer := self.collided(centre, self.widths[self.step - 1])) >= enough:
            self.step, found = self.step - 1, fewer
        return found

    def nearest(self, query_id, query, k):
        """Up to ``k`` (place, score) among the verified, best first."""
        found = self.candidates(query, k)
        found = found[self.ids[found] != query_id]
        # Rows in place are multiplied faster than a third of them is gathered.
        rough = (self.x @ query)[found] if 3 * len(found) > len(self.x) else self.x[found] @ query
        if len(found) > k:
            least = np.partition(rough, -k)[-k]
            near = rough >= least - 1e-9 * (1 + abs(least))
            found = found[near]
        # Summed in one order for every row, so that equal vectors have equal scores.
        scores = (self.x[found] * query).sum(axis=1)
        best = np.lexsort((self.ids[found], -scores))[:k]
        return found[best], scores[best]


def _search(k):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if vectors.num_rows and queries.num_rows:
            def matrix(rows):
                x = rows.column("x").combine_chunks()
                return x.flatten().to_numpy().reshape(len(x), -1)
            last = np.iinfo(np.int64).max
            ids = vectors.column("vec_id").fill_null(last).to_numpy()
            block = Block(ids, matrix(vectors), vectors.column("norm")[0].as_py())
            for number, query_id, query in zip(
                    queries.column("query").to_pylist(), queries.column("query_id").to_pylist(),
                    matrix(queries)):
                places, scores = block.nearest(query_id, query, k)
                out["query"].extend([number] * len(places))
                out["query_id"].extend([query_id] * len(places))
                out["vec_id"].extend(None if i == last else i for i in ids[places].tolist())
                out["score"].extend(scores.tolist())
        return pa.table(out, pa.schema([("query", pa.int64()), ("query_id", pa.int64()),
                                        ("vec_id", pa.int64()), ("score", pa.float64())]))
    return search


def nearest(vectors, is_query, k=K):
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row with ``is_query``."""
    rows = usable(vectors)
    # One row per vector length.
    stats = rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("queries"),
        F.sqrt(F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).alias("norm"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    groups = F.greatest(F.lit(1), F.ceil(F.coalesce("queries", F.lit(0)) / QUERIES)).cast("int")
    stats = stats.select("dim", blocks.alias("blocks"), groups.alias("groups"),
                         (F.col("norm") * (1 + 1e-12)).alias("norm"))
    numbered = rows.withColumn("number", F.monotonically_increasing_id()).join(stats, "dim")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spread = lambda n: F.pmod(F.xxhash64("number"), F.col(n)).cast("int")
    data = numbered.select("dim", spread("blocks").alias("block"), every("groups").alias("group"),
                           "vec_id", "x", "norm")
    asked = numbered.filter(is_query).select(
        F.col("dim").alias("dim"), every("blocks").alias("block"), spread("groups").alias("group"),
        F.col("number").alias("query"), F.col("vec_id").alias("query_id"),
        F.col("x").alias("x"))
    keys = ["dim", "block", "group"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        _search(k), "query long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
