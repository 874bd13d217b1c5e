"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the hashed words of a text is trained in numpy from two samples:
confirmed toxic documents, and documents of any kind, whose labels are not looked at. The
risk of the negatives is that of the unlabelled less ``prior`` times that of the positives
taken as negatives; where this estimate falls below zero, the step goes the other way, so
that the classifier cannot profit from fitting the positives out of the unlabelled (Kiryo
et al., 2017). The prior is the toxic share of the labelled training rows. Only words get a
weight whose share of documents differs between the positive and all texts by ``EVIDENCE``
standard errors and by ``RATIO`` times or more, so a long text does not gather noise.

These shares are counted by Spark over all texts of the training fold and all positives in it,
so the evidence for a rare word grows with the corpus. A telling word that the sample of
positives does not hold, and no step could move, starts at the log of the ratio of its shares
in the positives and, corrected by the prior, in the negatives.

Bounds: the steps run over at most ``POSITIVES`` and ``UNLABELLED`` documents, those whose ids
have the smallest hashes; they must be in the training fold. Prior and shares cover all
training rows, in ``SLOTS`` counts a task, and every whole text is scored. Labels, language,
source and ids are no inputs of a score.

Defined results: null and empty texts have no words and get the score of the intercept.
Without a positive example every score is the prior, 0 without any label. A document with
several labels counts as toxic if one says so; labels without a value or a document are
unused. Every row gives one row. Other columns are ignored.
"""

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from playlens.llm.common import bitmap, bucket, cut, has_bit, text_blocks, texts

FOLDS = 5
POSITIVES, UNLABELLED = 2000, 16_000
SLOTS = 1 << 18
ROUNDS, STEP, BELOW, EVIDENCE, RATIO = 200, 1.0, 0.0, 5.0, 1.25
#: Bits of the map of labelled ids that spares other texts a shuffle; it errs on the safe side.
MAP_BITS = 1 << 19
BLOCK_BYTES = 8 << 20
REMEMBERED = 1_000_000

#: A-Z to lower case, every other ASCII character but a-z to a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32
                 for b in range(256))


class _Slots(dict):
    def __missing__(self, word):
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = slot = crc32(word) % SLOTS
        return slot


def words(text):
    return text.translate(_LETTERS).split()


def _features(batches):
    slots = _Slots().__getitem__
    for block, values in text_blocks(batches, BLOCK_BYTES):
        found = [sorted(set(map(slots, words(v)))) for v in values]
        yield pa.RecordBatch.from_arrays(
            [block.column("toxic"), pa.array(found, pa.list_(pa.int32()))],
            names=["toxic", "slots"])


def _frequencies(batches):
    slots, texts_seen, counts = _Slots().__getitem__, 0, np.zeros(SLOTS, np.int64)
    for _, values in text_blocks(batches, BLOCK_BYTES):
        texts_seen += len(values)
        for value in values:
            counts[list(set(map(slots, set(words(value)))))] += 1
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(  # -1 stands for the number of texts
        [pa.array(np.append(held, -1)), pa.array(np.append(counts[held], texts_seen))],
        names=["slot", "n"])


def frequencies(rows):
    """(texts, per slot the texts that have it) of all ``rows``, counted by Spark."""
    found = rows.select("text").mapInArrow(_frequencies, "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n")).toArrow()  # SLOTS rows at most
    slots, n = found.column("slot").to_numpy(), found.column("n").to_numpy()
    counts = np.zeros(SLOTS)
    counts[slots[slots >= 0]] = n[slots >= 0]
    return float(n[slots < 0].sum()), counts


def _labelled(labels):
    """(doc_id, toxic) of the labelled ids in the training fold."""
    return (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
            .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .filter(bucket(F.col("doc_id"), FOLDS) != 0))


def _training(docs):
    return texts(docs).filter(bucket(F.col("doc_id"), FOLDS) != 0)


def shares(docs, labels):
    """``frequencies`` of all positives and of all texts in the training fold."""
    positives = _labelled(labels).filter("toxic = 1").select("doc_id")
    train, place = _training(docs), F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))
    near = train.filter(has_bit(bitmap(positives.select(place), MAP_BITS), place))
    return frequencies(near.join(positives, "doc_id", "left_semi")), frequencies(train)


def samples(docs, labels):
    """(toxic, slots) rows of the two training samples, and the class prior."""
    known = _labelled(labels)
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    train = _training(docs)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]

    def smallest(ids, n, toxic):
        # The ids are bounded, so they are sent to the documents and no text is shuffled.
        chosen = cut(ids.select("doc_id").distinct().orderBy(*order).limit(n))
        rows = train.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
        return rows.select(F.lit(toxic).alias("toxic"), "text")

    both = smallest(known.filter("toxic = 1"), POSITIVES, 1).unionAll(
        smallest(train.filter(F.col("doc_id").isNotNull()), UNLABELLED, 0))
    return both.mapInArrow(_features, "toxic int, slots array<int>"), prior


class _Rows:
    """Documents as runs of slots."""

    def __init__(self, lists):
        self.n = len(lists)
        self.of = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.slots = np.concatenate([*lists, np.zeros(0)]).astype(np.int64)

    def scores(self, weights, intercept):
        return intercept + np.bincount(self.of, weights[self.slots], self.n)

    def gradient(self, slopes):
        """By weights and intercept, of the mean over documents."""
        return np.bincount(self.slots, slopes[self.of], SLOTS) / self.n, slopes.mean()


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(positives, everything):
    """The slots whose shares of texts differ between the two ``frequencies`` beyond chance."""
    (n, a), (m, b) = positives, everything
    share = (a + b + 1) / (n + m + 2)
    error = np.sqrt(share * (1 - share) * (1 / n + 1 / m))
    p, u = a / n, b / m
    return (np.abs(p - u) >= EVIDENCE * error) & (np.maximum(p, u) >= RATIO * np.minimum(p, u))


def _by_share(positives, everything, prior):
    """Log ratios of the shares of slots in the positives and the negatives, one more text each."""
    (n, a), (m, b) = positives, everything
    p, u = (a + 1) / (n + 2), (b + 1) / (m + 2)
    return np.log(p / np.maximum((u - prior * p) / (1 - prior), 1 / (m + 2)))


def train(positive, unlabelled, prior, counts):
    """(weights, intercept) that lower the non-negative risk under the logistic loss.

    ``counts`` are the ``shares`` of the whole training fold."""
    weights = np.zeros(SLOTS)
    start = np.clip(prior, 1e-3, 1 - 1e-3)
    intercept = float(np.log(start / (1 - start)))
    if not positive or not unlabelled or not prior:
        return weights, intercept if prior else -np.inf
    p, u = _Rows(positive), _Rows(unlabelled)
    used = telling(*counts)
    if prior < 1:
        unseen = used & (np.bincount(p.slots, minlength=SLOTS) == 0)
        weights = np.where(unseen, np.maximum(_by_share(*counts, prior), 0), 0)
    # Adaptive steps: slots that are rarely seen still move.
    seen, seen_0 = np.full(SLOTS, 1e-12), 1e-12
    for _ in range(ROUNDS):
        fp, fu = p.scores(weights, intercept), u.scores(weights, intercept)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gu, gu0 = u.gradient(_sigmoid(fu))
        gn, gn0 = p.gradient(prior * _sigmoid(fp))
        gp, gp0 = p.gradient(-prior * _sigmoid(-fp))
        if negative >= BELOW:
            g, g0 = gp + gu - gn, gp0 + gu0 - gn0
        else:
            g, g0 = gn - gu, gn0 - gu0
        seen += g * g
        seen_0 += g0 * g0
        pace = STEP / np.sqrt(seen + 1e-6)
        weights -= pace * np.where(used, g, 0)
        intercept -= STEP / np.sqrt(seen_0 + 1e-3) * g0
    return weights, float(intercept)


def fit(docs, labels):
    """(weights, intercept) from the training fold of ``docs`` and ``labels``."""
    rows, prior = samples(docs, labels)
    found = rows.toArrow()
    toxic = np.array(found.column("toxic").to_pylist(), bool)
    lists = found.column("slots").combine_chunks()
    pick = lambda which: [lists[int(i)].values.to_numpy() for i in np.flatnonzero(which)]
    return train(pick(toxic), pick(~toxic), prior, shares(docs, labels))


def score(docs, model):
    """(doc_id, score, predicted) of every row."""
    weights, intercept = model
    kept = np.flatnonzero(weights)
    known = dict(zip(kept.tolist(), weights[kept].tolist()))

    def scorer(batches):
        slots = _Slots().__getitem__
        for block, values in text_blocks(batches, BLOCK_BYTES):
            sums = [sum(known[s] for s in set(map(slots, set(words(v)))) & known.keys())
                    for v in values]
            found = _sigmoid(np.array(sums, float) + intercept)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(found),
                 pa.array((found >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"])
    return texts(docs).mapInArrow(scorer, "doc_id long, score double, predicted int")


def classify(docs, labels):
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", "predicted")
