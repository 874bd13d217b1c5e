"""A range coder for token ids with adaptive context mixing, in independent blocks.

A block of up to ``LANES * STEPS`` ids is cut into up to ``LANES`` runs of up to ``STEPS`` ids, each
with a range coder of its own, that advance together and share one model. The model starts anew in
every block:

* order 0: a distribution over all ids, from a falling prior and the counts so far, rebuilt
  after the steps in ``REBUILT``;
* orders 1 and 2: the id that last followed the last one or two ids, with a confidence.

Their mixture gives each predicted id a weight of its own on top of a scaled order 0. The
weights adapt: they are the hit rates so far of the two predictions at their confidences. So
an id's interval is found without a sum over ids, and all lanes of a block are
coded as numpy arrays; one model for all of them stays in a core's cache. A block carries its
length and the CRC-32 of its ids, which decoding compares.
"""

import struct
from zlib import crc32

import numpy as np

LANES, STEPS = 2048, 256
REBUILT = (2, 8, 32, 96)
#: Bits of a coded total, of the order-0 total and of the order-2 table.
TOTAL, BASE, HASHED = 22, 17, 17
SURE = 7
_HEAD = struct.Struct("<III")  # ids, id space, checksum
#: What a miss (first half) or a hit adds to a confidence, plus ``_KEEP``; 0: the new id comes in.
_KEEP = 8
_CHANGE = _KEEP + np.array([-_KEEP, *(-(c + 1 >> 1) for c in range(1, SURE + 1)), *[1] * SURE, 0])
_LOW32, _32 = np.uint64(0xFFFFFFFF), np.uint64(32)


class Model:
    """The state of a block of ``lanes`` lanes."""

    def __init__(self, lanes, space):
        self.space = space
        self.last = self.before = np.zeros(lanes, np.int64)
        # The id that came last in a context, times eight, plus the confidence in it.
        self.known1 = np.zeros(space, np.int64)
        self.known2 = np.zeros(1 << HASHED, np.int64)
        # Per kind: both confidences, and whether both predict the same id.
        self.tries, self.hits1, self.hits2 = (np.full(128, x) for x in (2.0, 0.3, 0.5))
        self.hits1[1::2] = 0
        self.counts = 4000 / (np.arange(space) + 64.0)
        self.rebuild(None)

    def rebuild(self, seen):
        """Order 0 from the counts, after ``seen`` (lanes by steps) more ids."""
        if seen is not None:
            self.counts += np.bincount(seen.ravel(), minlength=self.space) * 4.0
        free = (1 << BASE) - self.space
        self.units = 1 + np.floor(self.counts * (free / self.counts.sum())).astype(np.int64)
        self.units[0] += (1 << BASE) - self.units.sum()
        self.starts = np.zeros(self.space + 1, np.int64)
        np.cumsum(self.units, out=self.starts[1:])
        self.inverse = None

    def predict(self):
        self.slot1 = self.last
        self.slot2 = (self.last * 40503 + self.before * 30011) & ((1 << HASHED) - 1)
        self.old1, self.old2 = self.known1[self.slot1], self.known2[self.slot2]
        self.one, self.two = self.old1 >> 3, self.old2 >> 3
        self.c1, self.c2 = self.old1 & SURE, self.old2 & SURE
        self.kind = (self.c2 << 4) + (self.c1 << 1) + (self.one == self.two)
        share = ((1 << TOTAL) - (1 << BASE)) / self.tries
        w1, w2 = (self.hits1 * share).astype(np.int64), (self.hits2 * share).astype(np.int64)
        self.w1, self.w2 = w1[self.kind], w2[self.kind]
        self.scale = ((1 << TOTAL) - w1 - w2)[self.kind]

    def base(self, ids):
        """(start, stop) of ``ids`` in the scaled order 0."""
        return (self.starts[ids] * self.scale >> BASE,
                self.starts[ids + 1] * self.scale >> BASE)

    def interval(self, ids):
        """(start, width) of ``ids`` in a total of 2 ** TOTAL."""
        self.hit1, self.hit2 = self.one == ids, self.two == ids
        start, stop = self.base(ids)
        return (start + self.w1 * (self.one < ids) + self.w2 * (self.two < ids),
                stop - start + self.w1 * self.hit1 + self.w2 * self.hit2)

    def find(self, place):
        """The ids whose intervals hold ``place``."""
        if self.inverse is None:
            self.inverse = np.repeat(np.arange(self.space), self.units)
        (start1, stop1), (start2, stop2) = self.base(self.one), self.base(self.two)
        # Where both predict one id, the first has no weight.
        below1, below2 = self.w1 * (self.one < self.two), self.w2 * (self.two < self.one)
        start1, stop1 = start1 + below2, stop1 + below2 + self.w1
        start2, stop2 = start2 + below1, stop2 + below1 + self.w2
        past1, past2 = place >= stop1, place >= stop2
        rest = place - self.w1 * past1 - self.w2 * past2
        # Inside a predicted interval ``rest`` means nothing and may be too large. The division
        # is exact: its terms have less than 40 bits.
        unit = (((rest + 1 << BASE) - 1) / self.scale).astype(np.int64)
        ids = self.inverse[np.minimum(unit, (1 << BASE) - 1)]
        ids = np.where((place >= start1) & ~past1 & (self.w1 > 0), self.one, ids)
        return np.where((place >= start2) & ~past2, self.two, ids)

    def update(self, ids):
        """After ``interval`` of ``ids``."""
        seen = np.bincount((self.kind << 2) + (self.hit1 * 2 + self.hit2), minlength=512)
        seen = seen.reshape(128, 4)
        self.tries += seen.sum(axis=1)
        self.hits1 += seen[:, 2]
        self.hits2 += seen[:, 1] + seen[:, 3]
        new = ids << 3
        for hit, sure, slot, old, known in (
                (self.hit1, self.c1, self.slot1, self.old1, self.known1),
                (self.hit2, self.c2, self.slot2, self.old2, self.known2)):
            change = _CHANGE[sure + (SURE + 1) * hit]
            known[slot] = np.where(change, old + change - _KEEP, new)
        self.before, self.last = self.last, ids


def _encode_lanes(ids, space):
    """(words, number of words) per lane of ``ids`` (lanes by steps)."""
    lanes, steps = ids.shape
    model = Model(lanes, space)
    every = np.ascontiguousarray(ids.T)
    words = np.zeros((steps + 1, lanes), np.uint64)  # lanes are at about one place
    n = np.zeros(lanes, np.int64)
    low, range_ = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    built = 0

    def carry(which):
        """One more in the words before: an overflow of ``low``."""
        at = n[which] - 1
        while len(which):
            words[at, which] = words[at, which] + np.uint64(1) & _LOW32
            on = words[at, which] == 0
            which, at = which[on], at[on] - 1

    for t in range(steps):
        if t in REBUILT:
            model.rebuild(ids[:, built:t])
            built = t
        model.predict()
        start, width = model.interval(every[t])
        unit = range_ >> np.uint64(TOTAL)
        new = low + unit * start.view(np.uint64)
        if (over := new < low).any():
            carry(np.flatnonzero(over))
        low, range_ = new, unit * width.view(np.uint64)
        full = np.flatnonzero(range_ < np.uint64(1 << 32))
        out = low[full]
        words[n[full], full] = out >> _32
        n[full] += 1
        low[full] = out << _32
        range_[full] <<= _32
        model.update(every[t])
    end = low + _LOW32
    if (over := end < low).any():
        carry(np.flatnonzero(over))
    words[n, np.arange(lanes)] = end >> _32
    return words.T.astype(np.uint32), n + 1


def _decode_lanes(words, steps, space):
    """Ids (lanes by steps) from ``words`` (lanes by at least steps + 2, zeros at the end)."""
    lanes = len(words)
    model = Model(lanes, space)
    ids = np.zeros((steps, lanes), np.int64)
    words = np.ascontiguousarray(words.T)
    code, n = words[0] << _32 | words[1], np.full(lanes, 2)
    range_ = np.full(lanes, ~np.uint64(0))
    built = 0
    for t in range(steps):
        if t in REBUILT:
            model.rebuild(ids[built:t])
            built = t
        model.predict()
        unit = range_ >> np.uint64(TOTAL)
        place = np.minimum(code // unit, np.uint64((1 << TOTAL) - 1)).view(np.int64)
        found = model.find(place)
        start, width = model.interval(found)
        code -= unit * start.view(np.uint64)
        range_ = unit * width.view(np.uint64)
        full = np.flatnonzero(range_ < np.uint64(1 << 32))
        code[full] = code[full] << _32 | words[n[full], full]
        range_[full] <<= _32
        n[full] += 1
        ids[t] = found
        model.update(found)
    return ids.T


def _shape(n):
    """(lanes, steps) of a block of ``n`` ids."""
    lanes = -(-n // STEPS)
    return lanes, -(-n // lanes)


def encode(ids, space):
    """The coded blocks of ``ids`` (integers below ``space``) as bytes."""
    ids = np.asarray(ids, np.int64)
    size, out = LANES * STEPS, []
    for first in range(0, len(ids), size):
        own = ids[first:first + size]
        lanes, steps = _shape(len(own))
        padded = np.zeros(lanes * steps, np.int64)
        padded[:len(own)] = own
        words, n = _encode_lanes(padded.reshape(lanes, steps), space)
        used = words[np.arange(words.shape[1]) < n[:, None]]
        out += [_HEAD.pack(len(own), space, crc32(own.astype("<u4").tobytes())),
                n.astype("<u2").tobytes(), used.astype("<u4").tobytes()]
    return b"".join(out)


def decode(data):
    """The ids of coded blocks; raises where a block's checksum differs."""
    at, out = 0, []
    while at < len(data):
        n, space, check = _HEAD.unpack_from(data, at)
        lanes, steps = _shape(n)
        used = np.frombuffer(data, "<u2", lanes, at + _HEAD.size)
        at += _HEAD.size + 2 * lanes
        total = int(used.sum())
        words = np.zeros((lanes, steps + 3), np.uint64)
        words[np.arange(steps + 3) < used[:, None]] = np.frombuffer(data, "<u4", total, at)
        at += 4 * total
        own = _decode_lanes(words, steps, space).ravel()[:n]
        if crc32(own.astype("<u4").tobytes()) != check:
            raise ValueError("a block's checksum differs")
        out.append(own)
    return np.concatenate(out) if out else np.zeros(0, np.int64)
