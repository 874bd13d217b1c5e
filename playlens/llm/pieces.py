"""Cutting texts into pieces that byte-level BPE encodes one by one.

Text may be cut before a single space between two characters that are not white space: no
match of ``public_tokenizers.PATTERN`` reaches over that place, since a space goes with what
follows it. So the pieces can be encoded on their own, each distinct piece once, and the
ids of a text are the ids of its pieces in order.
"""

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")
_WHITE = "".join(filter(str.isspace, map(chr, range(0x3001))))  # all that ``str.strip`` takes


def keys(text):
    """``text`` cut before its single spaces. The first piece is given as a 1-tuple, the
    others without their leading space."""
    cut = text.split(" ")
    if list(map(str.strip, cut)) != cut or "" in cut:  # spaces beside more white space
        cut = _CUT.split(text)
    cut[0] = (cut[0],)
    return cut


def matches(pattern, new):
    """(matches of ``pattern`` in all pieces one after another, how many each piece has).

    Pieces that may follow one another in a text are matched as one text."""
    joins = np.fromiter((p[:1] == " " and p[1:] == p.strip() != "" for p in new), bool, len(new))
    joined = [p for p, j in zip(new, joins.tolist()) if j]
    if len(joined) < len(new):
        # The others are matched by themselves, in their places.
        found, counts = matches(pattern, joined)
        found, out = iter(found), []
        counts_of_all = np.zeros(len(new), np.int64)
        counts_of_all[joins] = counts
        for i, j in enumerate(joins.tolist()):
            own = list(islice(found, counts_of_all[i])) if j else pattern.findall(new[i])
            counts_of_all[i] = len(own)
            out += own
        return out, counts_of_all
    return joined_matches(pattern, new)


def joined_matches(pattern, new):
    """``matches`` of pieces that may follow one another."""
    words = pattern.findall("".join(new))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    stops = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
    return words, np.diff(np.searchsorted(ends, np.r_[0, stops], "right"))


class _Places(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Known:
    """Ids of distinct keys, kept between calls up to ``limit`` keys.

    ``encode`` takes a list of new keys and returns (ids of all, ids per key). The limit
    is on what is remembered only: a forgotten key is encoded again."""

    def __init__(self, encode, limit):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self):
        self.places, self.starts = _Places(), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def flat(self, keys):
        """(ids, lengths): the ids of all keys one after another, and how many each has."""
        if len(self.places) > self.limit:
            self.clear()
        used = np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))
        return self.taken(used)

    def taken(self, used):
        """``flat`` of the keys at the places ``used``, new ones being encoded first."""
        known = len(self.starts) - 1
        if len(self.places) > known:
            ids, sizes = self.encode(list(self.places)[known:])
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        firsts = self.starts[used]
        return gathered(self.ids, firsts, self.starts[used + 1] - firsts)


class Lexicon(Known):
    """Ids of the distinct pieces of texts; ``encode`` takes a list of new pieces."""

    def __init__(self, encode, limit):
        super().__init__(lambda new: encode(
            [k[0] if type(k) is tuple else " " + k for k in new]), limit)

    def _used(self, texts):
        """The places of the pieces of each text; Arrow cuts, so a piece is looked up once."""
        place = self.places.__getitem__
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = parts.offsets.to_numpy()
        found = parts.flatten().dictionary_encode()
        values, used = found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)
        size = pc.binary_length(found.dictionary).to_numpy()
        odd = size != pc.binary_length(pc.utf8_trim(found.dictionary, _WHITE)).to_numpy()
        odd |= size == 0
        firsts = bounds[:-1]
        plain = ~np.logical_or.reduceat(odd[used], firsts) if len(texts) else odd
        inside = np.repeat(plain, np.diff(bounds))
        inside[firsts] = False
        places = np.zeros(len(values), np.int64)
        later = np.flatnonzero(np.bincount(used[inside], minlength=len(values)))
        places[later] = np.fromiter((place(values[i]) for i in later.tolist()), np.int64, len(later))
        openings = [place((values[i],)) for i in used[firsts[plain]].tolist()]
        used = places[used]
        used[firsts[plain]] = openings
        return [used[a:b] if p else np.fromiter(map(place, keys(t)), np.int64)
                for t, a, b, p in zip(texts, bounds.tolist(), bounds[1:].tolist(), plain.tolist())]

    def flat(self, texts):
        """(ids, lengths): the ids of all texts one after another, and how many each has."""
        if len(self.places) > self.limit:
            self.clear()
        used = self._used(texts)
        bounds = np.cumsum([0, *map(len, used)])
        ids, sizes = self.taken(np.concatenate(used) if used else np.zeros(0, np.int64))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[bounds])


def gathered(values, starts, sizes):
    """(values[s:s + n] of all runs one after another, sizes)."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - ends + sizes, sizes)], sizes
