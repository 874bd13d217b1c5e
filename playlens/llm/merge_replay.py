"""Byte-level BPE by merge replay, and its decoding.

Texts are cut by ``public_tokenizers.PATTERN``; every match is a word. A task takes its
documents in blocks of ``BLOCK_BYTES`` and gathers the distinct words that it has not yet
encoded. Over all these words an inverted index holds, for each rank, the places of the
token pairs that join to the token of that rank. The ranks are replayed in ascending
order; a merge touches its two neighbours only, whose new pairs go into the index. Words
are independent, so the block in which a word is met does not change its ids; nothing is
shuffled and no key can be hot. What is remembered from block to block is bounded by
``REMEMBERED`` pieces. The digests are made where the ids are: one Python worker a task encodes,
decodes what it has encoded, and hashes both, a block at a time.

Defined results: null and empty texts have no ids and decode to no bytes. A text longer than
a block is a block of its own. Every row gives one row, repeated and null ``doc_id`` included;
an empty table gives no rows. Other columns are ignored.
"""

import base64
import hashlib
from heapq import heappop, heappush
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from playlens.llm.common import text_blocks, texts
from playlens.llm.pieces import Lexicon, gathered, matches

RANKS = "byte_bpe_50k.tiktoken"
BLOCK_BYTES = 4 << 20
REMEMBERED = 250_000


def read_ranks(name=RANKS):
    """Token bytes to rank, from a rank file of the tokenizer folder (or any path)."""
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Replay:
    """Applies the merges of a rank table to lists of words."""

    def __init__(self, ranks):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        cuts = [(ranks[left], ranks[right], rank) for token, rank in ranks.items()
                for i in range(1, len(token))
                if (left := token[:i]) in ranks and (right := token[i:]) in ranks]
        left, right, rank = np.array(cuts or [(0, 0, -1)], np.int64).T
        order = np.argsort(left << 32 | right)
        self.pairs, self.joined = (left << 32 | right)[order], rank[order].astype(np.int32)
        # What two bytes join to, by the two bytes.
        self.of_bytes = self.rank(np.repeat(self.single, 256), np.tile(self.single, 256))

    def rank(self, left, right):
        """The rank of the token that each pair joins to; -1 where there is none."""
        # Negative where a side is a gap or gone, so never found.
        pairs = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.joined[at], -1)

    def encode(self, words):
        """(ids of all words, ids per word) of distinct ``words`` (bytes, none empty)."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        # Symbols by place; a gap of -1 stands before each word and at the end.
        at = np.full(len(raw) + len(words) + 1, -1, np.int32)
        own = np.arange(len(raw), dtype=np.int32) + np.repeat(
            np.arange(1, len(words) + 1, dtype=np.int32), sizes)
        at[own] = self.single[raw]
        after = np.arange(1, len(at) + 1, dtype=np.int32)
        before = np.arange(-1, len(at) - 1, dtype=np.int32)
        # What the pair that starts at each place joins to.
        joins = np.full(len(at), -1, np.int32)
        ends = np.cumsum(sizes)
        firsts = self.of_bytes[raw[:-1].astype(np.int32) << 8 | raw[1:]]
        firsts[ends[:-1] - 1] = -1  # no pair reaches over the end of a word
        joins[own[:-1]] = firsts
        index, ready = {}, []
        self._add(index, ready, own[:-1], firsts)
        while ready:
            merge = heappop(ready)
            found = index.pop(merge)
            places = found[0] if len(found) == 1 else np.concatenate(found)
            places = places[joins[places] == merge]
            if len(places) > 1:
                places = np.sort(places)
                places = places[np.r_[True, places[1:] != places[:-1]]]
            if not len(places):
                continue  # merges before this one took a part of every pair
            seconds = after[places]
            if len(places) > 1 and (seconds[:-1] == places[1:]).any():
                # In a run of pairs that overlap, every other one is merged, from the left.
                first = np.r_[True, seconds[:-1] != places[1:]]
                number = np.arange(len(places))
                run = number - np.maximum.accumulate(np.where(first, number, 0))
                places, seconds = places[run % 2 == 0], seconds[run % 2 == 0]
            at[places], at[seconds], joins[seconds] = merge, -2, -1
            ahead = after[seconds]
            after[places] = ahead
            before[ahead] = places
            changed = np.concatenate([before[places], places])
            ranks = self.rank(at[changed], at[after[changed]])
            joins[changed] = ranks
            self._add(index, ready, changed, ranks)
        done = at[at > -2]
        gaps = np.flatnonzero(done < 0)
        return done[done >= 0], np.diff(gaps) - 1

    def _add(self, index, ready, places, ranks):
        """Enters the pairs that start at ``places`` under the ranks that they join to."""
        known = ranks >= 0
        places, ranks = places[known], ranks[known]
        order = np.argsort(ranks)
        places, ranks = places[order], ranks[order]
        firsts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(ranks) else ranks
        cuts = firsts.tolist()
        for rank, a, b in zip(ranks[firsts].tolist(), cuts, [*cuts[1:], len(ranks)]):
            if rank in index:
                index[rank].append(places[a:b])
            else:
                index[rank] = [places[a:b]]
                heappush(ready, rank)


def _encoder(path):
    def encode(batches):
        replay, pattern = Replay(read_ranks(path)), regex.compile(public_tokenizers.PATTERN)

        def pieces(new):
            words, counts = matches(pattern, new)
            numbers = dict(zip(dict.fromkeys(words), count()))
            ids, sizes = replay.encode([w.encode() for w in numbers])
            used = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            starts = np.cumsum(sizes) - sizes
            ids, sizes = gathered(ids, starts[used], sizes[used])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            return ids, np.diff(ends[np.cumsum(np.r_[0, counts])])

        lexicon = Lexicon(pieces, REMEMBERED)
        for block, values in text_blocks(batches, BLOCK_BYTES):
            ids, sizes = lexicon.flat([v.decode() for v in values])
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), lists.cast(pa.list_(pa.int32()))],
                names=["doc_id", "ids"])
    return encode


def encode(docs, path=RANKS):
    """(doc_id, ids) per row of ``docs``."""
    return texts(docs).mapInArrow(_encoder(path), "doc_id long, ids array<int>")


def _decoder(path):
    def decode(batches):
        ranks = read_ranks(path)
        tokens = np.full(max(ranks.values()) + 1, None, object)
        tokens[list(ranks.values())] = list(ranks)
        for batch in batches:
            place = batch.schema.get_field_index("ids")
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = [b"".join(tokens[x].tolist()) for x in _lists(part.column(place))]
                yield part, part.set_column(place, "decoded", pa.array(out, pa.binary()))
    return decode


def _lists(column):
    """The values of each row of an Arrow list column without nulls, as numpy arrays."""
    ids, ends = column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy())
    return np.split(ids, ends[:-1])


def decode(rows, path=RANKS):
    """``rows`` with their ``ids`` replaced by the bytes they stand for, ``decoded``."""
    fields = ", ".join("decoded binary" if f.name == "ids" else
                       f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(
        lambda batches: (decoded for _, decoded in _decoder(path)(batches)), fields)


def _digested(path):
    def digested(batches):
        shown = np.array([b"%d" % i for i in range(max(read_ranks(path).values()) + 1)], object)
        for rows, decoded in _decoder(path)(_encoder(path)(batches)):
            ids = _lists(rows.column("ids"))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(shown[x].tolist())).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(x.as_buffer()).hexdigest()
                           for x in decoded.column("decoded")])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return digested


def digests(docs, path=RANKS):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the ids and of the bytes decoded."""
    return texts(docs).mapInArrow(
        _digested(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
