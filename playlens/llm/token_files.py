"""Token-id files: texts encoded by the tokenizers library, stored by a context-mixing coder.

Documents are put in order of ``doc_id`` by range partitions. A task encodes its documents with
the library, each distinct piece or word of text once, ends each with id 0, and packs whole documents
into frames of about ``FRAME`` ids. The file format is a Parquet table with a row per frame:
``part`` and ``frame`` give the order, ``doc_ids`` and ``sizes`` the documents in it, and
``payload`` the ids in the coder's blocks, each with its own start and checksum. So any frame
can be read on its own, and a lost task writes its frames again.

Reading decodes frames independently. The place of a frame in all ids is the sum of the
frames before it in its part, by a window within the part, and of the parts before, by a
window over one row per part.

Defined results: a null or empty text has the end id only. A null ``doc_id`` comes first, and
equal ones go by text. Every row gives one row. Strings of special tokens in a text are
ordinary text. Other columns are ignored.
"""

import re
from functools import lru_cache
from itertools import chain, compress
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.llm import mixing_coder
from playlens.llm.common import text_blocks, texts
from playlens.llm.pieces import Known, Lexicon, joined_matches
from playlens.session import work_dir

TOKENIZER = "byte_bpe_50k.json"
END = 0
FRAME = mixing_coder.LANES * mixing_coder.STEPS
BLOCK_BYTES = 4 << 20
REMEMBERED, WORDS = 300_000, 500_000
#: A space and what may follow it, of characters that all Unicode versions class alike: the
#: pattern cuts such pieces as the library does, one by one or joined.
_PLAIN = re.compile(r" (?=\S)[\t\n\r -~\xc0-\u024f]+(?<=\S)")
_FRAMES = ("part int, frame int, doc_ids array<long>, sizes array<long>, payload binary")


@lru_cache(1)
def _lexicon(path):
    """(lexicon, number of ids): kept by a Python worker from task to task."""
    encoder, space = _piece_encoder(path)
    return Lexicon(encoder, REMEMBERED), space


def _byte_letters():
    """The character by which the library's byte level writes each byte, as a translation."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}}


def _piece_encoder(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(path))
    tokenizer.encode_special_tokens = True

    def whole(pieces):
        ids, sizes = [np.zeros(0, np.int32)], []
        for start in range(0, len(pieces), 4000):
            found = [x.ids for x in tokenizer.encode_batch_fast(
                pieces[start:start + 4000], add_special_tokens=False)]
            sizes += map(len, found)
            ids.append(np.fromiter(chain.from_iterable(found), np.int32))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def merged(words):
        written = "\0".join(words).encode().decode("latin-1").translate(letters)
        found = [[t.id for t in tokenize(w)] for w in written.split(letters[0])]
        return (np.fromiter(chain.from_iterable(found), np.int32),
                np.fromiter(map(len, found), np.int64, len(found)))

    tokenize, letters = tokenizer.model.tokenize, _byte_letters()
    pattern, known = regex.compile(public_tokenizers.PATTERN), Known(merged, WORDS)

    def encode(pieces):
        """(ids of all, ids per piece): plain pieces are cut into matches, and the library's model
        merges each distinct one once; the others go through the whole library."""
        fits = [_PLAIN.fullmatch(p) is not None for p in pieces]
        words, counts = joined_matches(pattern, list(compress(pieces, fits)))
        ids, per_word = known.flat(words)
        plain = np.array(fits, bool)
        more, others = whole(list(compress(pieces, (~plain).tolist())))
        sizes = np.zeros(len(pieces), np.int64)
        sizes[plain] = np.diff(np.r_[0, np.cumsum(per_word)][np.r_[0, np.cumsum(counts)]])
        sizes[~plain] = others
        out, from_words = np.empty(int(sizes.sum()), np.int32), np.repeat(plain, sizes)
        out[from_words], out[~from_words] = ids, more
        return out, sizes
    return encode, tokenizer.get_vocab_size(with_added_tokens=True)


def _framed(path):
    def framed(batches):
        lexicon, space = _lexicon(path)
        part, frame, doc_ids, ids, sizes, held = None, 0, [], [], [], 0

        def rows():
            nonlocal frame, doc_ids, ids, sizes, held
            all_ids = np.concatenate(ids)
            row = {"part": part, "frame": frame, "doc_ids": doc_ids, "sizes": sizes,
                   "payload": mixing_coder.encode(all_ids, space)}
            frame, doc_ids, ids, sizes, held = frame + 1, [], [], [], 0
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("part", pa.int32()), ("frame", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                ("sizes", pa.list_(pa.int64())), ("payload", pa.binary())]))

        for block, values in text_blocks(batches, BLOCK_BYTES):
            part = block.column("part")[0].as_py()
            flat, lengths = lexicon.flat([v.decode() for v in values])
            ends = np.cumsum(lengths)
            for doc_id, length, end in zip(block.column("doc_id").to_pylist(),
                                           lengths.tolist(), ends.tolist()):
                if held and held + length + 1 > FRAME:
                    yield rows()
                doc_ids.append(doc_id)
                ids += [flat[end - length:end], np.array([END])]
                sizes.append(length + 1)
                held += length + 1
        if doc_ids:
            yield rows()
    return framed


def write(docs, folder, path=TOKENIZER):
    """Writes the ids of ``docs`` to ``folder``, which all executors must share."""
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(
        _framed(path), _FRAMES).write.parquet(folder)


def _documents(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = mixing_coder.decode(row["payload"])
            ends = np.cumsum(row["sizes"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()),
                 pa.array(row["start"] + ends - row["sizes"], pa.int64()),
                 pa.array([ids[e - n:e] for e, n in zip(ends, row["sizes"])],
                          pa.list_(pa.int64()))], names=["doc_id", "start", "ids"])


def _placed(spark, folder):
    """The frames of ``folder`` with the number of ids before each, ``start``."""
    frames = spark.read.schema(_FRAMES).parquet(folder)
    sizes = frames.select("part", "frame", F.aggregate(
        "sizes", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    first = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # a row per part
    parts = parts.select("part", first.alias("first"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("frame")) - F.col("n")
    starts = sizes.withColumn("inside", inside).join(parts, "part").select(
        "part", "frame", (F.col("first") + F.col("inside")).alias("start"))
    return frames.join(starts, ["part", "frame"])


def read(spark, folder):
    """(doc_id, start, ids) of every document in the files; start: ids of all before it."""
    return _placed(spark, folder).mapInArrow(
        _documents, "doc_id long, start long, ids array<long>")


def _checked(batches):
    for batch in batches:
        out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        for row in batch.to_pylist():
            raw = memoryview(mixing_coder.decode(row["payload"]).astype("<u4")).cast("B")
            end = 0
            for doc_id, n in zip(row["doc_ids"], row["sizes"]):
                out["doc_id"].append(doc_id)
                out["start"].append(row["start"] + end)
                out["n_tokens"].append(n)
                out["ids_crc32"].append(crc32(raw[4 * end:4 * (end + n)]))
                end += n
        yield pa.RecordBatch.from_pydict(out, pa.schema([(c, pa.int64()) for c in out]))


def digests(docs, path=TOKENIZER):
    """doc_id, start, n_tokens and the CRC-32 of the ids of each document, from the files."""
    folder = work_dir(docs.sparkSession, "token_files")
    write(docs, folder, path)
    return _placed(docs.sparkSession, folder).mapInArrow(
        _checked, "doc_id long, start long, n_tokens long, ids_crc32 long")
