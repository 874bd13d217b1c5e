"""Merge replay, token files and chat formatting: exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from playlens.llm import chat, merge_replay, mixing_coder, pieces, token_files
from tests.conftest import plan, values

from .conftest import DOCS, prose

ODD = ["", " ", "  a  b ", "it's  \n\n x's", "tab\tx y　z", "a" * 301, "12 34  5!? \r\n ok", "\x1c a \x1c",
       "😀😀 é è", "<|endoftext|> x", "\n \n", "x   y", " lead", "trail "]


def sha(x):
    return hashlib.sha256(x).hexdigest()


# ---- byte-level BPE ---------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=merge_replay.read_ranks())


def test_replay_gives_the_ids_of_the_library(odd_documents, documents, library):
    for docs in (odd_documents, documents(*ODD)):
        want = []
        for r in docs.collect():
            ids = library.encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()),
                         sha((r.text or "").encode())))
        assert values(merge_replay.digests(docs)) == sorted(want, key=repr)


def test_words_of_many_blocks(documents, library):
    """Texts of several blocks, one longer than a block, which share words or have their own."""
    pick = random.Random(5)
    own = [" ".join("".join(pick.choices("aehinorst", k=6)) for _ in range(250_000))
           for _ in range(3)]
    docs = documents(own[0] * 3, own[0], None, own[1] + own[2], own[2], "the the", "")
    assert len(own[0]) * 3 > merge_replay.BLOCK_BYTES
    found = {r.doc_id: r.ids for r in merge_replay.encode(docs).collect()}
    want = {r.doc_id: library.encode_ordinary(r.text or "") for r in docs.collect()}
    assert found == want


def test_replay_of_random_words(library):
    pick = random.Random(3)
    replay = merge_replay.Replay(merge_replay.read_ranks())
    words = {bytes(pick.choice(b"aaabehinorst\xc3\xa9'") for _ in range(pick.randint(1, 40)))
             for _ in range(3000)}
    words |= {b"a" * n for n in range(1, 40)}
    words = sorted(words)
    ids, sizes = replay.encode(words)
    ends = np.cumsum(sizes)
    got = [ids[e - n:e].tolist() for e, n in zip(ends, sizes)]
    assert got == [library._encode_single_piece(w) for w in words]


def test_pieces_join_to_the_text():
    for text in [*ODD, prose(1, 50)]:
        first, *rest = pieces.keys(text)
        assert "".join([first[0], *(" " + r for r in rest)]) == text


def test_pieces_are_matched_as_in_their_texts():
    pattern = regex.compile(public_tokenizers.PATTERN)
    new = [k[0] if type(k) is tuple else " " + k for t in [*ODD, prose(1, 50), *ODD] for k in pieces.keys(t)]
    for some in (new, [p for p in new if p[:1] == " " and p.strip() == p[1:] != ""], []):
        words, counts = pieces.matches(pattern, some)
        assert [len(pattern.findall(p)) for p in some] == counts.tolist()
        assert [w for p in some for w in pattern.findall(p)] == words


def test_digests_take_one_worker_a_task(odd_documents):
    assert plan(merge_replay.digests(odd_documents)).count("MapInArrow") == 1


def test_lexicon_forgets_without_harm():
    def encode(new):
        ids = [[ord(c) for c in p] for p in new]
        return (np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids]))
    small = pieces.Lexicon(encode, 2)
    for text in ODD * 2:
        ids, sizes = small.flat([text, "a b", text])
        assert ids.tolist() == [ord(c) for c in text + "a b" + text]
        assert sizes.tolist() == [len(text), 3, len(text)]


# ---- the coder --------------------------------------------------------------------

@pytest.mark.parametrize("ids", [
    [], [0], [50256] * 3, list(range(1000)), [7] * 70_000,
    np.random.default_rng(1).integers(0, 50257, 66_000).tolist(),
    np.random.default_rng(2).zipf(1.3, 140_000).clip(0, 50256).tolist()],
    ids=["none", "one", "few", "rising", "equal", "random", "zipf"])
def test_coder_round_trip(ids):
    data = mixing_coder.encode(ids, 50257)
    assert mixing_coder.decode(data).tolist() == ids


def test_coder_finds_damage_and_starts_anew_per_block():
    size = mixing_coder.LANES * mixing_coder.STEPS
    ids = np.random.default_rng(3).integers(0, 400, 2 * size)
    data = mixing_coder.encode(ids, 500)
    assert data == mixing_coder.encode(ids[:size], 500) + mixing_coder.encode(ids[size:], 500)
    broken = bytearray(data)
    broken[-9] ^= 1
    with pytest.raises(ValueError):
        mixing_coder.decode(bytes(broken))


# ---- token files --------------------------------------------------------------------

def plain_files(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0,
                                                 r.text is not None, r.text or ""))
    start = 0
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        yield (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files(odd_documents, documents, spark, base):
    for docs in (odd_documents, documents(*ODD)):
        assert values(token_files.digests(docs)) == sorted(plain_files(docs), key=repr)
    token_files.write(odd_documents, f"{base}/ids")
    read = token_files.read(spark, f"{base}/ids").collect()
    assert sum(len(r.ids) for r in read) == sum(x[2] for x in plain_files(odd_documents))


def test_words_are_merged_once_as_in_the_library(monkeypatch):
    made = []
    monkeypatch.setattr(token_files, "Known", lambda encode, limit: pieces.Known(
        lambda new: made.extend(new) or encode(new), limit))
    encode, _ = token_files._piece_encoder(token_files.TOKENIZER)
    encode([" the", " the.\nThe", " the,"])
    encode([" the!"])
    assert made.count(" the") == 1
    library = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    library.encode_special_tokens = True
    lexicon = pieces.Lexicon(encode, 20)
    for text in [*ODD, prose(3, 200), "a na\u00efve\u00d7\u00f7 don't 12ab\n\t x <|endoftext|> \u0250 \u0130I \x85 \x1c b\x1f c"]:
        ids, sizes = lexicon.flat([text, "", text + " x"])
        want = [library.encode(t).ids for t in (text, "", text + " x")]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_short_blocks_have_few_lanes():
    assert len(mixing_coder.encode(list(range(300)), 50257)) < 1000


def test_frames_follow_one_another(odd_documents, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(token_files, "FRAME", 700)
    rows = [r.text for r in odd_documents.collect()]
    batch = pa.RecordBatch.from_pydict(
        {"part": pa.array([3] * len(rows), pa.int32()), "doc_id": list(range(len(rows))), "text": rows})
    frames = [x for b in token_files._framed(token_files.TOKENIZER)([batch]) for x in b.to_pylist()]
    assert len(frames) > 3 and [f["frame"] for f in frames] == list(range(len(frames)))
    assert [d for f in frames for d in f["doc_ids"]] == list(range(len(rows)))
    for f in frames:
        assert len(mixing_coder.decode(f["payload"])) == sum(f["sizes"])


# ---- chat ---------------------------------------------------------------------------

MARKS = ["<|im_end|>", "<|im_start|>", "\\", "<|", "im_end|>", "|>", "\n", "a", "<|\\im_end|>", "é"]


def test_turns_are_read_back():
    pick = random.Random(1)
    for _ in range(3000):
        turns = [(pick.choice(["user", "assistant", "", "a\nb", "a\\", "\\!", "<|im_end|>"]),
                  "".join(pick.choice(MARKS) for _ in range(pick.randint(0, 8))))
                 for _ in range(pick.randint(1, 3))]
        shown = [chat.render(*t) for t in turns]
        whole = "".join(s[0] for s in shown)
        assert [t[:2] for t in chat.parse(whole)] == turns
        assert whole.count("<|im_end|>") == whole.count("<|im_start|>") == len(turns)


def test_parser_refuses_what_is_no_turn():
    for text in ("x", "<|im_start|>user\nhello", "<|im_start|>user\na<|im_start|>b<|im_end|>\n",
                 "<|im_start|>user\na<|im_end|>"):
        with pytest.raises(ValueError):
            list(chat.parse(text))


def test_conversations(spark):
    rows = [(1, 1, "assistant", "yes <|im_end|>"), (1, 0, "user", None), (2, 0, None, "x"),
            (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (None, 0, "assistant", "z"),
            (None, None, "user", "<|\\im_end|>"), (3, 5, "assistant", "é" * 30_000),
            (1, 1, "assistant", "yes <|im_end|>")]
    frame = spark.createDataFrame(
        [(*r, "extra", 1) for r in rows],
        "conv_id long, turn long, role string, text string, rendered string, mask_start int")
    want = []
    for conv in {r[0] for r in rows}:
        turns = sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
                        for r in rows if r[0] == conv])
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        text = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        want.append((conv, len(turns), sha(text.encode()), len(loss), sha(loss.encode())))
    got = chat.read_back(chat.format_turns(frame))
    assert values(got.drop("formatted_chars")) == sorted(want, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for out in (merge_replay.digests(none), token_files.digests(none),
                chat.read_back(chat.format_turns(turns))):
        assert out.count() == 0


def test_ranks_are_read_whole():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().split()
    assert merge_replay.read_ranks() == {
        base64.b64decode(a): int(b) for a, b in zip(lines[::2], lines[1::2])}
