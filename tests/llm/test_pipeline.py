"""The registered queries against SQL, and the corpus pipeline against brute force."""

import glob
import os
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from playlens.llm import merge_replay, sql
from playlens.llm.common import stored, table
from tests.conftest import SAMPLE, values

from .test_deduplication import plain_contamination, plain_fingerprint, reached
from .test_encoding import sha


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(sql.QUERIES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SAMPLE}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS FROM '{path}'")
    got = entry.queries()[name](spark, SAMPLE)
    want = con.sql(sql.QUERIES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got, *want.columns) == sorted(want.fetchall(), key=repr)


def plain_hits(values, length):
    """Per sequence, whether each item is in a string of ``length`` that also starts elsewhere."""
    seen = Counter(v[p:p + length] for v in values for p in range(len(v) - length + 1))
    for v in values:
        hit = [False] * len(v)
        for p in range(len(v) - length + 1):
            if seen[v[p:p + length]] > 1:
                hit[p:p + length] = [True] * length
        yield hit


def plain_cuts(texts):
    """Texts without whole characters under repeated strings of 400 bytes, and without repeated
    passages of 51 words with the white space between their words."""
    raw = [t.encode() for t in texts]
    words = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", r)] for r in raw]
    by_words = plain_hits([tuple(r[a:b] for a, b in w) for r, w in zip(raw, words)], 51)
    for text, r, spans, hit, hit_words in zip(texts, raw, words, plain_hits(raw, 400), by_words):
        gone = [False] * len(r)
        for i, (a, b) in enumerate(spans):
            if hit_words[i]:
                joined = i + 1 < len(spans) and hit_words[i + 1]
                gone[a:spans[i + 1][0] if joined else b] = [True] * ((spans[i + 1][0] if joined else b) - a)
        at, kept = 0, []
        for c in text:
            size = len(c.encode())
            if not (all(hit[at:at + size]) or all(gone[at:at + size])):
                kept.append(c)
            at += size
        yield "".join(kept)


def test_stages(spark):
    docs = table(spark, SAMPLE, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SAMPLE, "labels").collect()}
    names, stages = zip(*corpus_pipeline.STAGES)
    results = []
    for name, stage in zip(names, stages):
        out = stage(spark, docs, SAMPLE)
        docs = stored(out, f"test_{name}")
        results.append(docs)
        if name != "tokens":
            assert docs.columns == table(spark, SAMPLE, "documents").columns
    good, single, cut, clean, tokens = [r.collect() for r in results]
    before = table(spark, SAMPLE, "documents").collect()

    kept = {r.doc_id for r in good}
    wrong = sum((d in kept) != bool(q) for d, q in labels.items())
    assert wrong <= 0.02 * len(labels) and {tuple(r) for r in good} <= {tuple(r) for r in before}

    at = reached([plain_fingerprint(r.text) for r in good])
    first = {}
    for r, a in zip(good, at):
        first[a] = min(first.get(a, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(first.values())

    plain = dict(zip([r.doc_id for r in single], plain_cuts([r.text for r in single])))
    assert {r.doc_id: r.text for r in cut} == plain
    assert all(r.n_chars == len(r.text) for r in cut)

    items = [(r.item_id, r.text) for r in table(spark, SAMPLE, "benchmark").collect()]
    bad = {x[0] for x in plain_contamination([(r.doc_id, r.text) for r in cut], items) if x[-1]}
    assert sorted(map(tuple, clean)) == sorted(tuple(r) for r in cut if r.doc_id not in bad)

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=merge_replay.read_ranks())
    want = []
    for r in clean:
        ids = library.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()),
                     sha(r.text.encode())))
    assert sorted(map(tuple, tokens)) == sorted(want)
    assert values(corpus_pipeline.run(spark, SAMPLE)) == sorted(want, key=repr)
