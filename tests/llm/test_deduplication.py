"""SimHash groups, repeated strings and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from playlens.llm import decontaminate, simhash, suffix_dedup
from playlens.llm.common import numbered, placed, without_rows
from playlens.llm.components import components
from tests.conftest import plan, values

from .conftest import DOCS, prose


# ---- components -------------------------------------------------------------------

@pytest.mark.parametrize("edges", [
    [], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(1, 2), (2, 1), (3, 3), (5, 4), (6, 5)]])
def test_components(spark, edges):
    found = dict(values(components(spark.createDataFrame(edges, "u long, v long"))))
    best = {n: n for e in edges for n in e}
    for _ in edges:
        for u, v in edges:
            best[u] = best[v] = min(best[u], best[v])
    assert {n: found.get(n, n) for n in best} == best


# ---- SimHash ----------------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(prints):
    """Component number of each place of ``prints``."""
    at = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and at[i] != at[j]:
                a, b = at[i], at[j]
                at = [b if x == a else x for x in at]
    return at


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_fingerprints_and_groups(odd_documents):
    rows = odd_documents.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    at = reached(prints)
    want = sorted(((r.doc_id, signed(p), min((q.doc_id for q, b in zip(rows, at)
                                              if b == a and q.doc_id is not None), default=None))
                   for r, p, a in zip(rows, prints, at)), key=repr)
    assert values(simhash.groups(odd_documents), "doc_id", "fp", "component_id") == want


@pytest.mark.parametrize("paired", [1, 3, 64])
def test_links_reach_what_all_pairs_reach(spark, paired):
    pick = random.Random(5)
    prints = set()
    for centre in (0, (1 << 64) - 1, 0x123456789ABCDEF0):
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 3))))
    prints = sorted(prints)
    at = reached(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = simhash.links(frame, paired).collect()
    for u, v in edges:
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= (2 if paired == 64 else 4)
    same = dict(values(components(spark.createDataFrame(edges, "u long, v long"))))
    roots = [same.get(signed(p), signed(p)) for p in prints]
    assert all((a == b) == (x == y) for a, x in zip(at, roots) for b, y in zip(at, roots))


def test_one_row_of_each_group_stays(odd_documents):
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids))
    groups = simhash.groups(odd_documents)
    assert kept.count() == groups.select("root").distinct().count()
    assert {r.component_id for r in groups.collect()} == set(ids)


# ---- repeated strings ---------------------------------------------------------------

def plain_repeats(texts, length=400):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    for t in texts:
        hit = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                hit[p:p + length] = b"\1" * length
        kept = bytes(b for b, h in zip(t, hit) if not h)
        yield (len(t), sum(hit), len(re.findall(b"\1+", bytes(hit))),
               hashlib.sha256(kept).hexdigest())


def repeats(docs):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, plain_repeats([r.text for r in rows]))),
                  key=repr)
    return values(suffix_dedup.digests(docs)), want


@pytest.mark.parametrize("group", [4096, 1])
def test_repeated_strings(odd_documents, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    got, want = repeats(odd_documents)
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_repeated_strings_with_edits(documents, seed):
    pick = random.Random(seed)
    source = prose(seed, 1500)
    texts = []
    for _ in range(14):
        a = pick.randrange(len(source) - 1200)
        part = list(source[a:a + pick.randint(350, 1200)])
        for _ in range(pick.randint(0, 2)):
            part[pick.randrange(len(part))] = "#"
        texts.append(prose(pick.random(), 20) + "".join(part) + prose(pick.random(), 20))
    got, want = repeats(documents(*texts))
    assert got == want
    assert sum(x[2] for x in want) > 0


def test_repeated_strings_over_segments(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1500)
    shared = prose(1, 500)
    docs = documents(prose(2, 33) + shared + prose(3, 300), prose(4, 200) + shared)
    rows = [r.text for r in docs.collect()]
    # Settings of this process do not reach the workers, so the operator is called in place.
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"row": [0, 1], "text": rows})
    found = [x for b in suffix_dedup._anchored([batch]) for x in b.to_pylist()]
    starts = Counter((x["row"], x["at"] + i) for x in found for i in range(x["n"]))
    assert starts == Counter((r, p) for r, t in enumerate(rows)
                             for p in range(len(t.encode()) - 399))


def test_copies_are_not_joined_to_their_counts(documents):
    """A passage of every text, whole copies, and texts in which nothing or all is met again."""
    shared = prose(1, 120)
    docs = documents(*[prose(100 + i, 40) + shared + prose(200 + i, 40) for i in range(30)],
                     *[prose(5, 150)] * 9, shared, shared[:399], prose(6, 200), None)
    got, want = repeats(docs)
    assert got == want
    joins = [x for x in plan(suffix_dedup.repeated(docs)).splitlines() if "Join" in x]
    assert joins and not any("around" in x for x in joins)


@pytest.mark.parametrize("unit", [1, 8])
def test_spans_over_batches(unit):
    import pyarrow as pa
    pick = random.Random(unit)
    rows, want = [], {}
    for row in (5, -3, 8, 0, 2, 9):
        size, marks, at = pick.randint(1, 900), [], 0
        while at < size:
            n = min(size - at, pick.randint(1, 90))
            marks.append((at, n, pick.random() < 0.7))
            at += n
        again = [(a + 1, n // 2) for a, n, once in marks if once and n > 3 and pick.random() < 0.3]
        starts = {p for a, n, once in marks if not once for p in range(a, a + n)}
        starts |= {p for a, n in again for p in range(a, a + n)}
        hit = sorted({p // unit + i for p in starts if p % unit == 0 for i in range(400 // unit)})
        want[row] = [(a, b) for a, b in zip(
            [x for x in hit if x - 1 not in hit], [x + 1 for x in hit if x + 1 not in hit])]
        own = [(row, 0, size, suffix_dedup.ALL)]
        own += [(row, a, n, suffix_dedup.ONCE) for a, n, once in marks if once]
        own += [(row, a, n, suffix_dedup.AGAIN) for a, n in again]
        rows += pick.sample(own, len(own))
    names = ["row", "at", "n", "kind"]
    for step in (1, 4, 1000):
        batches = [pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows[i:i + step]))))
                   for i in range(0, len(rows), step)]
        got = {x["row"]: [(s["start"], s["stop"]) for s in x["spans"]]
               for b in suffix_dedup._merged(batches, 400, unit) for x in b.to_pylist()}
        assert got == {r: w for r, w in want.items() if w}


def test_removal_keeps_whole_characters(documents):
    shared = "é" * 300
    docs = documents("a" + shared, "é" + shared[:-1] + "b", "clean", None)
    out = suffix_dedup.remove(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[2] == "clean" and texts[3] is None
    assert "é" not in texts[0] and texts[0].startswith("a")


def plain_passages(texts, words):
    """Texts without the words under a passage of ``words`` words that is met again."""
    texts = [(t or "").split() for t in texts]
    seen = Counter(tuple(t[p:p + words]) for t in texts for p in range(len(t) - words + 1))
    for t in texts:
        hit = {p + i for p in range(len(t) - words + 1) if seen[tuple(t[p:p + words])] > 1
               for i in range(words)}
        yield [w for p, w in enumerate(t) if p not in hit]


def test_passages_of_51_short_words(documents):
    pick = random.Random(3)
    short = [pick.choice("abcdefgh") for _ in range(130)]
    first, second, third = short[:51], short[51:101], short[79:130]
    texts = [" ".join(prose(1, 9).split() + first + prose(2, 70).split() + second), None, "",
             prose(3, 20) + " \n" + "\t ".join(first), prose(4, 60) + " " + " ".join(second),
             " ".join(third[:51]) + " " + prose(5, 8), prose(6, 8) + " " + " ".join(third[-51:]),
             "é" * 900 + " x", "é" * 900]
    assert len(" ".join(first)) < 128
    got = {r.doc_id: r.text for r in suffix_dedup.remove(documents(*texts), 51).collect()}
    for i, want in enumerate(plain_passages(texts[:7], 51)):
        assert (got[i] or "").split() == want
    assert got[1] is None and got[7] == " x" and got[8] == ""
    assert " ".join(second) in got[0] and " ".join(first) not in got[0]


# ---- places of rows -------------------------------------------------------------------

def test_places_do_not_depend_on_the_split(spark, base, documents):
    path = f"{base}/a b%20é=1"
    documents(*[(i, prose(i, 60)) for i in range(400)]).repartition(5).write.option(
        "parquet.block.size", 4096).parquet(path)
    docs = spark.read.parquet(path)
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    try:
        marked, row = numbered(docs.filter("doc_id % 2 = 0"))
        even = spark.createDataFrame(marked.select(row).collect(), "row long")
        before = suffix_dedup.spans(docs)
        for k in was:
            spark.conf.set(k, "7k")
        assert {r.doc_id for r in without_rows(docs, even).collect()} == set(range(1, 400, 2))
        assert values(suffix_dedup.spans(docs)) == values(before)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_rows_that_are_not_of_files_are_written_once(spark, documents):
    docs = documents("a", "b")
    copy = placed(docs)
    assert copy is not docs and placed(copy) is copy
    twice = placed(copy.unionAll(copy))
    marked, row = numbered(twice)
    assert marked.select(row).distinct().count() == 4


# ---- decontamination --------------------------------------------------------------

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(docs, items):
    windows = {}
    for item_id, text in items:
        ws = plain_words(text)
        n = min(13, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        ws, hit, ids = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                if (w := tuple(ws[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[w]
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(ws), len(hit), ids, 20 * len(hit) >= len(ws) and bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, prose(1, 30)), (2, "one"), (3, None), (4, ""), (5, prose(4, 20)), (5, prose(2, 13)),
         (10, prose(1, 25)), (None, prose(3, 14)), (6, "TWO words!"), (7, "é ñas")]


@pytest.mark.parametrize("set_bytes", [1 << 25, 2000])
def test_contamination(spark, odd_documents, set_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(odd_documents, items, set_bytes=set_bytes)
    want = plain_contamination(
        [(r.doc_id, r.text) for r in odd_documents.collect()], ITEMS)
    assert values(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == want
    assert sum(x[2] > 0 for x in want) > 5


def test_removal_of_contamination(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents("(" + prose(7, 40) + ") " + prose(1, 30) + ". " + prose(8, 40), prose(9, 50),
                     None)
    kept = decontaminate.remove_documents(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1, 2]
    cut = decontaminate.remove_spans(docs, items)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {
        0: "(" + prose(7, 40) + ") " + prose(8, 40), 1: prose(9, 50), 2: None}


def test_windows_scan_runs_no_python(spark, odd_documents):
    from tests.conftest import plan
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert "Python" not in plan(decontaminate.contamination(odd_documents, items))


# ---- empty tables -------------------------------------------------------------------

def test_empty_tables(spark, odd_documents):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    for out in (simhash.groups(none), simhash.keep_one(none), suffix_dedup.digests(none),
                suffix_dedup.remove(none), decontaminate.contamination(none, items)):
        assert out.count() == 0
    clean = decontaminate.contamination(odd_documents, items)
    assert clean.filter("n_hit > 0 OR contaminated").count() == 0
    assert clean.count() == odd_documents.count()
