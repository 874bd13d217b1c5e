"""Neighbours, language-model scores, quality and toxicity."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from playlens.llm import neighbours, ppm, quality, toxicity
from tests.conftest import SAMPLE, values
from pyspark.sql import functions as F

from .conftest import DOCS, prose


# ---- neighbours -------------------------------------------------------------------

def plain_nearest(rows, k):
    kept = [(i, np.array(x, float)) for i, x in rows
            if x and all(v is not None and math.isfinite(v) for v in x) and any(x)]
    out = {}
    for q, x in kept:
        if q is not None and q % 20 == 0:
            other = [(-(y * x).sum(), i is None, i or 0) for i, y in kept
                     if i != q and len(y) == len(x)]
            out[q] = [(None if n else i, -s) for s, n, i in sorted(other)[:k]]
    return out


def test_few_vectors_are_searched_exactly(spark):
    pick = np.random.default_rng(1)
    rows = [(i, pick.standard_normal(8).astype(np.float32).tolist()) for i in range(200)]
    rows += [(200 + i, rows[40][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] * 4), (None, rows[3][1]),
             (304, [float("nan")] * 8), (305, [float("inf")] * 8), (320, [1.0, 2.0]), (321, [2.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                  "vec_id long, embedding array<float>, dim int, norm int")
    got = defaultdict(list)
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = plain_nearest(rows, 20)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 150)
    monkeypatch.setattr(neighbours, "QUERIES", 10)
    frame = spark.read.parquet(f"{SAMPLE}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    want = plain_nearest(rows, 20)
    got = defaultdict(set)
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[q] & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("n", [1, 31, 32, 200])
def test_windows_are_counted_as_they_are(n, monkeypatch):
    pick = np.random.default_rng(n)
    monkeypatch.setattr(neighbours, "LEAST", 5)
    x = pick.standard_normal((n, 6))
    x[n // 2:] = x[0]  # ties
    block = neighbours.Block(np.arange(n), x, np.sqrt((x ** 2).sum(1)).max())
    for query in pick.standard_normal((20, 6)):
        low = pick.integers(0, n + 1, neighbours.PROJECTIONS)
        high = low + pick.integers(0, n + 1 - low)
        order = np.argsort(block.arrays.reshape(-1, n), axis=1, kind="stable")
        held = np.concatenate([block.order.reshape(neighbours.PROJECTIONS, -1)[i, a:b]
                               for i, (a, b) in enumerate(zip(low, high))])
        assert (order == np.arange(n)).all()
        assert block.counts(low, high).tolist() == np.bincount(held, minlength=n).tolist()
        # The width found is the first that gives enough, wherever the search for it begins.
        found = []
        for block.step in (0, len(block.widths) - 1):
            found.append((block.candidates(query, 5).tolist(), block.step))
        assert found[0] == found[1] and len(found[0][0]) >= min(n, 6)


# ---- language model ---------------------------------------------------------------

def plain_scores(rows):
    train = [(t or "").encode() for d, t in rows if crc32(str(d if d is not None else "").encode()) % 10]
    order = ppm.ORDER
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    words = Counter()
    for t in train:
        s = [255] * order + list(t) + [255]
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[i - k:i])][s[i]] += 1
        words.update([*t.lower().split(), b""])
    total = sum(words.values())
    for d, t in rows:
        t, score = (t or "").encode(), 0.0
        s = [255] * order + list(t) + [255]
        for i in range(order, len(s)):
            gone = set()
            for k in range(order, -1, -1):
                seen = {a: n for a, n in counts[k].get(tuple(s[i - k:i]), {}).items()
                        if a not in gone}
                if not seen:
                    continue
                space = sum(seen.values()) + len(seen)
                if s[i] in seen:
                    score += math.log10(seen[s[i]] / space)
                    break
                score += math.log10(len(seen) / space)
                gone |= set(seen)
            else:
                score -= math.log10(256 - len(gone))
        own = [*t.lower().split(), b""]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in own)
        yield (d, crc32(str(d if d is not None else "").encode()) % 10 == 0, len(own),
               sum(w in words for w in own), total, round(base, 6), round(score, 6))


@pytest.mark.parametrize("few", [False, True])
def test_scores(documents, monkeypatch, few):
    rows = [(i, prose(i, 30)) for i in range(25)] + [
        (30, None), (31, ""), (None, "zz ZZ Ünknown"), (7, prose(7, 30)), (7, "xyz qq"), (40, prose(99, 2000))]
    docs = documents(*rows)
    fold = docs.filter(~F.col("doc_id").isNull() | F.lit(True))
    if few:  # several blocks of the trie, hardly any frequent words
        train = fold.filter(ppm.bucket(F.col("doc_id"), 10) != 0)
        model = ppm.score(docs, ppm.train(train), trie_rows=300)
        base = ppm.base(docs, ppm.word_counts(train), hot_bytes=500)
        got = model.join(base, "row").select(
            "doc_id", (ppm.bucket(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known",
            "train_tokens", F.round("base_score", 6), F.round("score", 6))
    else:
        got = ppm.scores(docs).select(
            "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6),
            F.round("score", 6))
    want = sorted(plain_scores(rows), key=repr)
    for a, b in zip(values(got), want, strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], atol=2e-6)


def test_memory_of_looking_strings_up():
    """An executor holds two such workers beside its heap; the sums are those of one text at a time."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    texts = [prose(i, 300) for i in range(900)] + [prose(7, 120_000)]
    batch = pa.RecordBatch.from_pydict({"row": range(901), "doc_id": range(901), "text": texts})
    known = np.unique(ppm._windows(b"".join(t.encode() for t in texts[:20])))
    sent = SimpleNamespace(value=(known, np.arange(len(known)) / -7))
    tracemalloc.start()
    try:
        found = [x for b in ppm._looked_up([batch], sent) for x in b.to_pylist()]
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    logs = dict(zip(known.tolist(), sent.value[1].tolist()))
    for i in (0, 500, 900):
        grams = Counter(ppm._windows(ppm._PAD + texts[i].encode() + b"\xff").tolist())
        got = found[i]
        rest = Counter()
        for g, n in zip(got["grams"], got["counts"]):
            rest[g] += n
        assert got["row"] == i and got["symbols"] == len(texts[i].encode()) + 1
        assert {g % 2 ** 64: n for g, n in rest.items()} == {g: n for g, n in grams.items() if g not in logs}
        assert math.isclose(got["logs"], sum(n * logs.get(g, 0) for g, n in grams.items()), abs_tol=1e-6)


def test_scores_join_one_level_at_a_time(documents, monkeypatch):
    """The driver holds a plan's stages and broadcasts at once, so a level's joins are run by themselves."""
    joins, write = [], ppm.stored

    def counted(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, name)

    monkeypatch.setattr(ppm, "stored", counted)
    rows = [(i, prose(i, 30)) for i in range(25)] + [(30, "xyz qq"), (40, prose(99, 500))]
    out = counted(ppm.scores(documents(*rows)), "ppm_test")
    assert max(joins) <= 3
    got = {r.doc_id: r.score for r in out.collect()}
    assert got == pytest.approx({r[0]: r[-1] for r in plain_scores(rows)}, abs=2e-6)


def test_scores_without_training_rows(documents, spark):
    held = [i for i in range(100) if crc32(str(i).encode()) % 10 == 0]
    out = ppm.scores(documents((held[0], "abc"))).collect()
    assert len(out) == 1 and math.isclose(out[0].score, -4 * math.log10(256))
    assert ppm.scores(spark.createDataFrame([], DOCS)).count() == 0


# ---- quality ----------------------------------------------------------------------

def labelled(spark, rows, column):
    return spark.createDataFrame(rows, f"doc_id long, {column} int, score string")


def test_quality_tells_loud_text_from_prose(spark, documents):
    rows = [(i, prose(i, 60)) if i % 3 else (i, prose(i, 60).upper().replace(" ", "!! "))
            for i in range(150)] + [(None, None), (200, ""), (7, prose(7, 60))]
    docs = documents(*rows)
    labels = labelled(spark, [(i, int(i % 3 > 0), "x") for i in range(0, 120)]
                      + [(130, None, "x"), (None, 1, "x"), (7, 1, "x")], "quality")
    out = quality.classify(docs, labels)
    assert out.count() == len(rows)
    for r in out.collect():
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 150:
            assert r.keep == (r.doc_id % 3 > 0)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == out.filter("keep").count()


def test_sparse_sites_shrink_to_the_level_above(spark):
    rows = [("big", "a", 0.9)] * 400 + [("big", "b", 0.2)] * 300 + [("bad", "a", 0.05)] * 200
    rows += [("tiny", "a", 0.05), (None, None, 0.5), ("big", "c", 0.1)]
    found, whole = quality.posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    mean = whole["mean"]
    at = {(r.host, r.path): r for r in found.collect()}
    assert len(at) == 6
    assert at["bad", "a"].host_posterior < 0.1 < at["tiny", "a"].host_posterior < mean
    assert at["big", "b"].path_posterior < at["big", "c"].path_posterior < at["big", "a"].path_posterior


def plain_scores_of_sites(rows):
    """(score, host posterior, path posterior) of (host, path, evidence) rows, each from all others."""
    def weight(sites):
        total = sum(n for n, _, _ in sites)
        squares = sum(n * (s / n - a) ** 2 for n, s, a in sites)
        noises = sum(a * (1 - a) for _, _, a in sites)
        inner = sum(n * a * (1 - a) for n, _, a in sites)
        between = (squares - noises) / total if len(sites) > 1 else 0
        return 1e6 if between <= 0 else min(1e6, max(1.0, inner / total / between - 1))

    def sums(keys):
        found = defaultdict(lambda: [0, 0.0])
        for key, (_, _, p) in zip(keys, rows):
            found[key][0] += 1
            found[key][1] += p
        return found

    mean = sum(p for _, _, p in rows) / len(rows)
    hosts, paths = sums([r[0] for r in rows]), sums([r[:2] for r in rows])
    k = weight([(n, s, mean) for n, s in hosts.values()])
    above = {h: (s + k * mean) / (n + k) for h, (n, s) in hosts.items()}
    m = weight([(n, s, above[h]) for (h, _), (n, s) in paths.items()])
    odds = lambda x: math.log(x / (1 - x))
    for h, path, p in rows:
        rest = (mean * len(rows) - p) / (len(rows) - 1)
        n, s = hosts[h]
        host = (s - p + k * rest) / (n - 1 + k)
        n, s = paths[h, path]
        own = (s - p + m * host) / (n - 1 + m)
        yield 1 / (1 + math.exp(-(odds(p) + odds(own) - odds(rest)))), host, own


def test_scores_of_sites_leave_the_own_document_out(spark, documents):
    pick = random.Random(8)
    rows = [(i, prose(i, 60) if pick.random() < 0.3 + 0.1 * (i % 5) else
             prose(i, 60).upper().replace(" ", "!! ")) for i in range(120)]
    docs = documents(*rows).withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 3)).withColumn(
        "source", F.when(F.col("doc_id") == 119, "sole").when(F.col("doc_id") % 5 < 4, F.concat(
            F.lit("s"), F.col("doc_id") % 5)))  # every fifth has no host
    labels = labelled(spark, [(i, int(t != t.upper()), "x") for i, t in rows[:80]], "quality")
    out = sorted(quality.classify(docs, labels).collect(), key=lambda r: r.doc_id)
    want = plain_scores_of_sites([(r.host, r.path, r.evidence) for r in out])
    for r, w in zip(out, want, strict=True):
        assert np.allclose((r.score, r.host_posterior, r.path_posterior), w, atol=1e-9)
        assert r.keep == (r.score >= 0.5)


def test_sites_of_addresses(spark, documents):
    urls = ["http://A.example.com/fr/825?x=1", "https://b.org", "https://b.org:80/#top", "nothing", None]
    docs = documents(*["a b c"] * 5).withColumn("url", F.element_at(
        F.array(*[F.lit(u) for u in urls]), (F.col("doc_id") + 1).cast("int")))
    out = quality.classify(docs, labelled(spark, [], "quality")).collect()
    assert [(r.host, r.path) for r in sorted(out, key=lambda r: r.doc_id)] == [
        ("a.example.com", "fr"), ("b.org", ""), ("b.org", ""), ("", ""), (None, None)]


def test_quality_of_a_very_long_text(spark, documents):
    sizes = [20, 50, 300, 2000]
    docs = documents((0, prose(0, 60_000)), *[(i, prose(i, sizes[i % 4])) for i in range(1, 20)],
                     *[(i, prose(i, sizes[i % 4]).upper().replace(" ", "!! "))
                       for i in range(20, 40)])
    labels = labelled(spark, [(i, int(i < 20), "x") for i in range(1, 40)], "quality")
    found = {r.doc_id: r.keep for r in quality.classify(docs, labels).collect()}
    assert found[0] and not found[30]


def test_quality_without_labels_keeps_all(spark, documents):
    docs = documents("a b", None, "C")
    none = labelled(spark, [], "quality")
    assert quality.keep_good(docs, none).count() == 3
    assert quality.classify(spark.createDataFrame([], DOCS), none).count() == 0


# ---- toxicity ---------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark, documents):
    pick = random.Random(1)
    bad = {i for i in range(600) if pick.random() < 0.3}
    docs = documents(*[(i, prose(i, 40) + (" you moron " + prose(-i - 1, 5) if i in bad else ""))
                       for i in range(600)], (None, None), (700, ""), (5, "moron"))
    labels = labelled(spark, [(i, int(i in bad), "x") for i in range(0, 600, 2)]
                      + [(900, 1, "x"), (None, 1, "x"), (3, None, "x")], "toxic")
    out = toxicity.classify(docs, labels).collect()
    assert len(out) == 603
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    right = sum(r.predicted == (r.doc_id in bad) for r in held)
    assert right >= 0.95 * len(held) and len(held) > 80
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_toxicity_ignores_held_out_labels(spark, documents):
    docs = documents(*[(i, prose(i, 20) + (" moron" if i % 4 == 0 else "")) for i in range(200)])
    held = lambda i: crc32(str(i).encode()) % 5 == 0
    first = labelled(spark, [(i, int(i % 4 == 0), "x") for i in range(200)], "toxic")
    second = labelled(spark, [(i, int(i % 4 == 0) ^ held(i), "x") for i in range(200)], "toxic")
    assert values(toxicity.classify(docs, first)) == values(toxicity.classify(docs, second))


def test_shares_are_counted_over_all_training_rows(spark, documents, monkeypatch):
    rows = [(i, prose(i, 12) + (" moron" if i % 3 == 0 else "")) for i in range(90)]
    rows += [(5, "moron moron x"), (None, None), (None, "a b"), (91, "")]
    marks = [(i, int(i % 3 == 0), "x") for i in range(0, 60)] + [(None, 1, "x"), (500, 1, "x")]
    got = toxicity.shares(documents(*rows), labelled(spark, marks, "toxic"))
    train = [(d, t) for d, t in rows if crc32(str("" if d is None else d).encode()) % 5]
    bad = {d for d, toxic, _ in marks if toxic and d is not None}
    for (n, counts), kept in zip(got, ([t for d, t in train if d in bad], [t for _, t in train])):
        want = Counter(s for t in kept for s in {
            crc32(w) % toxicity.SLOTS for w in toxicity.words((t or "").encode())})
        assert n == len(kept) and {s: int(c) for s, c in enumerate(counts) if c} == want


def test_a_rare_toxic_word_gets_its_weight_from_the_whole_fold():
    """Its share is too small for the sample of the steps, but not for the corpus."""
    common, rare, n, m = 7, 11, 1e6, 1e8
    a, b = np.zeros(toxicity.SLOTS), np.zeros(toxicity.SLOTS)
    a[common], b[common], a[rare], b[rare], b[13] = 9e5, 2e6, 900.0, 950.0, 5e7
    a[13] = 5e5
    weights, _ = toxicity.train([[common]] * 40, [[common]] * 2 + [[13]] * 98, 0.02, ((n, a), (m, b)))
    assert weights[common] > 1 and weights[rare] > 1 and weights[13] == 0
    few = (40.0, a * 40 / n), (100.0, b * 100 / m)
    assert toxicity.train([[common]] * 40, [[13]] * 100, 0.02, few)[0][rare] == 0


def test_toxicity_of_a_very_long_text(spark, documents):
    docs = documents(*[(i, prose(i, 30) + (" moron" if i % 4 == 0 else "")) for i in range(200)],
                     (900, prose(1, 60_000)), (901, prose(2, 60_000) + " moron"))
    labels = labelled(spark, [(i, int(i % 4 == 0), "x") for i in range(200)], "toxic")
    found = {r.doc_id: r.predicted for r in toxicity.classify(docs, labels).collect()}
    assert (found[900], found[901]) == (0, 1)


def test_toxicity_without_examples(spark, documents):
    docs = documents("a", None)
    none = labelled(spark, [], "toxic")
    assert [r.score for r in toxicity.classify(docs, none).collect()] == pytest.approx([0, 0], abs=1e-9)
    assert toxicity.classify(spark.createDataFrame([], DOCS), none).count() == 0
