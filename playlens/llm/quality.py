"""Document quality by hierarchical empirical Bayes.

Three levels give one posterior that a document is good. A logistic classifier over surface
features of the whole text gives the document's own evidence. Sites are a host and, within
it, a path; each has a Beta prior whose mean is the level above (all documents for a host,
the host for a path) and whose weight is estimated from the spread between sites by the
method of moments. A site's posterior mean moves from the level above towards its own mean
with the number of its documents, so sparse sites stay near what stands above them. A
document's score adds to its own log odds the log odds of its path relative to those of all
documents; its own evidence is left out of path, host and all there, so that it counts once,
however sparse its site. A document is kept at a score of one half or more.

Host and path are those of a ``url`` column where there is one, the path being its first
segment; else the source is taken for the host and the language for the path.

Sites are summed up by grouped aggregates with map-side sums, so a host with a third of all
rows costs no more than another. The text is read once, and what is stored and shuffled are
two dozen numbers a document.

Bounds: the classifier is fitted on at most ``LABELLED`` labelled documents, those whose
ids have the smallest hashes. Site statistics and scores cover all documents.

Defined results: a null text counts as empty, a null host or path is a site of its own.
Without two kinds of labels the evidence of every document is one half, and all are kept. A
document with several labels is good if all say so; labels without a value or a document
are unused. Every row gives one row. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from playlens.llm.common import placed, placed_texts, stored, text_blocks, without_rows

LABELLED = 20_000
BLOCK_BYTES = 8 << 20
#: Evidence of one document is kept within these bounds, so that no site is certain.
LEAST, MOST = 1e-4, 1 - 1e-4
#: Bounds of a prior's weight, in documents.
WEIGHTS = (1.0, 1e6)


def _classes():
    """Byte classes by column: upper, lower, digit, space, line end, non-ASCII, and three
    kinds of punctuation: of sentences, of loud text, other."""
    table = np.zeros((256, 9))
    for b in range(256):
        c = chr(b)
        column = (5 if b > 127 else 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit()
                  else 4 if c == "\n" else 3 if b <= 32 else 6 if c in ".,;:'\"-()?" else
                  7 if c == "!" else 8)
        table[b, column] = 1
    return table


_CLASSES = _classes()
FEATURES = 9 + 7


def features(text):
    """Surface features of a text (bytes)."""
    raw = np.frombuffer(text, np.uint8)
    shares = np.zeros(256)
    for start in range(0, len(raw), 1 << 20):
        shares += np.bincount(raw[start:start + (1 << 20)], minlength=256)
    shares = shares @ _CLASSES / max(1, len(raw))
    words, lines = text.split(), text.split(b"\n")
    letters = shares[0] + shares[1] + 1e-9
    return np.concatenate([np.sqrt(shares), [
        np.log1p(len(words)), np.log1p(len(raw)) / 4, len(raw) / (len(words) + 1) / 10,
        len(set(words)) / (len(words) + 1), len(set(lines)) / (len(lines) + 1),
        shares[0] / letters, np.log1p(len(words) / len(lines))]])


def _rows(batches):
    for block, values in text_blocks(batches, BLOCK_BYTES):
        found = np.concatenate([*map(features, values), np.zeros(0)])
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(values) + 1) * FEATURES, pa.int32()), pa.array(found))
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in ("row", "doc_id", "host", "path")), lists],
            names=["row", "doc_id", "host", "path", "x"])


def described(docs, host, path):
    """row, doc_id, host, path and the features ``x`` of each row, stored."""
    rows = placed_texts(docs, host.cast("string").alias("host"), path.cast("string").alias("path"))
    return stored(rows.mapInArrow(
        _rows, "row long, doc_id long, host string, path string, x array<double>"), "quality")


def fit(rows, labels):
    """(centre, scale, weights, intercept) of the classifier, or None without two kinds."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
             .filter(F.col("quality").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").alias("quality")))
    sample = (rows.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "row")
              .select("quality", "x").limit(LABELLED).toArrow())
    y = np.array(sample.column("quality").to_pylist(), float) > 0
    if y.all() or not y.any():
        return None
    x = sample.column("x").combine_chunks().values.to_numpy().reshape(-1, FEATURES)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    x = np.c_[(x - centre) / scale, np.ones(len(x))]
    weights = np.zeros(x.shape[1])
    ridge = np.r_[np.full(FEATURES, 1.0), 1e-6]
    for _ in range(25):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, weights[:-1], weights[-1]


def evidence(rows, model):
    """``rows`` with the classifier's probability ``p`` in place of the features."""
    if model is None:
        return rows.drop("x").withColumn("p", F.lit(0.5))
    centre, scale, weights, intercept = model
    slopes = weights / scale
    offset = float(intercept - (slopes * centre).sum())
    total = F.lit(offset)
    for i, slope in enumerate(slopes):
        total = total + F.get("x", F.lit(i)) * float(slope)
    p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))
    return rows.withColumn("p", F.greatest(F.lit(LEAST), F.least(F.lit(MOST), p))).drop("x")


def _weight(sites, mean):
    """The weight of the prior of ``sites`` (n, s, above), by the method of moments.

    The squared distance of a site's mean from the level above is spread between sites plus
    noise of one document over n; what exceeds the noise is the spread."""
    rate, above = F.col("s") / F.col("n"), mean
    noise = above * (1 - above)
    found = sites.agg(
        F.sum("n"), F.sum(F.col("n") * (rate - above) ** 2), F.sum(noise), F.count("n"),
        F.sum(F.col("n") * noise)).first()
    total, squares, noises, count, inner = (float(v or 0) for v in found)
    between = (squares - noises) / total if total and count > 1 else 0.0
    if between <= 0:
        return WEIGHTS[1]
    return min(WEIGHTS[1], max(WEIGHTS[0], inner / total / between - 1))


def posteriors(scored):
    """(sites, whole): per site n, s (documents, summed evidence), host_n, host_s and the posteriors
    host_posterior and path_posterior; of all documents n, s, mean and the priors' weights."""
    paths = stored(scored.groupBy("host", "path").agg(
        F.count("p").alias("n"), F.sum("p").alias("s")), "quality_sites")
    s, n = paths.agg(F.sum("s"), F.sum("n")).first()
    mean = s / n if n else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    of_hosts = _weight(hosts, F.lit(mean))
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"), (
        (F.col("s") + of_hosts * mean) / (F.col("n") + of_hosts)).alias("host_posterior"))
    sites = (paths.alias("paths").join(hosts.alias("hosts"), F.expr("paths.host <=> hosts.host"))
             .select("paths.*", "host_n", "host_s", "host_posterior"))
    of_paths = _weight(sites, F.col("host_posterior"))
    sites = sites.withColumn("path_posterior", (
        F.col("s") + of_paths * F.col("host_posterior")) / (F.col("n") + of_paths))
    return sites, {"n": n or 0, "s": s or 0.0, "mean": mean, "hosts": of_hosts, "paths": of_paths}


def without_own(whole):
    """Columns for a document with evidence ``p`` and its site's sums: the mean and the posteriors of
    host and path that all other documents give."""
    p = F.col("p")
    mean = (whole["s"] - p) / (whole["n"] - 1) if whole["n"] > 1 else F.lit(0.5)
    host = (F.col("host_s") - p + whole["hosts"] * mean) / (F.col("host_n") - 1 + whole["hosts"])
    path = (F.col("s") - p + whole["paths"] * host) / (F.col("n") - 1 + whole["paths"])
    return [F.greatest(F.lit(LEAST), F.least(F.lit(MOST), c)).alias(name) for c, name in (
        (mean, "mean"), (host, "host_posterior"), (path, "path_posterior"))]


def site_of(url):
    """(host, path) columns of a column of addresses: the host, and the first segment of the path."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)", 1)
    return host, path


def classify(docs, labels, host=None, path=None):
    """row, doc_id, host, path, evidence, host_posterior, path_posterior, score, keep.

    ``host`` and ``path`` are columns of ``docs`` that name a document's site; the posteriors are
    those that all other documents give."""
    if host is None and path is None and "url" in docs.columns:
        host, path = site_of(F.col("url"))
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = described(docs, host, path)
    scored = evidence(rows, fit(rows, labels))
    sites, whole = posteriors(scored)
    odds = lambda p: F.log(p / (1 - p))
    joined = scored.alias("d").join(
        sites.drop("host_posterior", "path_posterior").alias("s"),
        F.expr("d.host <=> s.host AND d.path <=> s.path")).select(
        "d.*", *without_own(whole))
    total = odds(F.col("p")) + odds(F.col("path_posterior")) - odds(F.col("mean"))
    return joined.select(
        "row", "doc_id", "host", "path", F.col("p").alias("evidence"), "host_posterior",
        "path_posterior", (1 / (1 + F.exp(-total))).alias("score"), (total >= 0).alias("keep"))


def keep_good(docs, labels, host=None, path=None):
    """``docs`` without the rejected rows, all columns kept."""
    docs = placed(docs)
    return without_rows(docs, classify(docs, labels, host, path).filter(~F.col("keep")))
