"""Discriminant and regression against plain versions of their formulas."""

import math
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from docfacts.llm import language, quality

MORE = "/root/testdata/sf0.01"


def test_discriminant_against_means_and_covariances(spark):
    """Scores of the query from numpy's means and covariances of the same statistics, one document at a time."""
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{MORE}/documents.parquet'").fetchall())
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{MORE}/labels.parquet'").fetchall()
    x = {d: np.array(quality.statistics((t or "").encode())) for d, t in docs.items()}
    train = {c: np.array([x[d] for d, q in labels if q == c and d in x and zlib.crc32(str(d).encode()) % 5]) for c in (0, 1)}
    n = {c: len(v) for c, v in train.items()}
    cov = {c: np.cov(v.T, bias=True) for c, v in train.items()}
    pooled = sum(n[c] * cov[c] for c in n) / sum(n.values())
    own, both, spread = quality.SHRINKAGE
    found = {}
    for c in n:
        sigma = own * cov[c] + both * pooled + spread * np.diag(np.diag(pooled) + 1e-4)
        found[c] = (train[c].mean(0), np.linalg.inv(sigma), 0.5 * np.linalg.slogdet(sigma)[1], math.log(n[c] / sum(n.values())))
    got = {r["doc_id"]: r["score"] for r in quality.op2_quality(spark, MORE).collect()}
    assert set(got) == set(docs)
    for d, v in x.items():
        log = {c: prior - logdet - 0.5 * (v - mean) @ inverse @ (v - mean) for c, (mean, inverse, logdet, prior) in found.items()}
        want = 1 / (1 + math.exp(min(700, max(-700, log[0] - log[1]))))
        assert math.isclose(got[d], want, rel_tol=1e-5, abs_tol=1e-7)


def test_forward_substitution():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(17, 17))
    factor = np.linalg.cholesky(a @ a.T + np.eye(17))
    right = rng.normal(size=(17, 30))
    assert np.allclose(factor @ quality.solved(factor, right), right)


def test_labels_that_repeat_or_contradict(spark):
    docs = spark.createDataFrame([(i, [float(i % 7 + j * (i % 2)) for j in range(17)]) for i in range(60)], "doc_id long, x array<double>")
    plain = [(i, i % 2) for i in range(40)]
    models = [quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"), F.lit(True)) for rows in (plain, plain * 3 + [(50, 0), (50, 1), (51, None), (99, 1)])]
    for a, b in zip(models[0].parts, models[1].parts, strict=True):
        assert all(np.allclose(x, y) for x, y in zip(a, b, strict=True))


def slow_ftrl(rows, classes):
    """The update rule written out for single weights."""
    z, n = {}, {}
    A, B, L1, L2 = language.ALPHA, language.BETA, language.L1, language.L2

    def weight(k):
        zk, nk = z.get(k, 0.0), n.get(k, 0.0)
        return 0.0 if abs(zk) <= L1 else -(zk - math.copysign(L1, zk)) / ((B + math.sqrt(nk)) / A + L2)

    for _ in range(language.EPOCHS):
        for label, own, x in rows:
            w = {(i, c): weight((i, c)) for i in own for c in range(classes)}
            logits = [sum(v * w[i, c] for i, v in zip(own, x, strict=True)) for c in range(classes)]
            most = max(logits)
            e = [math.exp(v - most) for v in logits]
            p = [v / sum(e) for v in e]
            for i, v in zip(own, x, strict=True):
                for c in range(classes):
                    g = v * (p[c] - (c == label))
                    sigma = (math.sqrt(n.get((i, c), 0.0) + g * g) - math.sqrt(n.get((i, c), 0.0))) / A
                    z[i, c] = z.get((i, c), 0.0) + g - sigma * w[i, c]
                    n[i, c] = n.get((i, c), 0.0) + g * g
    return {k: weight(k) for k in z}


def test_ftrl_against_plain_loops():
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(50):
        label = int(rng.integers(0, 3))
        own = np.sort(rng.choice(60, 12, replace=False))
        rows.append((label, own, rng.random(12) * np.where(own % 3 == label, 1.0, 0.2)))
    got = language.train(rows, 3)
    want = slow_ftrl([(label, own.tolist(), x.tolist()) for label, own, x in rows], 3)
    assert all(math.isclose(got[i, c], w, rel_tol=1e-9, abs_tol=1e-12) for (i, c), w in want.items())
    assert (got[60:] == 0).all() and 0 < (got[:60] == 0).sum() < got[:60].size  # sparse, not empty


def test_document_frequencies_and_weights(spark):
    texts = ["ab ab", "ab c", None, "12 3", "C-a"]
    total, df = language.document_frequencies(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    want = np.zeros(language.BUCKETS, dtype=int)
    for t in texts:
        got = language.ngram_counts(t)
        if got is not None:
            want[got[0]] += 1
    assert total == 3 and (df == want).all()
    own, counts = language.ngram_counts("ab ab")
    idf = np.log((1 + total) / (1 + df)) + 1
    x = language.weights(own, counts, idf)
    assert math.isclose((x * x).sum(), 1) and np.allclose(x / x[0], np.log1p(counts) * idf[own] / (np.log1p(counts[0]) * idf[own[0]]))


def test_temperature_is_the_best_of_its_grid():
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 3, 400)
    logits = rng.normal(size=(400, 3)) * 3
    logits[np.arange(400), labels] += 2
    loss = lambda t: -np.mean([math.log(math.exp(a[k] / t) / sum(math.exp(v / t) for v in a)) for a, k in zip(logits, labels, strict=True)])
    best = language.temperature(logits, labels)
    assert all(loss(best) <= loss(2.0 ** (k / 8)) + 1e-12 for k in range(-16, 25))
